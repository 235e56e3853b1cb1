"""Checkable queries for the rules of the sources and the line split.

The files' texts are built from the test tables, one file per conversation,
and go through the column functions that the readers use, so nothing is
written. Every third kind of fault comes from a rule on the keys. The SQL
holds its constants written out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.functions.text import py_strip
from dialogprep.operators import split as S
from dialogprep.operators import turns as U
from dialogprep.sources import cleaned as C
from dialogprep.sources import exports as E


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/conversations.parquet")


def export_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, value`` of two export files per conversation, even and odd
    turns. The text of every seventh conversation's first file is cut short,
    every fifth conversation's files have no messages."""
    conv = _conversations(spark, sf_dir)
    part = F.pmod("turn", F.lit(2)) + 1
    message = F.struct("turn", F.col("role").alias("sender_name"), F.col("text").alias("content"), (F.col("turn") * 1000).alias("timestamp_ms"))
    files = conv.groupBy("conv_id", part.alias("part")).agg(F.sort_array(F.collect_list(message)).alias("m"))
    messages = F.when(F.col("conv_id") % 5 == 0, F.slice("m", 1, 0)).otherwise(F.col("m"))
    text = F.to_json(F.struct(F.transform(messages, lambda x: x.dropFields("turn")).alias("messages")))
    text = F.when((F.col("conv_id") % 7 == 0) & (F.col("part") == 1), F.substring(text, 1, 12)).otherwise(text)
    path = F.concat(F.lit("file:/in/c"), F.col("conv_id").cast("string"), F.lit("/message_"), F.col("part").cast("string"), F.lit(".json"))
    return files.select(path.alias("path"), text.alias("value"))


def _scan(spark: SparkSession, sf_dir: str) -> E.ExportScan:
    parsed = export_files(spark, sf_dir).select("path", E.parse_export(F.col("value")).alias("f"))
    corrupt = F.col("f._corrupt_record").isNotNull() & F.col("f.messages").isNull()
    return E.split_files(parsed.select("path", "f.messages", corrupt.alias("corrupt")), "/in")


def q_export_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all files in file and list order."""
    return _scan(spark, sf_dir).messages.drop("conversation_name")


def q_export_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).quarantine


def q_conversation_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations with at least one raw message."""
    return _scan(spark, sf_dir).messages.agg(F.count_distinct("conversation").alias("n"))


def q_timestamp_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as exported: numbers in several spellings, null, or no number.
    Kept messages with their time, and the rejected ones with the reason."""
    conv = _conversations(spark, sf_dir)
    n = F.col("conv_id") + F.col("turn")
    spelled = (
        F.when(n % 6 == 0, F.lit("soon")).when(n % 6 == 1, F.lit(None))
        .when(n % 6 == 2, F.concat(F.col("turn").cast("string"), F.lit(".75"))).when(n % 6 == 3, F.lit("1e3"))
        .otherwise(F.col("turn").cast("string"))
    )
    raw = conv.select(
        F.col("conv_id").cast("string").alias("conversation"), F.lit("f").alias("file_name"), F.col("turn").alias("pos"),
        F.col("role").alias("sender_name"), F.concat(F.lit("turn "), F.col("turn").cast("string")).alias("content"), spelled.alias("timestamp_ms"),
    )
    kept = U.clean_messages(raw, "assistant").select(
        F.concat_ws("#", F.concat("conversation", F.lit("/f")), F.col("pos").cast("string")).alias("path"), F.lit(None).cast("string").alias("reason"), "timestamp"
    )
    rejected = U.rejected_messages(raw)
    return kept.unionByName(rejected.withColumn("timestamp", F.lit(None).cast("bigint")))


def cleaned_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conv_id, value``: a cleaned JSON list per conversation, in which
    some items lack the time, have one that is no number, or are no
    objects; every ninth text goes on after the list."""
    n = F.col("conv_id") + F.col("turn")
    said = F.struct(F.col("role").alias("sender"), F.col("text"))
    timed = F.struct(F.col("role").alias("sender"), F.col("text"), F.col("turn").alias("timestamp"))
    late = F.struct(F.col("role").alias("sender"), F.col("text"), F.lit("late").alias("timestamp"))
    item = (
        F.when(n % 5 == 0, F.to_json(said)).when(n % 5 == 1, F.to_json(late)).when(n % 11 == 0, F.lit("[1]")).otherwise(F.to_json(timed))
    )
    lists = _conversations(spark, sf_dir).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", item.alias("j")))).alias("items"))
    text = F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["j"]), ","), F.lit("]"))
    return lists.select("conv_id", F.when(F.col("conv_id") % 9 == 0, F.concat(text, F.lit(" x"))).otherwise(text).alias("value"))


def q_cleaned_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = cleaned_files(spark, sf_dir).select("conv_id", C.parse_cleaned(F.col("value")).alias("items"))
    items = files.select("conv_id", F.posexplode("items").alias("pos", "m"))
    return items.select("conv_id", "pos", *[v.alias(k) for k, v in C.item_columns(F.col("m")).items()])


def q_require_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: items kept, and dropped for want of a time."""
    has = F.col("has_timestamp")
    return q_cleaned_items(spark, sf_dir).groupBy("conv_id").agg(F.count_if(has).alias("kept"), F.count_if(~has).alias("dropped"))


def q_block_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of turns of which some are blank, null, or of no sender: those
    take no part, so their neighbours meet."""
    conv = _conversations(spark, sf_dir)
    n = F.col("conv_id") * 3 + F.col("turn")
    text = F.when(n % 5 == 0, F.lit(" \u3000\t")).when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("\u2003t"), F.col("turn").cast("string"), F.lit(" ")))
    sender = F.when(n % 11 != 0, F.when(F.col("role") == "assistant", "me").otherwise("other"))
    msgs = conv.select("conv_id", "turn", sender.alias("sender"), text.alias("text"), F.col("turn").alias("timestamp"))
    blocks = U.merge_blocks(msgs, ["conv_id"], ["turn"])
    return blocks.select("conv_id", "block", "sender", "text", "n_messages")


def q_turns_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same turns joined as they are: nothing stripped or filtered."""
    conv = _conversations(spark, sf_dir)
    n = F.col("conv_id") * 3 + F.col("turn")
    text = F.when(n % 5 == 0, F.lit(" \u3000\t")).otherwise(F.concat(F.lit("\u2003t"), F.col("turn").cast("string"), F.lit(" ")))
    sender = F.when(F.col("role") == "assistant", "me").otherwise("other")
    msgs = conv.select("conv_id", "turn", sender.alias("sender"), text.alias("text")).withColumnRenamed("turn", "at")
    return U.merge_turns(msgs, ["conv_id"], ["at"])


def q_blank_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that are not blank once stripped."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    lines = F.transform(F.split(F.col("text"), "\n"), py_strip)
    kept = F.filter(lines, lambda x: x != "")
    return docs.select("doc_id", F.size(kept).cast("bigint").alias("n_lines"), F.sha2(F.array_join(kept, "\n"), 256).alias("lines_sha256"))


def q_split_lines_val(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as lines, copies among them, split one by one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return S.split_lines(docs, "text", ["doc_id"], 0.05, 42).val.select("doc_id")


QUERIES = {
    "export_parse": q_export_parse,
    "export_quarantine": q_export_quarantine,
    "conversation_count": q_conversation_count,
    "timestamp_rules": q_timestamp_rules,
    "cleaned_items": q_cleaned_items,
    "require_timestamp": q_require_timestamp,
    "block_input": q_block_input,
    "turns_unfiltered": q_turns_unfiltered,
    "blank_lines": q_blank_lines,
    "split_lines_val": q_split_lines_val,
}

_SPACES = " || ".join(f"chr({c})" for c in (
    9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202,
    8232, 8233, 8239, 8287, 12288,
))

_EXPORTED = """
  SELECT 'c' || conv_id AS conversation, 'message_' || (turn % 2 + 1) || '.json' AS file_name,
         CAST(row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) - 1 AS INTEGER) AS pos,
         role AS sender_name, text AS content, CAST(turn * 1000 AS VARCHAR) AS timestamp_ms
  FROM conversations WHERE conv_id % 5 <> 0 AND NOT (conv_id % 7 = 0 AND turn % 2 = 0)
"""

_ITEMS = """
  SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos,
         (conv_id + turn) % 5 AS a, (conv_id + turn) % 11 AS b, role, text, turn
  FROM conversations WHERE conv_id % 9 <> 0
"""

_ITEM_ROWS = f"""
  SELECT conv_id, pos, a <> 0 AND (a = 1 OR b <> 0) AS has_timestamp,
         CASE WHEN a IN (0, 1) OR b <> 0 THEN role END AS sender, CASE WHEN a IN (0, 1) OR b <> 0 THEN text END AS text,
         CASE WHEN a > 1 AND b <> 0 THEN turn END AS timestamp
  FROM ({_ITEMS})
"""

ORACLE_SQL = {
    "export_parse": _EXPORTED,
    "export_quarantine": """
      SELECT DISTINCT 'file:/in/c' || conv_id || '/message_1.json' AS path, 'CORRUPT_JSON' AS reason
      FROM conversations WHERE conv_id % 7 = 0 AND turn % 2 = 0
    """,
    "conversation_count": f"SELECT count(DISTINCT conversation) AS n FROM ({_EXPORTED})",
    "timestamp_rules": """
      SELECT conv_id || '/f#' || turn AS path, CASE WHEN (conv_id + turn) % 6 = 0 THEN 'BAD_TIMESTAMP' END AS reason,
             CASE (conv_id + turn) % 6 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 3 THEN 1000 ELSE turn END AS timestamp
      FROM conversations
    """,
    "cleaned_items": _ITEM_ROWS,
    "require_timestamp": f"""
      SELECT conv_id, count(*) FILTER (WHERE has_timestamp) AS kept, count(*) FILTER (WHERE NOT has_timestamp) AS dropped
      FROM ({_ITEM_ROWS}) GROUP BY conv_id
    """,
    "block_input": """
      WITH m AS (
        SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'me' ELSE 'other' END AS sender, 't' || turn AS text
        FROM conversations
        WHERE (conv_id * 3 + turn) % 5 <> 0 AND (conv_id * 3 + turn) % 7 <> 0 AND (conv_id * 3 + turn) % 11 <> 0
      ), r AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn)
                  - row_number() OVER (PARTITION BY conv_id, sender ORDER BY turn) AS island FROM m
      ), b AS (
        SELECT conv_id, sender, min(turn) AS first, string_agg(text, chr(10) ORDER BY turn) AS text, count(*) AS n_messages
        FROM r GROUP BY conv_id, sender, island
      )
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY first) AS block, sender, text, n_messages FROM b
    """,
    "turns_unfiltered": """
      WITH m AS (
        SELECT conv_id, turn AS place, CASE WHEN role = 'assistant' THEN 'me' ELSE 'other' END AS sender,
               CASE WHEN (conv_id * 3 + turn) % 5 = 0 THEN ' ' || chr(12288) || chr(9)
                    ELSE chr(8195) || 't' || turn || ' ' END AS text
        FROM conversations
      ), r AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY place)
                  - row_number() OVER (PARTITION BY conv_id, sender ORDER BY place) AS island FROM m
      ), b AS (
        SELECT conv_id, sender, min(place) AS first, string_agg(text, chr(10) ORDER BY place) AS text FROM r GROUP BY conv_id, sender, island
      )
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY first) AS turn, sender, text FROM b
    """,
    "blank_lines": f"""
      SELECT doc_id, CAST(len(k) AS BIGINT) AS n_lines, sha256(array_to_string(k, chr(10))) AS lines_sha256
      FROM (
        SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, {_SPACES})), lambda x: x <> '') AS k
        FROM documents
      )
    """,
    "split_lines_val": """
      WITH l AS (SELECT doc_id, md5(text) AS h, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS i FROM documents),
      p AS (SELECT h, row_number() OVER (ORDER BY md5('42:' || h || ':' || i)) AS r, count(*) OVER () AS n FROM l),
      v AS (SELECT h, count(*) AS chosen FROM p WHERE r <= greatest(1, CAST(floor(n * 0.05::DOUBLE) AS BIGINT)) GROUP BY h)
      SELECT doc_id FROM l JOIN v USING (h) WHERE i <= chosen
    """,
}
