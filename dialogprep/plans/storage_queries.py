"""Checkable queries for the sources and sinks that work beside Spark's own:
cut lists, published and ordered outputs.

Outputs go to a folder of their own in the checkpoint folder and are read back
from there. The SQL holds its constants written out.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.operators import split as S
from dialogprep.operators.lean import lean_pairs
from dialogprep.plans import source_queries as X
from dialogprep.session import ensure_checkpoint_dir
from dialogprep.sources import cleaned as C
from dialogprep.sources import jsonl as J
from dialogprep.sources import large_lists as L
from dialogprep.sources.listing import resolve
from dialogprep.sources.ordered import read_ordered, write_ordered
from dialogprep.sources.publish import Publication


def _folder(spark: SparkSession) -> str:
    """A new folder in shared storage; it goes when the application ends."""
    fs, path = resolve(spark, f"{ensure_checkpoint_dir(spark)}/queries/{uuid.uuid4().hex}")
    fs.mkdirs(path)
    fs.deleteOnExit(path)
    return path.toString()


def q_list_ranges_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned lists' items, each list cut in ranges of 64 fragments."""
    files = X.cleaned_files(spark, sf_dir)
    whole = files.select("conv_id", F.octet_length("value").cast("bigint").alias("size"), F.split("value", L.SEPARATOR).alias("parts"))
    parts = whole.select("conv_id", "size", F.posexplode("parts").alias("at", "value"))
    items, _ = L.cut_items(parts.withColumn("range", F.floor(F.col("at") / 64)), ["conv_id"])
    parsed = items.select("conv_id", F.col("pos").cast("int").alias("pos"), F.try_parse_json("item").alias("m"))
    return parsed.select("conv_id", "pos", *[v.alias(k) for k, v in C.item_columns(F.col("m")).items()])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a JSON line, with its place."""
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return conv.select("conv_id", "turn", F.to_json(F.struct("role", "text")).alias("line"))


def q_published_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outputs published, then published anew from fewer rows: what
    stands in the end, with the output it stands in."""
    folder, lines = _folder(spark), _lines(spark, sf_dir)
    for rows in (lines, lines.where("conv_id % 3 <> 0")):
        with Publication(spark, {"first": f"{folder}/first", "later": f"{folder}/later"}) as out:
            J.write_lines(rows.where("turn = 0"), "line", out.path("first"))
            J.write_lines(rows.where("turn > 0"), "line", out.path("later"))
    read = lambda name: J.read_lines(spark, f"{folder}/{name}").select(F.lit(name).alias("output"), "line")
    both = read("first").unionByName(read("later"))
    return both.groupBy("output", F.sha2("line", 256).alias("line_sha256")).agg(F.count("*").alias("n"))


def q_ordered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position of each line in an ordered output, by its manifest."""
    path = f"{_folder(spark)}/ordered"
    write_ordered(_lines(spark, sf_dir), "line", ["conv_id", "turn"], path)
    return read_ordered(spark, path).select("position", F.sha2("value", 256).alias("line_sha256"))


def q_split_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides of the exact split of all turns, from one evaluation."""
    lines = _lines(spark, sf_dir)
    sides = S.split_lines(lines, "line", ["conv_id", "turn"], 0.1, 7).sides
    return sides.groupBy("side", F.sha2("line", 256).alias("line_sha256")).agg(F.count("*").alias("n"))


def q_lean_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply pairs of all conversations, found without texts; texts last."""
    conv = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    msgs = conv.select(
        "conv_id", "turn", F.when(F.col("role") == "assistant", "me").otherwise("other").alias("sender"), "text",
        (F.col("turn") * 1000).alias("timestamp"),
    )
    return lean_pairs(msgs, ["conv_id"], ["turn"]).select("conv_id", "block", "user", "assistant", "user_ts", "reply_ts")


QUERIES = {
    "lean_pairs": q_lean_pairs,
    "list_ranges_items": q_list_ranges_items,
    "published_lines": q_published_lines,
    "ordered_lines": q_ordered_lines,
    "split_sides": q_split_sides,
}

# a JSON text of two fields as Spark prints it; null fields are left out
_LINE = """
  '{' || array_to_string(list_filter([
    CASE WHEN role IS NOT NULL THEN '"role":' || CAST(to_json(role) AS VARCHAR) END,
    CASE WHEN text IS NOT NULL THEN '"text":' || CAST(to_json(text) AS VARCHAR) END], lambda x: x IS NOT NULL), ',') || '}'
"""
_LINES = f"SELECT conv_id, turn, {_LINE} AS line FROM conversations"

_STRIPPED = f"trim(text, {X._SPACES})"

ORACLE_SQL = {
    "lean_pairs": f"""
      WITH m AS (
        SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'me' ELSE 'other' END AS sender, {_STRIPPED} AS text
        FROM conversations WHERE text IS NOT NULL AND {_STRIPPED} <> ''
      ), r AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn)
                  - row_number() OVER (PARTITION BY conv_id, sender ORDER BY turn) AS island FROM m
      ), b AS (
        SELECT conv_id, sender, min(turn) AS first, max(turn) * 1000 AS stamp, string_agg(text, chr(10) ORDER BY turn) AS text
        FROM r GROUP BY conv_id, sender, island
      ), n AS (
        SELECT *, row_number() OVER w AS block, lead(sender) OVER w AS next_sender, lead(text) OVER w AS next_text, lead(stamp) OVER w AS next_stamp
        FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY first)
      )
      SELECT conv_id, block, text AS user, next_text AS assistant, stamp AS user_ts, next_stamp AS reply_ts FROM n
      WHERE sender = 'other' AND next_sender = 'me' AND length(text) >= 2 AND length(next_text) >= 2 AND next_stamp - stamp <= 43200000
    """,
    "list_ranges_items": X.ORACLE_SQL["cleaned_items"],
    "published_lines": f"""
      SELECT CASE WHEN turn = 0 THEN 'first' ELSE 'later' END AS output, sha256(line) AS line_sha256, count(*) AS n
      FROM ({_LINES}) WHERE conv_id % 3 <> 0 GROUP BY ALL
    """,
    "ordered_lines": f"""
      SELECT row_number() OVER (ORDER BY conv_id, turn) AS position, sha256(line) AS line_sha256 FROM ({_LINES})
    """,
    "split_sides": f"""
      WITH t AS ({_LINES}),
      l AS (SELECT line, md5(line) AS h, row_number() OVER (PARTITION BY line ORDER BY conv_id, turn) AS i FROM t),
      p AS (SELECT h, row_number() OVER (ORDER BY md5('7:' || h || ':' || i)) AS r, count(*) OVER () AS n FROM l),
      v AS (SELECT h, count(*) AS chosen FROM p WHERE r <= greatest(1, CAST(floor(n * 0.1::DOUBLE) AS BIGINT)) GROUP BY h)
      SELECT CASE WHEN i <= coalesce(chosen, 0) THEN 'val' ELSE 'train' END AS side, sha256(line) AS line_sha256, count(*) AS n
      FROM l LEFT JOIN v USING (h) GROUP BY ALL
    """,
}
