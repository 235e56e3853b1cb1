"""Checkable queries over the test tables, one per rule, with SQL oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables. The oracle SQL (DuckDB dialect) computes the same columns from the
same tables; both sides alias every computed column to the same name.

Table stand-ins: ``documents.text`` for message texts, ``conversations``
(conv_id, turn, role, text) for chat turns, ``events`` (user_id, ts,
event_type) for timed messages: click/view events are the other party's
messages, the rest are ours, and a message's text is ``event_type:event_id``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.functions import records as R
from dialogprep.functions import text as T
from dialogprep.operators import dedup as D
from dialogprep.operators import pairs as P
from dialogprep.operators import split as S
from dialogprep.operators import turns as U
from dialogprep.operators.layout import filter_once, keep_nonnull, spread
from dialogprep.operators.sequence import by_hotness, ordered_scan
from dialogprep.plans import source_queries as X
from dialogprep.plans import storage_queries as Y
from dialogprep.plans.job import build_samples

# Parameters of the checks (not behaviour): extra noise phrases and secret
# phrases that occur in the generated documents.
EXTRA_NOISE = ["license", "token", "###"]
SECRETS = [("license", "[REDACTED_LICENSE]"), ("token", "[SECRET]")]
SPLIT_SEED = 42
SPLIT_FRACTION = 0.05
EVENT_KEY = ["user_id"]
EVENT_ORDER = ["ts_ms", "event_id"]


def _t(spark: SparkSession, sf_dir: str, name: str, spread_rows: bool = False) -> DataFrame:
    """A test table; ``spread_rows`` for CPU-heavy per-row text work (see
    :func:`spread`), not for frames that go straight into a shuffle."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if spread_rows else df


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _t(spark, sf_dir, "events")
    return ev.select(
        "user_id",
        "event_id",
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.when(F.col("event_type").isin("click", "view"), F.lit("other")).otherwise(F.lit("me")).alias("sender"),
        F.concat(F.col("event_type"), F.lit(":"), F.col("event_id").cast("string")).alias("text"),
    )


# ---------------------------------------------------------------- text rules


def q_noise_filter(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    staged = docs.select("doc_id", "text", F.lower("text").alias("_dp_low"))
    kept = filter_once(staged, ~T.is_noise("text", EXTRA_NOISE, lowered=F.col("_dp_low")))
    return kept.select("doc_id", "text")


def q_mojibake_repair(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    mangled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return docs.select("doc_id", T.repair_mojibake(mangled).alias("text"))


def q_length_bounds(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    n = F.when(T.within_length("text"), F.length("text").cast("bigint"))
    return keep_nonnull(docs.select("doc_id", "text"), n, "n_chars").select("doc_id", "n_chars")


def q_secret_replace(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    return docs.select("doc_id", T.replace_secrets("text", SECRETS).alias("text"))


def q_phone_redact(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    return docs.select("doc_id", T.redact_phones("text").alias("text"))


def q_scrub(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    return T.scrub_staged(docs.select("doc_id", "text"), "text", "text", SECRETS, ["###"])


def q_scrub_turns(spark, sf_dir):
    conv = _t(spark, sf_dir, "conversations", spread_rows=True)
    return T.scrub_staged(conv.select("conv_id", "turn", "text"), "text", "text")


def q_sender_normalize(spark, sf_dir):
    conv = _t(spark, sf_dir, "conversations")
    return conv.select("conv_id", "turn", T.normalize_sender("role", "assistant").alias("sender"))


def q_other_party(spark, sf_dir):
    conv = _t(spark, sf_dir, "conversations")
    return U.other_party(conv, "assistant", key=["conv_id"], input_order=["turn"], sender_name="role")


# ------------------------------------------------------------ ordered rules


def q_chrono_order(spark, sf_dir):
    msgs = event_messages(spark, sf_dir)
    out = ordered_scan(msgs, EVENT_KEY, EVENT_ORDER, seq="seq")
    return out.select("event_id", "user_id", F.col("seq").cast("bigint").alias("seq"))


def q_merge_turns(spark, sf_dir):
    msgs = event_messages(spark, sf_dir)
    turns = by_hotness(msgs, EVENT_KEY, lambda d, scan: U.merge_turns(d, EVENT_KEY, EVENT_ORDER, scan=scan))
    return turns.select("user_id", "turn", "sender", "text")


def q_merge_blocks(spark, sf_dir):
    msgs = event_messages(spark, sf_dir)
    blocks = by_hotness(
        msgs, EVENT_KEY, lambda d, scan: U.merge_blocks(d, EVENT_KEY, EVENT_ORDER, timestamp="ts_ms", scan=scan)
    )
    return blocks.select("user_id", "block", "sender", "text", "first_ts", "last_ts", "n_messages")


def _event_pairs(spark, sf_dir, gap_from):
    msgs = event_messages(spark, sf_dir)
    pairs = build_samples(msgs, EVENT_KEY, EVENT_ORDER, P.DEFAULT_TIME_GAP_LIMIT, gap_from, timestamp="ts_ms")
    return pairs.select("user_id", "block", "user", "assistant", "user_ts", "reply_ts")


def q_reply_pairs(spark, sf_dir):
    return _event_pairs(spark, sf_dir, "last")


def q_reply_pairs_first(spark, sf_dir):
    return _event_pairs(spark, sf_dir, "first")


def conversation_pairs(spark, sf_dir) -> DataFrame:
    """Adjacent user -> assistant turns of ``conversations`` as samples."""
    conv = _t(spark, sf_dir, "conversations")

    def chain(rows, scan):
        nb = P.next_block(rows, ["conv_id"], "turn", ("role", "text"), scan)
        user = T.py_strip("text")
        assistant = T.py_strip("next_text")
        return (
            nb.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
            .select("conv_id", "turn", user.alias("user"), assistant.alias("assistant"))
            .where((F.length("user") >= P.MIN_PAIR_CHARS) & (F.length("assistant") >= P.MIN_PAIR_CHARS))
        )

    return by_hotness(conv, ["conv_id"], chain)


def q_conv_pairs(spark, sf_dir):
    return conversation_pairs(spark, sf_dir).select("conv_id", "turn", "user", "assistant")


def conversation_messages(spark, sf_dir) -> DataFrame:
    """``conversations`` as raw export messages: role is the sender name,
    the turn number the timestamp; 'assistant' is our side."""
    conv = _t(spark, sf_dir, "conversations", spread_rows=True)
    raw = conv.select(
        "conv_id",
        "turn",
        F.col("role").alias("sender_name"),
        F.col("text").alias("content"),
        F.col("turn").cast("string").alias("timestamp_ms"),
    )
    return U.clean_messages(raw, "assistant")


def q_clean_turns(spark, sf_dir):
    return conversation_messages(spark, sf_dir).select("conv_id", "turn", "sender", "text", "timestamp")


def q_conv_samples(spark, sf_dir):
    msgs = conversation_messages(spark, sf_dir)
    # hot conversations are found in the table itself, before any cleaning
    raw = _t(spark, sf_dir, "conversations").select("conv_id")
    pairs = build_samples(msgs, ["conv_id"], ["timestamp", "turn"], counts_from=raw)
    return pairs.select("conv_id", "block", "user", "assistant")


def _keyed_samples(spark, sf_dir):
    pairs = conversation_pairs(spark, sf_dir).withColumn("sample", P.sample_record())
    fp = R.fingerprint_of(F.col("sample.messages"))
    return pairs.withColumn("fp_key", R.fingerprint_key(fp))


def q_fingerprint(spark, sf_dir):
    return _keyed_samples(spark, sf_dir).select("conv_id", "turn", "fp_key")


def q_samples_dedup(spark, sf_dir):
    """Flagship: turns -> adjacent pairs -> sample -> fingerprint -> first wins."""
    keyed = _keyed_samples(spark, sf_dir)
    return D.first_wins(keyed, "fp_key", ["conv_id", "turn"]).select("conv_id", "turn", "fp_key")


def _doc_marks(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True).select("doc_id", "text")
    keyed = docs.withColumn("fp_key", R.fingerprint_key("text"))
    return D.mark_first(keyed, "fp_key", ["doc_id"], "is_first")


def q_dedup_first(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    keyed = docs.select("doc_id", R.fingerprint_key("text").alias("fp_key"))
    return D.first_wins(keyed, "fp_key", ["doc_id"]).select("doc_id")


def q_dedup_removed(spark, sf_dir):
    return _doc_marks(spark, sf_dir).where(~F.col("is_first")).select(
        "doc_id", F.lit(R.DUPLICATE).alias("reason")
    )


# --------------------------------------------------------- record checks


def record_lines(spark, sf_dir) -> DataFrame:
    """One JSONL line per ``events`` row, of one of eight kinds chosen by
    ``event_id % 8`` (a selector, not a filter: every row is used): valid
    records with and without messages, malformed text, non-object roots and
    wrong ``messages`` shapes, built from the row's own fields."""
    ev = _t(spark, sf_dir, "events", spread_rows=True)
    k = F.col("event_id") % 8
    et = F.col("event_type")
    props = F.col("props")
    uid = F.col("user_id").cast("string")
    line = (
        F.when(k == 0, props)
        .when(
            k == 1,
            F.concat(
                F.lit('{"messages":[{"role":"user","content":"'), et,
                F.lit('"},{"role":"assistant","content":"'), uid, F.lit('"}]}'),
            ),
        )
        .when(k == 2, F.concat(F.lit("NOT JSON "), et))
        .when(k == 3, F.concat(F.lit("["), props, F.lit("]")))
        .when(k == 4, F.concat(F.lit('{"messages":'), uid, F.lit("}")))
        .when(k == 5, F.concat(F.lit('{"messages":"'), et, F.lit('"}')))
        .when(k == 6, F.concat(F.lit('{"messages":['), props, F.lit(",null]}")))
        .otherwise(F.concat(props, F.lit(" "), et))
    )
    return ev.select("event_id", line.alias("line"))


def q_structural_check(spark, sf_dir):
    return R.route_lines(record_lines(spark, sf_dir)).select("event_id", "status", "fp")


def q_validation_counts(spark, sf_dir):
    from dialogprep.operators.validate import count_statuses

    return count_statuses(record_lines(spark, sf_dir))


def q_doc_records(spark, sf_dir):
    """Each document as a one-message JSONL record, routed, fingerprinted
    and de-duplicated (first document wins)."""
    from dialogprep.operators.validate import classify_lines

    docs = _t(spark, sf_dir, "documents", spread_rows=True)
    message = F.struct(F.lit("user").alias("role"), F.col("text").alias("content"))
    line = F.to_json(F.struct(F.array(message).alias("messages")))
    classified = classify_lines(docs.select("doc_id", line.alias("line")), ["doc_id"])
    return classified.select("doc_id", "status", "fp_key")


# ------------------------------------------------------------------ split


def _doc_split(spark, sf_dir):
    docs = _t(spark, sf_dir, "documents").select("doc_id")
    return S.split(docs, F.col("doc_id"), "doc_id", SPLIT_FRACTION, SPLIT_SEED)


def q_split_val(spark, sf_dir):
    return _doc_split(spark, sf_dir).val.select("doc_id")


def q_split_train(spark, sf_dir):
    return _doc_split(spark, sf_dir).train.select("doc_id")


# ----------------------------------------------------------------- counts


def q_dataset_counts(spark, sf_dir):
    """Per user: messages in blocks, blocks and samples, from one pass."""
    msgs = event_messages(spark, sf_dir)

    def chain(rows, scan):
        blocks = U.merge_blocks(rows, EVENT_KEY, EVENT_ORDER, timestamp="ts_ms", scan=scan)
        marked = P.mark_pairs(blocks, EVENT_KEY, scan=scan)
        return marked.groupBy("user_id").agg(
            F.sum("n_messages").alias("n_messages"),
            F.count(F.lit(1)).alias("n_blocks"),
            F.count_if("is_pair").alias("n_samples"),
        )

    return by_hotness(msgs, EVENT_KEY, chain)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "noise_filter": q_noise_filter,
    "mojibake_repair": q_mojibake_repair,
    "length_bounds": q_length_bounds,
    "secret_replace": q_secret_replace,
    "phone_redact": q_phone_redact,
    "scrub": q_scrub,
    "scrub_turns": q_scrub_turns,
    "sender_normalize": q_sender_normalize,
    "other_party": q_other_party,
    "chrono_order": q_chrono_order,
    "merge_turns": q_merge_turns,
    "merge_blocks": q_merge_blocks,
    "reply_pairs": q_reply_pairs,
    "reply_pairs_first": q_reply_pairs_first,
    "conv_pairs": q_conv_pairs,
    "clean_turns": q_clean_turns,
    "conv_samples": q_conv_samples,
    "fingerprint": q_fingerprint,
    "samples_dedup": q_samples_dedup,
    "dedup_first": q_dedup_first,
    "dedup_removed": q_dedup_removed,
    "structural_check": q_structural_check,
    "validation_counts": q_validation_counts,
    "doc_records": q_doc_records,
    "split_val": q_split_val,
    "split_train": q_split_train,
    "dataset_counts": q_dataset_counts,
    **X.QUERIES,
    **Y.QUERIES,
}


# ------------------------------------------------------------------ oracles


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


WS_SQL = " || ".join(f"chr({c})" for c in T.PY_WHITESPACE_CODEPOINTS)
PHONE_SQL = _sql_str(T.PHONE_PATTERN)


def _noise_sql(col: str, extra: list[str]) -> str:
    return "(" + " OR ".join(f"contains(lower({col}), {_sql_str(p)})" for p in T.noise_phrases(extra)) + ")"


def _secrets_sql(expr: str) -> str:
    for term, token in SECRETS:
        expr = f"regexp_replace({expr}, {_sql_str(term)}, {_sql_str(token)}, 'gi')"
    return expr


def _strip_sql(expr: str) -> str:
    return f"trim({expr}, {WS_SQL})"


_EVENT_MSGS = """
  SELECT user_id, event_id, epoch_us(ts) // 1000 AS ts_ms,
         CASE WHEN event_type IN ('click', 'view') THEN 'other' ELSE 'me' END AS sender,
         event_type || ':' || CAST(event_id AS VARCHAR) AS text
  FROM events
"""

_EVENT_BLOCKS = f"""
  WITH m AS ({_EVENT_MSGS}),
  f AS (
    SELECT *, CASE WHEN lag(sender) OVER w IS NULL OR lag(sender) OVER w <> sender THEN 1 ELSE 0 END AS flag
    FROM m WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, event_id)
  ),
  r AS (
    SELECT *, CAST(sum(flag) OVER (PARTITION BY user_id ORDER BY ts_ms, event_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS block
    FROM f
  )
  SELECT user_id, block, any_value(sender) AS sender,
         string_agg(text, chr(10) ORDER BY ts_ms, event_id) AS text,
         min(ts_ms) AS first_ts, max(ts_ms) AS last_ts, count(*) AS n_messages
  FROM r GROUP BY user_id, block
"""


def _event_pairs_sql(gap_from: str) -> str:
    reply = "next_last_ts" if gap_from == "last" else "next_first_ts"
    return f"""
  WITH b AS ({_EVENT_BLOCKS}),
  n AS (
    SELECT *, lead(sender) OVER w AS next_sender, lead(text) OVER w AS next_text,
           lead(first_ts) OVER w AS next_first_ts, lead(last_ts) OVER w AS next_last_ts
    FROM b WINDOW w AS (PARTITION BY user_id ORDER BY block)
  )
  SELECT user_id, block, {_strip_sql('text')} AS "user", {_strip_sql('next_text')} AS assistant,
         last_ts AS user_ts, {reply} AS reply_ts
  FROM n
  WHERE sender = 'other' AND next_sender = 'me'
    AND {reply} - last_ts <= {P.DEFAULT_TIME_GAP_LIMIT}
    AND length({_strip_sql('text')}) >= 2 AND length({_strip_sql('next_text')}) >= 2
"""


_CONV_PAIRS = f"""
  WITH n AS (
    SELECT conv_id, turn, role, text,
           lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
    FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
  )
  SELECT conv_id, turn, {_strip_sql('text')} AS "user", {_strip_sql('next_text')} AS assistant
  FROM n
  WHERE role = 'user' AND next_role = 'assistant'
    AND length({_strip_sql('text')}) >= 2 AND length({_strip_sql('next_text')}) >= 2
"""

_CLEAN_TURNS = f"""
  WITH d AS (
    SELECT conv_id, turn, role, {_strip_sql('text')} AS dec FROM conversations
    WHERE text IS NOT NULL AND text <> '' AND NOT {_noise_sql('text', [])}
  ),
  r AS (
    SELECT conv_id, turn, role,
           {_strip_sql(f"regexp_replace(dec, {PHONE_SQL}, '[PHONE_NUMBER]', 'g')")} AS text
    FROM d WHERE length(dec) BETWEEN 2 AND 1000
  )
  SELECT conv_id, turn, CASE WHEN contains(coalesce(role, ''), 'assistant') THEN 'me' ELSE 'other' END AS sender,
         text, turn AS timestamp
  FROM r WHERE text <> ''
"""

_CONV_SAMPLES = f"""
  WITH c AS ({_CLEAN_TURNS}),
  f AS (
    SELECT *, CASE WHEN lag(sender) OVER w IS NULL OR lag(sender) OVER w <> sender THEN 1 ELSE 0 END AS flag
    FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY timestamp, turn)
  ),
  r AS (
    SELECT *, CAST(sum(flag) OVER (PARTITION BY conv_id ORDER BY timestamp, turn
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS block
    FROM f
  ),
  b AS (
    SELECT conv_id, block, any_value(sender) AS sender,
           string_agg(text, chr(10) ORDER BY timestamp, turn) AS text, max(timestamp) AS last_ts
    FROM r GROUP BY conv_id, block
  ),
  n AS (
    SELECT *, lead(sender) OVER w AS next_sender, lead(text) OVER w AS next_text, lead(last_ts) OVER w AS next_last_ts
    FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY block)
  )
  SELECT conv_id, block, {_strip_sql('text')} AS "user", {_strip_sql('next_text')} AS assistant
  FROM n
  WHERE sender = 'other' AND next_sender = 'me' AND next_last_ts - last_ts <= {P.DEFAULT_TIME_GAP_LIMIT}
    AND length({_strip_sql('text')}) >= 2 AND length({_strip_sql('next_text')}) >= 2
"""

_CONV_FP = f"""
  SELECT conv_id, turn,
         sha256('user:' || "user" || '||' || 'assistant:' || assistant || '||') AS fp_key
  FROM ({_CONV_PAIRS})
"""

_RECORD_LINES = """
  SELECT event_id, CASE event_id % 8
    WHEN 0 THEN props
    WHEN 1 THEN '{"messages":[{"role":"user","content":"' || event_type
                || '"},{"role":"assistant","content":"' || CAST(user_id AS VARCHAR) || '"}]}'
    WHEN 2 THEN 'NOT JSON ' || event_type
    WHEN 3 THEN '[' || props || ']'
    WHEN 4 THEN '{"messages":' || CAST(user_id AS VARCHAR) || '}'
    WHEN 5 THEN '{"messages":"' || event_type || '"}'
    WHEN 6 THEN '{"messages":[' || props || ',null]}'
    ELSE props || ' ' || event_type END AS line
  FROM events
"""

_RECORD_STATUS = f"""
  WITH l AS ({_RECORD_LINES}),
  t AS (
    SELECT event_id, line, json_valid(line) AS ok,
           CASE WHEN json_valid(line) THEN json_type(line) END AS root,
           CASE WHEN json_valid(line) THEN json_type(line, '$.messages') END AS mt
    FROM l
  ),
  s AS (
    SELECT event_id, line, mt, CASE
      WHEN NOT ok THEN 'MALFORMED_JSON'
      WHEN root <> 'OBJECT' THEN 'STRUCTURAL_INVALID'
      WHEN mt IS NULL THEN 'VALID'
      WHEN mt = 'ARRAY' THEN CASE WHEN coalesce(list_bool_and(list_transform(
             json_extract(line, '$.messages[*]'), lambda x: json_type(x) = 'OBJECT')), true)
           THEN 'VALID' ELSE 'STRUCTURAL_INVALID' END
      WHEN mt = 'OBJECT' AND json_extract(line, '$.messages')::VARCHAR = '{{}}' THEN 'VALID'
      WHEN mt = 'VARCHAR' AND json_extract_string(line, '$.messages') = '' THEN 'VALID'
      ELSE 'STRUCTURAL_INVALID' END AS status
    FROM t
  )
  SELECT event_id, status,
         CASE WHEN status = 'VALID' THEN coalesce(CASE WHEN mt = 'ARRAY' THEN array_to_string(list_transform(
             json_extract(line, '$.messages[*]'),
             lambda x: coalesce(json_extract_string(x, '$.role'), 'None') || ':'
                  || coalesce(json_extract_string(x, '$.content'), 'None') || '||'), '') END, '') END AS fp
  FROM s
"""

ORACLE_SQL: dict[str, str] = {
    "noise_filter": f"SELECT doc_id, text FROM documents WHERE NOT {_noise_sql('text', EXTRA_NOISE)}",
    "mojibake_repair": "SELECT doc_id, text FROM documents",
    "length_bounds": "SELECT doc_id, length(text) AS n_chars FROM documents WHERE length(text) BETWEEN 2 AND 1000",
    "secret_replace": f"SELECT doc_id, {_secrets_sql('text')} AS text FROM documents",
    "phone_redact": f"SELECT doc_id, regexp_replace(text, {PHONE_SQL}, '[PHONE_NUMBER]', 'g') AS text FROM documents",
    "scrub": f"""
      WITH d AS (
        SELECT doc_id, {_strip_sql('text')} AS dec FROM documents
        WHERE text IS NOT NULL AND text <> '' AND NOT {_noise_sql('text', ['###'])}
      ),
      r AS (
        SELECT doc_id, {_strip_sql(f"regexp_replace({_secrets_sql('dec')}, {PHONE_SQL}, '[PHONE_NUMBER]', 'g')")} AS text
        FROM d WHERE length(dec) BETWEEN 2 AND 1000
      )
      SELECT doc_id, text FROM r WHERE text <> ''
    """,
    "scrub_turns": f"""
      WITH d AS (
        SELECT conv_id, turn, {_strip_sql('text')} AS dec FROM conversations
        WHERE text IS NOT NULL AND text <> '' AND NOT {_noise_sql('text', [])}
      ),
      r AS (
        SELECT conv_id, turn, {_strip_sql(f"regexp_replace(dec, {PHONE_SQL}, '[PHONE_NUMBER]', 'g')")} AS text
        FROM d WHERE length(dec) BETWEEN 2 AND 1000
      )
      SELECT conv_id, turn, text FROM r WHERE text <> ''
    """,
    "sender_normalize": """
      SELECT conv_id, turn, CASE WHEN contains(role, 'assistant') THEN 'me' ELSE 'other' END AS sender
      FROM conversations
    """,
    "other_party": """
      SELECT conv_id, coalesce(CASE WHEN h = '' THEN 'other_user' ELSE h END, 'unknown_sender') AS other_party
      FROM (
        SELECT conv_id,
               lower(regexp_replace(arg_min(coalesce(role, ''), turn) FILTER (WHERE NOT contains(coalesce(role, ''), 'assistant')),
                                    '[^a-zA-Z0-9]', '', 'g')) AS h
        FROM conversations GROUP BY conv_id
      )
    """,
    "chrono_order": f"""
      SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, event_id) AS seq
      FROM ({_EVENT_MSGS})
    """,
    "merge_turns": f"""
      SELECT user_id, block AS turn, sender, text FROM ({_EVENT_BLOCKS})
    """,
    "merge_blocks": f"""
      SELECT user_id, block, sender, text, first_ts, last_ts, n_messages FROM ({_EVENT_BLOCKS})
    """,
    "reply_pairs": _event_pairs_sql("last"),
    "reply_pairs_first": _event_pairs_sql("first"),
    "conv_pairs": _CONV_PAIRS,
    "clean_turns": _CLEAN_TURNS,
    "conv_samples": _CONV_SAMPLES,
    "fingerprint": _CONV_FP,
    "samples_dedup": f"""
      SELECT conv_id, turn, fp_key FROM (
        SELECT *, row_number() OVER (PARTITION BY fp_key ORDER BY conv_id, turn) AS rn FROM ({_CONV_FP})
      ) WHERE rn = 1
    """,
    "dedup_first": """
      SELECT doc_id FROM (
        SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
      ) WHERE rn = 1
    """,
    "dedup_removed": """
      SELECT doc_id, 'DUPLICATE' AS reason FROM (
        SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
      ) WHERE rn > 1
    """,
    "structural_check": _RECORD_STATUS,
    "validation_counts": f"""
      WITH s AS ({_RECORD_STATUS}),
      d AS (
        SELECT CASE WHEN status = 'VALID' AND row_number() OVER (PARTITION BY status, fp ORDER BY event_id) > 1
                    THEN 'DUPLICATE' ELSE status END AS status
        FROM s
      )
      SELECT status, count(*) AS n FROM d GROUP BY status
    """,
    "doc_records": """
      WITH l AS (
        SELECT doc_id, json_object('messages', json_array(json_object('role', 'user', 'content', text))) AS line
        FROM documents
      ),
      f AS (
        SELECT doc_id, array_to_string(list_transform(json_extract(line, '$.messages[*]'),
                 lambda x: coalesce(json_extract_string(x, '$.role'), 'None') || ':'
                           || coalesce(json_extract_string(x, '$.content'), 'None') || '||'), '') AS fp
        FROM l
      )
      SELECT doc_id,
             CASE WHEN row_number() OVER (PARTITION BY fp ORDER BY doc_id) > 1 THEN 'DUPLICATE' ELSE 'VALID' END AS status,
             sha256(fp) AS fp_key
      FROM f
    """,
    "split_val": f"""
      SELECT doc_id FROM (
        SELECT doc_id, row_number() OVER (ORDER BY md5('{SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
               count(*) OVER () AS n
        FROM documents
      ) WHERE rn <= greatest(1, CAST(floor(n * CAST({SPLIT_FRACTION} AS DOUBLE)) AS BIGINT))
    """,
    "split_train": f"""
      SELECT doc_id FROM (
        SELECT doc_id, row_number() OVER (ORDER BY md5('{SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn,
               count(*) OVER () AS n
        FROM documents
      ) WHERE rn > greatest(1, CAST(floor(n * CAST({SPLIT_FRACTION} AS DOUBLE)) AS BIGINT))
    """,
    "dataset_counts": f"""
      WITH m AS ({_EVENT_MSGS}),
      b AS ({_EVENT_BLOCKS}),
      p AS ({_event_pairs_sql('last')}),
      nm AS (SELECT user_id, count(*) AS n_messages FROM m GROUP BY user_id),
      nb AS (SELECT user_id, count(*) AS n_blocks FROM b GROUP BY user_id),
      np AS (SELECT user_id, count(*) AS n_samples FROM p GROUP BY user_id)
      SELECT nm.user_id, n_messages, n_blocks, coalesce(n_samples, 0) AS n_samples
      FROM nm LEFT JOIN nb USING (user_id) LEFT JOIN np USING (user_id)
    """,
    **X.ORACLE_SQL,
    **Y.ORACLE_SQL,
}
