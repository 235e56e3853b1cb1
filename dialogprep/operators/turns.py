"""Message-level rules: cleaning, chronological order, merging into turns.

Frames are keyed by a conversation column (any key columns) and ordered by
an explicit, total order (timestamp plus tie-breakers such as file name and
position), because Spark has no notion of "input order".
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.functions import text as T
from dialogprep.operators.sequence import CHUNK, KEY_SURROGATE, Scan, scan_window

EXPORT_KEY = ("conversation",)
EXPORT_ORDER = ("timestamp", "file_name", "pos")


def clean_messages(
    raw: DataFrame,
    my_name: str,
    secrets: Sequence[tuple[str, str]] = (),
    extra_noise: Iterable[str] | None = None,
    min_length: int = T.MIN_LENGTH,
    max_length: int = T.MAX_LENGTH,
    content: str = "content",
    sender_name: str = "sender_name",
    timestamp: str = "timestamp_ms",
    repair_sender: bool = False,
) -> DataFrame:
    """Raw export messages -> ``sender`` ('me'/'other'), ``text``, ``timestamp``.

    A missing or null sender counts as ''. A missing or null timestamp is 0;
    a present timestamp is read like Python's int() of a JSON number
    ("1000", "5.0" and "1e3" are accepted). A message with any other
    timestamp has no place in its conversation and is left out (see
    :func:`rejected_messages`). Messages whose scrubbed text is empty are
    dropped. Other columns are kept.
    """
    T.check_name(my_name)
    raw = raw.where(~_unreadable_time(timestamp))
    # Computed once per row, with the lower-cased and repaired text staged.
    out = T.scrub_staged(raw, content, "_dp_text", secrets, extra_noise, min_length, max_length)
    derived = {
        "sender": T.normalize_sender(sender_name, my_name, repair_sender),
        "text": F.col("_dp_text"),
        "timestamp": F.coalesce(parse_epoch_ms(F.col(timestamp)), F.lit(0).cast("bigint")),
    }
    inputs = {"_dp_text", content, sender_name, timestamp}
    kept = [c for c in out.columns if c not in inputs and c not in derived]
    return out.select(*kept, *[v.alias(k) for k, v in derived.items()])


def _unreadable_time(timestamp: str) -> Column:
    return F.col(timestamp).isNotNull() & parse_epoch_ms(F.col(timestamp)).isNull()


def with_bad_times(files: DataFrame) -> DataFrame:
    """Of parsed export files, those with a message whose timestamp is no
    number: the array is searched, not exploded."""
    return files.where(F.exists("messages", lambda m: m["timestamp_ms"].isNotNull() & parse_epoch_ms(m["timestamp_ms"]).isNull()))


def rejected_messages(raw: DataFrame, timestamp: str = "timestamp_ms") -> DataFrame:
    """``path, reason`` of raw export messages that can't be ordered: their
    timestamp is present but no number. The path ends in ``#<position>``."""
    place = F.concat(F.col("conversation"), F.lit("/"), F.col("file_name"), F.lit("#"), F.col("pos").cast("string"))
    return raw.where(_unreadable_time(timestamp)).select(place.alias("path"), F.lit("BAD_TIMESTAMP").alias("reason"))


def parse_epoch_ms(c: Column) -> Column:
    """String/number -> BIGINT ms without raising; NULL when not a number.

    Fractions are truncated toward zero like Python's int() of a float.
    """
    s = c.cast("string")
    dec = s.try_cast("decimal(38,9)")
    # Scientific notation ("1e3") may not parse as a decimal; go through double.
    whole = F.coalesce(dec, s.try_cast("double").try_cast("decimal(38,9)"))
    return whole.try_cast("bigint")


def chrono_order(
    df: DataFrame,
    key: Sequence[str] = EXPORT_KEY,
    order: Sequence[Column | str] = EXPORT_ORDER,
    seq: str = "seq",
    scan: Scan = scan_window,
) -> DataFrame:
    """Position of each message in its conversation (1-based, stable)."""
    return scan(df, key, order, seq=seq)


def block_input(df: DataFrame, sender: str = "sender", text: str = "text", timestamp: str = "timestamp") -> DataFrame:
    """Rows that may form blocks: non-null sender, text and timestamp, and a
    text that is not blank once stripped (the text becomes the stripped form).

    Where a column ``has_timestamp`` exists it decides instead of the
    timestamp: a message whose time is present but no number (null here)
    takes part in its block, and only pairs that need the time are dropped.
    """
    stripped = T.py_strip(F.col(text).cast("string"))
    timed = F.col("has_timestamp") if "has_timestamp" in df.columns else F.col(timestamp).isNotNull()
    return (
        df.where(F.col(sender).isNotNull() & F.col(text).isNotNull() & timed)
        .withColumn(text, stripped)
        .where(F.col(text) != "")
    )


def merge_turns(
    df: DataFrame,
    key: Sequence[str] = EXPORT_KEY,
    order: Sequence[Column | str] = EXPORT_ORDER,
    sender: str = "sender",
    text: str = "text",
    scan: Scan = scan_window,
) -> DataFrame:
    """Consecutive messages of one sender joined with a newline.

    No stripping and no filtering. Output: key columns, ``turn`` (1-based),
    ``sender``, ``text``.
    """
    runs = scan(df, key, order, seq="_dp_seq", run_of=sender, run="turn", keep_chunk=True)
    runs = _pre_aggregate(runs, key, "turn", sender, text)
    return runs.groupBy(*key, "turn").agg(
        F.first(sender).alias("sender"),
        _joined_text(text).alias("text"),
    )


def merge_blocks(
    df: DataFrame,
    key: Sequence[str] = EXPORT_KEY,
    order: Sequence[Column | str] = EXPORT_ORDER,
    sender: str = "sender",
    text: str = "text",
    timestamp: str = "timestamp",
    scan: Scan = scan_window,
) -> DataFrame:
    """Blocks of consecutive same-sender messages after :func:`block_input`.

    Output: key columns, ``block`` (1-based, dense), ``sender``, ``text``
    (newline-joined), ``first_ts`` and ``last_ts`` (timestamps of the first
    and last message; the block's time is the last one), ``n_messages``.
    """
    rows = block_input(df, sender, text, timestamp)
    runs = scan(rows, key, order, seq="_dp_seq", run_of=sender, run="block", keep_chunk=True)
    runs = _pre_aggregate(runs, key, "block", sender, text, timestamp)
    return runs.groupBy(*key, "block").agg(
        F.first(sender).alias("sender"),
        _joined_text(text).alias("text"),
        F.min_by("_dp_first_ts" if CHUNK in runs.columns else timestamp, "_dp_seq").alias("first_ts"),
        F.max_by(timestamp, "_dp_seq").alias("last_ts"),
        F.sum("_dp_n").cast("bigint").alias("n_messages") if CHUNK in runs.columns else F.count(F.lit(1)).alias("n_messages"),
    )


def _pre_aggregate(
    runs: DataFrame, key: Sequence[str], run: str, sender: str, text: str, timestamp: str | None = None
) -> DataFrame:
    """On the chunked path, merge each run within its chunk first.

    The chunk rows are already partitioned by (key, chunk), so this step
    needs no shuffle; the grouping by (key, run) that follows then moves one
    partial text per run and chunk instead of every message, and orders a
    few pieces instead of all of a long run's messages. ``_dp_seq`` of a
    piece is its first message's, which keeps the pieces in order.
    """
    if CHUNK not in runs.columns:
        return runs
    # Grouping on the key surrogate matches the rows' partitioning.
    aggs = [F.first(k).alias(k) for k in key] + [
        F.first(sender).alias(sender),
        _joined_text(text).alias(text),
        F.min("_dp_seq").alias("_dp_seq"),
    ]
    if timestamp:
        aggs += [
            F.min_by(timestamp, "_dp_seq").alias("_dp_first_ts"),
            F.max_by(timestamp, "_dp_seq").alias(timestamp),
            F.count(F.lit(1)).alias("_dp_n"),
        ]
    return runs.groupBy(KEY_SURROGATE, run, CHUNK).agg(*aggs).drop(KEY_SURROGATE)


def _joined_text(text: str) -> Column:
    ordered = F.array_sort(F.collect_list(F.struct(F.col("_dp_seq"), F.col(text).alias("t"))))
    return F.array_join(F.transform(ordered, lambda x: x["t"]), "\n")


def other_party(
    df: DataFrame,
    my_name: str,
    key: Sequence[str] = EXPORT_KEY,
    input_order: Sequence[str] = ("file_name", "pos"),
    sender_name: str = "sender_name",
) -> DataFrame:
    """Handle of the first sender (in input order) that is not ``my_name``.

    'unknown_sender' when every sender is ``my_name``; 'other_user' when the
    name has no ASCII letters or digits. An aggregate (partial on the map
    side), so a hot conversation costs one row per map task.
    """
    T.check_name(my_name)
    name = F.coalesce(F.col(sender_name), F.lit(""))
    first = F.min_by(
        F.when(~name.contains(my_name), name),
        F.when(~name.contains(my_name), F.struct(*[F.col(c) for c in input_order])),
    )
    return df.groupBy(*key).agg(
        F.coalesce(T.party_handle(first), F.lit("unknown_sender")).alias("other_party")
    )
