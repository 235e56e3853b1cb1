"""Reply pairs with texts fetched last, for keys whose texts are large.

Which blocks pair depends on senders, times and lengths only. So the ordered
scan runs over narrow rows without any text; the lengths of a block's merged
text follow from sums, and pairs are found from them. Only the messages of
blocks that pair are then looked up by row and joined to texts. A run of any
size that pairs with nothing is never merged, and no row holds more than the
texts of one pair.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.pairs import DEFAULT_TIME_GAP_LIMIT, MIN_PAIR_CHARS, next_block
from dialogprep.operators.sequence import Scan, scan_window
from dialogprep.operators.turns import EXPORT_KEY, EXPORT_ORDER, block_input
from dialogprep.session import ensure_checkpoint_dir

# Largest merged text of one side of a pair; a value must fit into a row.
MAX_TEXT_BYTES = 512 << 20

_ROW = "_dp_row"


def block_table(
    rows: DataFrame, key: Sequence[str], order: Sequence[Column | str], sender: str, timestamp: str, scan: Scan
) -> tuple[DataFrame, DataFrame]:
    """``(runs, blocks)`` of rows that carry ``_dp_chars`` and ``_dp_bytes`` in
    place of their text. Runs: key, row id, ``block``. Blocks: sender, times,
    and ``chars``, ``bytes`` of the text that merging would give."""
    names = [o for o in order if isinstance(o, str)]
    cols = dict.fromkeys([*key, *names, _ROW, sender, timestamp, "_dp_chars", "_dp_bytes"])
    runs = scan(rows.select(*cols), key, order, seq="_dp_seq", run_of=sender, run="block")
    joints = F.count(F.lit(1)) - 1  # line breaks between the messages
    blocks = runs.groupBy(*key, "block").agg(
        F.first(sender).alias("sender"),
        F.min_by(timestamp, "_dp_seq").alias("first_ts"),
        F.max_by(timestamp, "_dp_seq").alias("last_ts"),
        (F.sum("_dp_chars") + joints).alias("chars"),
        (F.sum("_dp_bytes") + joints).alias("bytes"),
    )
    return runs.select(*key, _ROW, "_dp_seq", "block"), blocks


def lean_pairs(
    df: DataFrame,
    key: Sequence[str] = EXPORT_KEY,
    order: Sequence[Column | str] = EXPORT_ORDER,
    time_gap_limit: int = DEFAULT_TIME_GAP_LIMIT,
    gap_from: str = "last",
    scan: Scan = scan_window,
    sender: str = "sender",
    text: str = "text",
    timestamp: str = "timestamp",
    max_text_bytes: int = MAX_TEXT_BYTES,
) -> DataFrame:
    """The pairs of ``reply_pairs(merge_blocks(df))``: key columns, ``block``,
    ``user``, ``assistant``, ``user_ts``, ``reply_ts``.

    Rows are fixed once in the checkpoint folder, so that a row's id means
    the same row in every step. A pair with a text over ``max_text_bytes``
    raises, naming the block: it fits into no row.
    """
    if gap_from not in ("last", "first"):
        raise ValueError("gap_from must be 'last' or 'first'")
    key = list(key)
    ensure_checkpoint_dir(df.sparkSession)
    # block_input strips each message and drops blank ones, so a merged text
    # has no white space at its ends: lengths add up
    rows = block_input(df, sender, text, timestamp).withColumn(_ROW, F.monotonically_increasing_id()).checkpoint(eager=True)
    narrow = rows.withColumn("_dp_chars", F.length(text)).withColumn("_dp_bytes", F.octet_length(text).cast("bigint")).drop(text)
    runs, blocks = block_table(narrow, key, order, sender, timestamp, scan)

    ahead = next_block(blocks, key, "block", ("sender", "first_ts", "last_ts", "chars", "bytes"), scan)
    reply_ts = F.col("next_last_ts") if gap_from == "last" else F.col("next_first_ts")
    paired = (
        (F.col("sender") == "other") & (F.col("next_sender") == "me")
        & (reply_ts - F.col("last_ts") <= F.lit(time_gap_limit))
        & (F.col("chars") >= MIN_PAIR_CHARS) & (F.col("next_chars") >= MIN_PAIR_CHARS)
    )
    largest = F.greatest("bytes", "next_bytes")
    fits = F.when(largest <= max_text_bytes, F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("a text of "), largest.cast("string"), F.lit(" bytes in block "), F.col("block").cast("string"), F.lit(" fits into no row")))
    )
    pairs = ahead.where(F.coalesce(paired, F.lit(False))).select(
        *key, "block", F.col("last_ts").alias("user_ts"), reply_ts.alias("reply_ts"), fits.cast("boolean").alias("_dp_fits")
    ).where("_dp_fits").drop("_dp_fits")

    # both blocks of a pair, then their rows, then the texts of these rows
    same_key = lambda a, b: [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in key]
    sides = pairs.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("_dp_side"))
    sides = sides.withColumn("_dp_at", F.col("block") + F.col("_dp_side"))
    on = [*same_key("r", "s"), F.col("r.block") == F.col("s._dp_at")]
    wanted = runs.alias("r").join(sides.alias("s"), on).select(
        *[F.col(f"s.{k}").alias(k) for k in key], F.col("s.block").alias("block"), "user_ts", "reply_ts", "_dp_side", _ROW, "_dp_seq"
    )
    said = wanted.join(rows.select(_ROW, F.col(text).alias("_dp_text")), _ROW)
    # one side's text at a time: a side is a group of its own
    one = said.groupBy(*key, "block", "user_ts", "reply_ts", "_dp_side").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_dp_seq", "_dp_text"))), lambda x: x["_dp_text"]), "\n").alias("t")
    )
    of = lambda side: F.max(F.when(F.col("_dp_side") == side, F.col("t")))
    return one.groupBy(*key, "block", "user_ts", "reply_ts").agg(of(0).alias("user"), of(1).alias("assistant")).select(
        *key, "block", "user", "assistant", "user_ts", "reply_ts"
    )
