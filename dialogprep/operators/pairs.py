"""Adjacent (message, reply) pairs between blocks, and the sample record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.functions import text as T
from dialogprep.operators.sequence import Scan, scan_window

# Fixed value: the default reply window, 12 hours in milliseconds.
DEFAULT_TIME_GAP_LIMIT = 1_000 * 60 * 60 * 12

MIN_PAIR_CHARS = 2


def next_block(
    blocks: DataFrame,
    key: Sequence[str],
    block: str = "block",
    cols: Sequence[str] = ("sender", "text", "first_ts", "last_ts"),
    scan: Scan = scan_window,
) -> DataFrame:
    """Attach ``next_<col>`` of the following block of the same key."""
    return scan(blocks, key, [block], seq=None, nxt=cols)


def mark_pairs(
    blocks: DataFrame,
    key: Sequence[str],
    time_gap_limit: int = DEFAULT_TIME_GAP_LIMIT,
    gap_from: str = "last",
    block: str = "block",
    user_sender: str = "other",
    reply_sender: str = "me",
    scan: Scan = scan_window,
) -> DataFrame:
    """Every block, with ``is_pair`` (it starts a reply pair) and the pair's
    ``user``/``assistant`` texts and ``user_ts``/``reply_ts``.

    A pair is a ``user_sender`` block directly followed by a
    ``reply_sender`` block, the reply no later than ``time_gap_limit`` ms
    after the user block, both texts at least two characters once stripped.
    The gap is measured between the blocks' last messages (``gap_from=
    "last"``, the reference rule) or to the reply's first message
    (``"first"``).
    """
    if gap_from not in ("last", "first"):
        raise ValueError("gap_from must be 'last' or 'first'")
    nb = next_block(blocks, key, block, ("sender", "text", "first_ts", "last_ts"), scan)
    reply_ts = F.col("next_last_ts") if gap_from == "last" else F.col("next_first_ts")
    out = nb.select(
        *blocks.columns,
        T.py_strip("text").alias("user"),
        T.py_strip("next_text").alias("assistant"),
        F.col("last_ts").alias("user_ts"),
        reply_ts.alias("reply_ts"),
        F.col("next_sender"),
    )
    is_pair = (
        (F.col("sender") == user_sender)
        & (F.col("next_sender") == reply_sender)
        & (F.col("reply_ts") - F.col("user_ts") <= F.lit(time_gap_limit))
        & (F.length("user") >= MIN_PAIR_CHARS)
        & (F.length("assistant") >= MIN_PAIR_CHARS)
    )
    return out.withColumn("is_pair", F.coalesce(is_pair, F.lit(False))).drop("next_sender")


def reply_pairs(
    blocks: DataFrame,
    key: Sequence[str],
    time_gap_limit: int = DEFAULT_TIME_GAP_LIMIT,
    gap_from: str = "last",
    block: str = "block",
    user_sender: str = "other",
    reply_sender: str = "me",
    scan: Scan = scan_window,
) -> DataFrame:
    """The pairs of :func:`mark_pairs`. Output: key columns, ``block`` (the
    user block), ``user``, ``assistant``, ``user_ts``, ``reply_ts``."""
    marked = mark_pairs(blocks, key, time_gap_limit, gap_from, block, user_sender, reply_sender, scan)
    return marked.where("is_pair").select(*key, block, "user", "assistant", "user_ts", "reply_ts")


def sample_record(user: Column | str = "user", assistant: Column | str = "assistant") -> Column:
    """``{"messages": [{"role": "user", ...}, {"role": "assistant", ...}]}``."""
    u = F.col(user) if isinstance(user, str) else user
    a = F.col(assistant) if isinstance(assistant, str) else assistant
    return F.struct(
        F.array(
            F.struct(F.lit("user").alias("role"), u.alias("content")),
            F.struct(F.lit("assistant").alias("role"), a.alias("content")),
        ).alias("messages")
    )
