"""Exact, seeded train/validation split without a global sort.

Rows are ordered by a pseudo-random key ``md5(seed + ":" + row key)`` (ties
by a unique BIGINT column); the first ``k = max(1, int(n * fraction))`` rows
go to validation, the rest to training.

``orderBy(h).limit(k)`` would bring k rows to one task, and k grows with n.
Instead the k-th key is found by radix selection: count rows per next three
hex digits of ``h`` among the rows that share the prefix chosen so far
(an aggregate with at most 4096 output rows per round), keep the digit whose
cumulative count reaches the remaining rank, and repeat until the candidate
group is small enough to order directly. If many rows share one full hash
(identical lines), the same selection continues on the tie column's bits.
Both outputs are then one filter against the threshold.
"""

from __future__ import annotations

import logging
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.operators.sequence import ordered_scan
from dialogprep.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

# Candidate groups at most this big are ordered directly (bounded limit).
DIRECT_LIMIT = 100_000
_HEX_DIGITS = 3


@dataclass
class SplitResult:
    train: DataFrame
    val: DataFrame
    n: int
    k: int
    seed: int
    # all rows once, with ``side`` ('train' or 'val'); for a single write
    sides: DataFrame | None = None
    # whether a row of this key, with the smallest tie, is in val
    decides: Callable[[Column], Column] | None = None


def check_fraction(val_fraction: float) -> None:
    """Both sides need a share: exactly 0 or 1 is refused, as is NaN."""
    share = float(val_fraction)
    if share <= 0.0 or share >= 1.0 or share != share:
        raise ValueError(f"the validation share must lie strictly between 0 and 1 (val_fraction={val_fraction!r})")


def split_key(seed: int, row_key: Column) -> Column:
    """The pseudo-random order key: md5 hex of ``"<seed>:<row key>"``."""
    # A NULL key hashes as the string "\0", so no row drops out of both sides.
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(row_key.cast("string"), F.lit("\0"))))


def val_count(n: int, val_fraction: float) -> int:
    # Float truncation, as int(n * fraction) does.
    return 0 if n == 0 else max(1, int(n * val_fraction))


def _pick(rows: list, field: str, rank: int) -> tuple[object, int, int]:
    """Bucket holding the rank-th row; returns (bucket, rank inside it, size)."""
    cum = 0
    for r in sorted(rows, key=lambda r: r[field]):
        if cum + r["c"] >= rank:
            return r[field], rank - cum, r["c"]
        cum += r["c"]
    raise ValueError("rank beyond the row count")


def _kth(df: DataFrame, h: str, tie: str, k: int, n: int) -> tuple[str, int]:
    """(hash, tie) of the k-th row (1-based) in (h, tie) order, n rows."""
    prefix, rank, total = "", k, n
    cand = df
    # Narrow on hash digits.
    while total > DIRECT_LIMIT and len(prefix) < 32:
        width = min(_HEX_DIGITS, 32 - len(prefix))
        digit = F.substring(F.col(h), len(prefix) + 1, width)
        rows = cand.groupBy(digit.alias("d")).agg(F.count(F.lit(1)).alias("c")).collect()
        d, rank, total = _pick(rows, "d", rank)
        prefix += d
        cand = df.where(F.col(h).startswith(prefix))
    # Many rows share one full hash (identical keys): narrow on tie bits.
    for shift in (52, 40, 28, 16, 4, 0):
        if total <= DIRECT_LIMIT:
            break
        bucket = F.shiftright(F.col(tie), shift)
        rows = cand.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("c")).collect()
        b, rank, total = _pick(rows, "b", rank)
        cand = cand.where(bucket == F.lit(b))
    top = cand.select(h, tie).orderBy(h, tie).limit(rank).collect()
    last = top[-1]
    return last[h], last[tie]


def split(
    df: DataFrame,
    row_key: Column | str,
    tie: str,
    val_fraction: float = 0.05,
    seed: int | None = None,
) -> SplitResult:
    """Split ``df`` into (train, val) with exactly ``k`` validation rows.

    ``row_key`` is hashed with the seed; ``tie`` is a unique, non-NULL BIGINT
    column ordering rows with equal hashes. Without a seed one is drawn and logged.
    Runs a count and a few small aggregate jobs; the returned frames are
    lazy filters of ``df``.
    """
    check_fraction(val_fraction)
    if seed is None:
        seed = random.SystemRandom().randrange(2**31)
        log.info("split seed %d", seed)
    key = F.col(row_key) if isinstance(row_key, str) else row_key
    hashed = df.withColumn("_dp_h", split_key(seed, key))
    n = hashed.count()
    k = val_count(n, val_fraction)
    if k == 0:
        empty = hashed.where(F.lit(False)).drop("_dp_h")
        return SplitResult(train=empty, val=empty, n=n, k=0, seed=seed)
    narrow = hashed.select("_dp_h", tie)
    if n > DIRECT_LIMIT:
        # The selection rounds each read every row's key; a checkpoint of
        # the narrow (hash, tie) projection spares re-reading and re-hashing
        # the source (whole text lines for a JSONL split) every round.
        ensure_checkpoint_dir(df.sparkSession)
        narrow = narrow.checkpoint(eager=True)
    h_k, t_k = _kth(narrow, "_dp_h", tie, k, n)
    in_val = (F.col("_dp_h") < F.lit(h_k)) | ((F.col("_dp_h") == F.lit(h_k)) & (F.col(tie) <= F.lit(t_k)))
    in_val = F.coalesce(in_val, F.lit(False))
    val = hashed.where(in_val).drop("_dp_h")
    train = hashed.where(~in_val).drop("_dp_h")
    return SplitResult(
        train=train, val=val, n=n, k=k, seed=seed, decides=lambda key: split_key(seed, key) <= F.lit(h_k)
    )


def split_lines(
    df: DataFrame,
    line: str,
    place: Sequence[str],
    val_fraction: float = 0.05,
    seed: int | None = None,
    max_broadcast: int = 500_000,
) -> SplitResult:
    """:func:`split` for rows whose ``line`` may repeat.

    The order key hashes the line and its occurrence number, so each copy
    of a line falls on its own and the split does not depend on the layout.
    Which of several equal rows carries which number makes no difference to
    their text; ``place`` (a unique order of rows) only fixes it.

    Lines are counted by hash (combined map-side); a line that occurs once
    is decided in place by the threshold. Only lines of which some copies
    are in and some out need their rows numbered: those rows alone go
    through the ordered scan, which splits hot lines into chunks.
    """
    check_fraction(val_fraction)
    if seed is None:
        seed = random.SystemRandom().randrange(2**31)
        log.info("split seed %d", seed)
    ensure_checkpoint_dir(df.sparkSession)
    hashed = df.withColumn("_dp_line", F.md5(F.coalesce(F.col(line).cast("string"), F.lit("\0"))))
    counts = hashed.groupBy("_dp_line").agg(F.count(F.lit(1)).alias("_dp_n")).checkpoint(eager=True)
    # millions of copies of one line are numbered by several rows
    blocks = F.explode(F.sequence(F.lit(0), F.expr("(_dp_n - 1) div 100000")))
    numbered = counts.withColumn("_dp_b", blocks)
    last = F.least("_dp_n", (F.col("_dp_b") + 1) * 100_000)
    numbered = numbered.select("_dp_line", "_dp_n", F.explode(F.sequence(F.col("_dp_b") * 100_000 + 1, last)).alias("_dp_i"))
    own_key = lambda i: F.concat(F.col("_dp_line"), F.lit(":"), i.cast("string"))
    keyed = numbered.withColumn("_dp_key", own_key(F.col("_dp_i"))).withColumn("_dp_tie", F.lit(0).cast("bigint"))
    chosen = split(keyed, "_dp_key", "_dp_tie", val_fraction, seed)
    if chosen.k == 0:
        nothing = df.where(F.lit(False))
        return SplitResult(train=nothing, val=nothing, n=chosen.n, k=0, seed=seed, sides=nothing.withColumn("side", F.lit("train")))
    repeated = (
        chosen.val.where("_dp_n > 1").groupBy("_dp_line").agg(F.count(F.lit(1)).alias("_dp_in"))
        .join(counts.where("_dp_n > 1"), "_dp_line", "right").checkpoint(eager=True)
    )
    few = repeated.count() <= max_broadcast
    rows = hashed.join(F.broadcast(repeated) if few else repeated, "_dp_line", "left")
    whole = F.coalesce("_dp_in", F.lit(0))
    partly = F.coalesce((whole > 0) & (whole < F.col("_dp_n")), F.lit(False))
    single = F.col("_dp_n").isNull() & chosen.decides(own_key(F.lit(1)))
    decided = rows.where(~partly).withColumn("_dp_val", single | F.coalesce(whole == F.col("_dp_n"), F.lit(False)))
    mixed = ordered_scan(rows.where(partly), ["_dp_line"], place, seq="_dp_seq")
    # the rows' own order stands for the numbers that were chosen: of equal
    # rows, as many are in as there were numbers chosen
    mixed = mixed.withColumn("_dp_val", F.col("_dp_seq") <= F.col("_dp_in")).drop("_dp_seq")
    every = decided.unionByName(mixed)
    extra = ["_dp_line", "_dp_n", "_dp_in", "_dp_val"]
    return SplitResult(
        train=every.where(~F.col("_dp_val")).drop(*extra), val=every.where("_dp_val").drop(*extra), n=chosen.n, k=chosen.k, seed=seed,
        sides=every.withColumn("side", F.when(F.col("_dp_val"), "val").otherwise("train")).drop(*extra),
    )
