"""Ordered scans within a key, safe against one key holding most rows.

Everything the chat rules need in order -- row number, previous/next value,
numbering of runs of equal values ("gaps and islands") -- is a scan over the
rows of one key in a total order.

* Normal keys use one window ``partitionBy(key).orderBy(order)``: one
  shuffle on the key, one sort, and later ``groupBy(key, run)`` and window
  steps on the same key reuse that partitioning.
* A hot key (more rows than ``hot_threshold``) would put all its rows in
  one task. Its rows are range-partitioned on ``(key, order)`` instead, so
  a hot key is cut into contiguous chunks of bounded size that run in
  parallel. Each chunk is scanned locally; a per-chunk summary (one row per
  chunk, so its size is bounded by the chunk count) gives the carries: the
  rows before the chunk, the runs before it, the last value before it and
  the first value after it. The summary is joined back on (key, chunk),
  which the chunk rows are already partitioned by. The key is carried as a
  non-nullable struct surrogate, so a NULL key is a group like any other
  and plain equality keeps one partitioning through window, join and the
  callers' per-chunk pre-aggregation.

Hot keys are found with a count per key hash (partial aggregation on the
map side, so a hot key costs one row per map task, not its row count).
Detection only picks the plan: a key routed either way gets the same
result, so a hash collision or a threshold choice never changes output.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.session import ensure_checkpoint_dir

# A key with more rows than this is split into chunks.
DEFAULT_HOT_THRESHOLD = 4_000_000
# Target rows per chunk of a hot key.
DEFAULT_CHUNK_ROWS = 1_000_000
# Most chunks for all hot keys together; past it chunks grow beyond
# chunk_rows, keeping the per-chunk summary and the range sample small.
MAX_CHUNKS = 50_000
# Most hot-key hashes broadcast to route rows; beyond it a shuffle join is used.
MAX_BROADCAST_HOT_KEYS = 500_000
# Detection counts keys over a sample in which a key at the threshold
# expects this many rows (all rows when the threshold is smaller).
SAMPLE_ROWS_PER_HOT_KEY = 20_000

_KH = "_dp_kh"
_CHUNK = "_dp_chunk"
CHUNK = _CHUNK
# Non-nullable surrogate of the key used by the chunked scan.
KEY_SURROGATE = "_dp_kz"


@dataclass
class HotSplit:
    """Rows of normal keys, rows of hot keys, and how to chunk the latter."""

    normal: DataFrame
    hot: DataFrame | None
    chunks: int = 0


def key_hash(key: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in key])


def split_hot_keys(
    df: DataFrame,
    key: Sequence[str],
    hot_threshold: int = DEFAULT_HOT_THRESHOLD,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    counts_from: DataFrame | None = None,
    bytes_of: Column | None = None,
    hot_bytes: int | None = None,
) -> HotSplit:
    """Route rows of keys with more than ``hot_threshold`` rows aside, or,
    where ``bytes_of`` measures a row, with more than ``hot_bytes`` bytes.

    ``counts_from`` may be a cheaper frame with the same key values and at
    least as many rows per key (for example the table before a filter); a
    key that is hot there but not in ``df`` is still handled correctly.
    Runs one small job (the per-key counts reduced to the hot ones).
    """
    key = list(key)
    source = counts_from if counts_from is not None else df
    # Detection only chooses the plan (both paths give the same rows), so it
    # may count a Bernoulli sample: a key at the threshold expects
    # SAMPLE_ROWS_PER_HOT_KEY sampled rows, and keys reaching half of that
    # are taken as hot (missing a hot key then has a vanishing probability;
    # taking a smaller one as hot only costs the chunked path).
    rate = min(1.0, SAMPLE_ROWS_PER_HOT_KEY / max(1, hot_threshold))
    if rate < 1.0:
        source = source.sample(fraction=rate, seed=17)
        cutoff = hot_threshold * rate / 2
    else:
        cutoff = hot_threshold
    heavy = F.lit(False)
    size = F.lit(0).cast("bigint")
    if bytes_of is not None and hot_bytes:
        # a sampled sum is that of many rows or of few large ones: half the
        # bound is taken as too much, so that few heavy keys are missed
        size = F.sum(bytes_of)
        heavy = F.col("_dp_size") > (hot_bytes * rate / 2 if rate < 1.0 else hot_bytes)
    counts = source.groupBy(key_hash(key).alias(_KH)).agg(F.count(F.lit(1)).alias("_dp_n"), size.alias("_dp_size"))
    hot = counts.where((F.col("_dp_n") > cutoff) | heavy).select(_KH, (F.col("_dp_n") / F.lit(rate)).alias("_dp_n"))
    # One small job in the common case (no hot key): the number of hot keys
    # and their rows. The hot set is at most rows / hot_threshold keys; it
    # is broadcast only when within the bound (8 bytes a key).
    summary = hot.agg(F.count(F.lit(1)).alias("keys"), F.sum("_dp_n").alias("rows")).first()
    n_keys = int(summary["keys"] or 0)
    if n_keys == 0:
        return HotSplit(normal=df, hot=None)
    hot_rows = int(math.ceil(summary["rows"] or 0))
    # One fixed set of hot keys for both branches: a sample drawn again could
    # differ, and a key's rows would be in both branches or in neither.
    ensure_checkpoint_dir(df.sparkSession)
    keys_df = hot.select(_KH).checkpoint(eager=True)
    n_keys = keys_df.count()
    if n_keys <= MAX_BROADCAST_HOT_KEYS:
        keys_df = F.broadcast(keys_df)
    chunks = min(MAX_CHUNKS, max(2, math.ceil(hot_rows / max(1, chunk_rows))))
    tagged = df.withColumn(_KH, key_hash(key))
    normal = tagged.join(keys_df, _KH, "left_anti").drop(_KH)
    hot_df = tagged.join(keys_df, _KH, "left_semi").drop(_KH)
    return HotSplit(normal=normal, hot=hot_df, chunks=chunks)


def _not_same(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def scan_window(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    seq: str | None = "seq",
    run_of: str | None = None,
    run: str = "run",
    prev: Sequence[str] = (),
    nxt: Sequence[str] = (),
    keep_chunk: bool = False,
) -> DataFrame:
    """One window per key: row number, runs of equal ``run_of``, lag, lead.

    ``keep_chunk`` is accepted for symmetry with :func:`scan_chunked`; the
    window scan has no chunks.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    out = df
    if seq:
        out = out.withColumn(seq, F.row_number().over(w))
    for c in prev:
        out = out.withColumn(f"prev_{c}", F.lag(c).over(w))
    for c in nxt:
        out = out.withColumn(f"next_{c}", F.lead(c).over(w))
    if run_of:
        flag = F.when(_not_same(F.col(run_of), F.lag(run_of).over(w)), 1).otherwise(0)
        # The first row of a key has no previous row: lag is NULL, and a
        # NULL-safe comparison of a non-null value with NULL starts a run.
        first = F.row_number().over(w) == 1
        out = out.withColumn("_dp_flag", F.when(first, 1).otherwise(flag))
        out = out.withColumn(
            run,
            F.sum("_dp_flag").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        ).drop("_dp_flag")
    return out


def scan_chunked(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    chunks: int,
    seq: str | None = "seq",
    run_of: str | None = None,
    run: str = "run",
    prev: Sequence[str] = (),
    nxt: Sequence[str] = (),
    keep_chunk: bool = False,
) -> DataFrame:
    """Same output as :func:`scan_window`, with each key cut into chunks.

    ``order`` must be a total order within the key (ties broken), as for
    the window form; otherwise neither form is deterministic. With
    ``keep_chunk`` the chunk id and the key surrogate stay as columns
    ``CHUNK`` and ``KEY_SURROGATE`` (rows are partitioned by both), for
    pre-aggregation by the caller without another shuffle.
    """
    key = list(key)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    # The scan runs on one non-nullable surrogate of the key (a NULL key is
    # a group too): plain equality on it keeps every step below on the same
    # (key, chunk) partitioning. NULL-safe equality (<=>) as a join key would
    # be rewritten into other expressions and re-shuffle the chunk rows.
    kz = KEY_SURROGATE
    keyed = df.withColumn(kz, F.struct(*[F.col(k).isNull() for k in key], *[F.col(k) for k in key]))
    # Range partitioning cuts a hot key into contiguous chunks. The bounds
    # come from a sample taken when the exchange runs, so two evaluations
    # could disagree; the chunk ids are therefore fixed once in a reliable
    # checkpoint (the shared spark.checkpoint.dir), which the summary and
    # the rows below both read. It also cuts the lineage for this branch.
    ensure_checkpoint_dir(df.sparkSession)
    chunked = (
        keyed.repartitionByRange(chunks, *[F.col(k) for k in key], *order_cols)
        .withColumn(_CHUNK, F.spark_partition_id())
        .checkpoint(eager=True)
    )
    wl = Window.partitionBy(kz, _CHUNK).orderBy(*order_cols)
    local = chunked.withColumn("_dp_lrn", F.row_number().over(wl))
    for c in prev:
        local = local.withColumn(f"_dp_lprev_{c}", F.lag(c).over(wl))
    for c in nxt:
        local = local.withColumn(f"_dp_lnext_{c}", F.lead(c).over(wl))
    if run_of:
        lflag = F.when(
            (F.col("_dp_lrn") == 1) | _not_same(F.col(run_of), F.lag(run_of).over(wl)), 1
        ).otherwise(0)
        local = local.withColumn("_dp_lflag", lflag).withColumn(
            "_dp_lrun",
            F.sum("_dp_lflag").over(wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        )

    # One row per (key, chunk): the carries each chunk needs from its
    # neighbours.
    aggs = [F.count(F.lit(1)).alias("_dp_n")]
    if run_of:
        aggs += [
            F.max("_dp_lrun").alias("_dp_runs"),
            F.min_by(run_of, "_dp_lrn").alias("_dp_first_v"),
            F.max_by(run_of, "_dp_lrn").alias("_dp_last_v"),
        ]
    for c in prev:
        aggs.append(F.max_by(c, "_dp_lrn").alias(f"_dp_last_{c}"))
    for c in nxt:
        aggs.append(F.min_by(c, "_dp_lrn").alias(f"_dp_first_{c}"))
    summary = local.groupBy(kz, _CHUNK).agg(*aggs)

    wc = Window.partitionBy(kz).orderBy(_CHUNK)
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    summary = summary.withColumn("_dp_seq_off", F.coalesce(F.sum("_dp_n").over(before), F.lit(0)))
    for c in prev:
        summary = summary.withColumn(f"_dp_cprev_{c}", F.lag(f"_dp_last_{c}").over(wc))
    for c in nxt:
        summary = summary.withColumn(f"_dp_cnext_{c}", F.lead(f"_dp_first_{c}").over(wc))
    if run_of:
        first_chunk = F.lag(_CHUNK).over(wc).isNull()
        prev_last = F.lag("_dp_last_v").over(wc)
        first_true = F.when(first_chunk | _not_same(F.col("_dp_first_v"), prev_last), 1).otherwise(0)
        summary = summary.withColumn("_dp_first_true", first_true).withColumn(
            "_dp_adj", F.col("_dp_runs") - 1 + F.col("_dp_first_true")
        )
        summary = summary.withColumn("_dp_run_off", F.coalesce(F.sum("_dp_adj").over(before), F.lit(0)))
    carry_cols = ["_dp_n", "_dp_seq_off"]
    carry_cols += [f"_dp_cprev_{c}" for c in prev] + [f"_dp_cnext_{c}" for c in nxt]
    if run_of:
        carry_cols += ["_dp_first_true", "_dp_run_off"]
    # One row per chunk. No broadcast hint: the chunk rows are already
    # hash-partitioned on (key, chunk) by the local window, so a join on
    # that key moves only the summary; AQE still broadcasts it when its
    # measured size is small.
    carries = summary.select(kz, _CHUNK, *carry_cols)

    out = local.join(carries, [kz, _CHUNK], "inner")
    lrn = F.col("_dp_lrn")
    if seq:
        out = out.withColumn(seq, F.col("_dp_seq_off") + lrn)
    for c in prev:
        out = out.withColumn(f"prev_{c}", F.when(lrn == 1, F.col(f"_dp_cprev_{c}")).otherwise(F.col(f"_dp_lprev_{c}")))
    for c in nxt:
        last = lrn == F.col("_dp_n")
        out = out.withColumn(f"next_{c}", F.when(last, F.col(f"_dp_cnext_{c}")).otherwise(F.col(f"_dp_lnext_{c}")))
    if run_of:
        out = out.withColumn(run, F.col("_dp_run_off") + F.col("_dp_lrun") - 1 + F.col("_dp_first_true"))
    keep = list(df.columns) + ([seq] if seq else []) + [f"prev_{c}" for c in prev]
    keep += [f"next_{c}" for c in nxt] + ([run] if run_of else [])
    if keep_chunk:
        keep += [_CHUNK, kz]
    return out.select(*keep)


def ordered_scan(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[Column | str],
    seq: str | None = "seq",
    run_of: str | None = None,
    run: str = "run",
    prev: Sequence[str] = (),
    nxt: Sequence[str] = (),
    hot_threshold: int = DEFAULT_HOT_THRESHOLD,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    counts_from: DataFrame | None = None,
) -> DataFrame:
    """Window scan for normal keys, chunked scan for hot keys, unioned."""
    kw = dict(seq=seq, run_of=run_of, run=run, prev=prev, nxt=nxt)
    return by_hotness(
        df, key, lambda part, scan: scan(part, key, order, **kw), hot_threshold, chunk_rows, counts_from
    )


Scan = Callable[..., DataFrame]


def by_hotness(
    df: DataFrame,
    key: Sequence[str],
    fn: Callable[[DataFrame, Scan], DataFrame],
    hot_threshold: int | None = DEFAULT_HOT_THRESHOLD,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    counts_from: DataFrame | None = None,
    hot_fn: Callable[[DataFrame, Scan], DataFrame] | None = None,
    bytes_of: Column | None = None,
    hot_bytes: int | None = None,
) -> DataFrame:
    """Run ``fn(rows, scan)`` on normal keys with the window scan and on hot
    keys (``hot_fn`` if given) with the chunked scan, and union the two results.

    ``fn`` is a whole chain of steps (messages -> blocks -> pairs), so the
    split is decided once and each branch keeps its own partitioning.
    ``hot_threshold=None`` skips the detection job and uses the window scan
    for every key (for inputs known to have no key too big for one task).
    """
    if hot_threshold is None:
        return fn(df, scan_window)
    split = split_hot_keys(df, key, hot_threshold, chunk_rows, counts_from, bytes_of, hot_bytes)
    normal = fn(split.normal, scan_window)
    if split.hot is None:
        return normal
    chunked = functools.partial(_scan_chunked_kw, chunks=split.chunks)
    return normal.unionByName((hot_fn or fn)(split.hot, chunked))


def _scan_chunked_kw(df, key, order, chunks, **kw):
    return scan_chunked(df, key, order, chunks, **kw)
