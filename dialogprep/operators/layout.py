"""Partition layout helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin rows over at least ``min_partitions`` partitions when the
    input has fewer (default: the cluster's default parallelism).

    CPU-heavy per-row text work (regexes, JSON parsing) runs in the scan's
    tasks; a small file with one row group is one task however many cores
    there are. An input that already has that many partitions is returned
    unchanged; one that has fewer is moved as a whole, text and all.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # sessions without RDD access (Spark Connect): leave as is
        return df
    if current >= target:
        return df
    return df.repartition(target)


def keep_nonnull(df: DataFrame, value, name: str) -> DataFrame:
    """Rows where ``value`` is not NULL, with ``value`` as column ``name``.

    The value passes through a generator (explode of a one-element array)
    rather than ``withColumn(...).where(isNotNull)``: Catalyst substitutes an
    aliased expression into a filter it pushes down, so an expensive value
    (the scrubbed text) would be computed twice per row, and the filter would
    move below :func:`spread` into the scan's tasks. A generator is
    evaluated once, where it stands, and the filter above it stays there.
    """
    from pyspark.sql import functions as F

    others = [c for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name)).where(F.col(name).isNotNull())


def filter_once(df: DataFrame, condition) -> DataFrame:
    """``df.where(condition)`` evaluated once per row after any spread (see
    :func:`keep_nonnull`)."""
    from pyspark.sql import functions as F

    marker = "_dp_keep"
    kept = keep_nonnull(df, F.when(condition, F.lit(True)), marker)
    return kept.drop(marker)
