"""First-wins de-duplication without a window over the duplicate group.

A window ``row_number() over (partition by fp order by key)`` sends every
copy of a fingerprint to one task; if one record is copied a billion times,
one task gets them all. Instead:

1. ``groupBy(fp).agg(min(order key))`` -- partial aggregation collapses the
   copies on the map side, so each map task ships one row per fingerprint;
2. a left join of the rows with those minima on ``(fp, order key)``. The
   order key is unique per row, so the join key is too and hashes evenly
   however many copies a fingerprint has.

A row is the survivor when its ``(fp, order key)`` matches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mark_first(
    df: DataFrame,
    fp: str,
    order: Sequence[str],
    flag: str = "is_first",
) -> DataFrame:
    """Add boolean ``flag``: true for the first row (by ``order``) of each
    ``fp``. ``order`` must be unique per row. Rows with a NULL ``fp`` are
    never duplicates (flag true)."""
    order = list(order)
    # Group and join on non-nullable keys. A plain ``fp`` key lets Catalyst
    # infer "fp is not null" and push it, with the whole fingerprint
    # expression, below any repartition into the scan; NULL-safe equality
    # on the order columns would be rewritten into extra join keys. Structs
    # are never NULL keys, and NULL fields inside them compare equal.
    gk = F.struct(F.col(fp).isNull().alias("n"), F.col(fp).alias("v"))
    tagged = df.withColumn("_dp_gk", gk).withColumn("_dp_ok", F.struct(*[F.col(c) for c in order]))
    firsts = tagged.groupBy("_dp_gk").agg(F.min("_dp_ok").alias("_dp_min")).select(
        F.col("_dp_gk").alias("_dp_fgk"), "_dp_min", F.lit(True).alias("_dp_hit")
    )
    cond = [tagged["_dp_gk"] == firsts["_dp_fgk"], tagged["_dp_ok"] == firsts["_dp_min"]]
    joined = tagged.join(firsts, cond, "left")
    # NULL fingerprints are never duplicates.
    return joined.withColumn(flag, F.col(fp).isNull() | F.coalesce(F.col("_dp_hit"), F.lit(False))).drop(
        "_dp_gk", "_dp_ok", "_dp_fgk", "_dp_min", "_dp_hit"
    )


def first_wins(df: DataFrame, fp: str, order: Sequence[str]) -> DataFrame:
    """Rows that are the first of their fingerprint.

    Survivors only, so one aggregation does: a map task sends one row per
    fingerprint, and neither a join nor a second look at the input is needed.
    Rows of a NULL ``fp`` are groups of their own.
    """
    place = F.struct(*[F.col(c) for c in order])
    group = F.struct(F.col(fp).alias("v"), F.when(F.col(fp).isNull(), place).alias("o"))
    row = F.min_by(F.struct(*[F.col(c) for c in df.columns]), place)
    return df.groupBy(group.alias("_dp_g")).agg(row.alias("_dp_row")).select("_dp_row.*")


def duplicates(df: DataFrame, fp: str, order: Sequence[str]) -> DataFrame:
    """Rows that repeat an earlier row's fingerprint."""
    return mark_first(df, fp, order, "_dp_keep").where(~F.col("_dp_keep")).drop("_dp_keep")
