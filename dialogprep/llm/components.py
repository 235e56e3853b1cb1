"""Connected components of an edge table by alternating stars.

Each round reconnects every vertex's larger neighbours to its smallest one
(large star), then its smaller neighbours likewise (small star), until the
edges are a star around the smallest vertex of each component. All steps are
partially aggregated groupings and equi-joins, so a hub with very many
neighbours is combined map-side and its join is one that AQE splits. No step
has more rows than there are edges: while these are few, they are gathered in
few partitions and the nearest vertices are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import broadcast_if_small, checkpointed, gathered

# Rows of (vertex, nearest vertex) that go to all tasks.
MAX_BROADCAST = 200_000


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"),
            F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)),
        ).first()
    )


def _nearest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(id, component)`` for every vertex that has an edge to another one.

    ``component`` is the smallest vertex that links reach. Null ends, loops
    and repeated edges are ignored; an empty edge table gives no rows.
    """
    e = (
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    e = checkpointed(e)
    before = _mark(e)
    while before[0]:
        n = int(before[0])
        e = gathered(e, n)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # every edge has two ends, and so has at most as many vertices again
        near = gathered(_nearest(both).select("u", F.least("u", "m").alias("m")), 2 * n)
        near = broadcast_if_small(near, MAX_BROADCAST, 2 * n)
        large = (
            both.where("v > u").join(near, "u")
            .where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        near = gathered(_nearest(large), n)
        small = large.join(broadcast_if_small(near, MAX_BROADCAST, n), "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = checkpointed(gathered(near.select("u", F.col("m").alias("v")).union(small).distinct(), n))
        now = _mark(e)
        if now == before:
            break
        before = now
    n = int(before[0])
    e = gathered(e, n)
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return gathered(e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots), 2 * n)


def merged_components(parts: DataFrame, edges: DataFrame, a: str, b: str) -> DataFrame:
    """The components ``(id, component)`` of ``parts`` after more edges.

    Only components that the edges join are looked at again, as vertices.
    """
    of = [parts.select(F.col("id").alias(e), F.col("component").alias(f"of_{e}")) for e in (a, b)]
    n_parts, n_edges = parts.count(), edges.count()
    known = gathered(edges.select(a, b).join(of[0], a, "left"), n_edges).join(of[1], b, "left")
    known = known.select(F.coalesce(f"of_{a}", a).alias("a"), F.coalesce(f"of_{b}", b).alias("b"))
    joined = checkpointed(connected_components(known, "a", "b"))
    # at most two vertices for each edge
    moved = joined.select(F.col("id").alias("component"), F.col("component").alias("to"))
    moved = broadcast_if_small(moved, MAX_BROADCAST, 2 * n_edges)
    kept = parts.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    more = joined.join(parts.select("id"), "id", "left_anti").select("id", "component")
    return gathered(kept.union(more), n_parts + 2 * n_edges)
