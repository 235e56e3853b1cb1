"""Near-duplicate embeddings by int8 tile products (operator 2).

Equal vectors are one node from the start. Nodes are dealt into tiles; each
pair of tiles is one unit of work. In a tile the unit vectors are quantised
to int8 with a scale of their own, and the exact length of what quantising
lost, ``e``, is kept per vector. For two unit vectors

    |x.y - x'.y'| <= e_x |y'| + e_y |x'| + e_x e_y

so the integer product of the quantised vectors decides every pair that lies
farther than that bound from the threshold; only the pairs in between are
computed again, from the stored vectors in double precision. Integer products
run as float32 matrix products over blocks of 1040 columns, whose sums stay
under 2^24 and so are exact; blocks add up in float64. Vectors of floats stay
floats, all others are doubles.

A tile pair returns, per vector, the number of links and one link to the root
of its local component: never the linked pairs themselves. Components come
from those links by alternating stars.

All distinct vectors are compared, which is quadratic in their number; tiles
bound the memory of a task and pairs of tiles spread over the cluster.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components have no links and are their own component; vectors of
different lengths do not link; rows that share a ``vec_id`` count as rows; a
null ``vec_id`` takes part and gets the component of its links, null if it
has none; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import arrow_map, checkpointed
from dialogprep.llm.components import connected_components

_TILE = "tile long, nodes binary, copies binary, scales binary, errors binary, codes binary, vectors binary"


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale per vector, and the length of the residual (with
    room for the rounding of computing it)."""
    scale = np.abs(unit).max(axis=1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    lost = np.linalg.norm(unit - codes * scale[:, None], axis=1)
    return codes, scale, lost * (1 + 1e-9) + 1e-12


BLOCK = (1 << 24) // (127 * 127)  # columns whose products of codes add up exactly in float32


def _products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact products of the rows of int8 codes, which come as float32."""
    if x.shape[1] <= BLOCK:
        return x @ y.T
    out = np.zeros((len(x), len(y)))
    for k in range(0, x.shape[1], BLOCK):
        out += x[:, k : k + BLOCK] @ y[:, k : k + BLOCK].T
    return out


def _scaled(raw: np.ndarray) -> np.ndarray:
    """Doubles, each row by a power of two so that squares neither overflow nor vanish."""
    wide = raw.astype(np.float64)
    return np.ldexp(wide, -np.frexp(np.abs(wide).max(axis=1))[1][:, None])


def _units(raw: np.ndarray) -> np.ndarray:
    wide = _scaled(raw)
    return wide / np.linalg.norm(wide, axis=1)[:, None]


def _tiles(classes: DataFrame, tile_rows: int) -> DataFrame:
    """One row per tile; a tile has vectors of one length only."""
    sizes = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}  # one row per length
    tiles, first = F.lit(0), 0
    for dim, n in sorted(sizes.items()):
        count = -(-n // tile_rows)
        tiles = F.when(F.col("dim") == dim, F.lit(first) + F.pmod(F.xxhash64("node"), F.lit(count))).otherwise(tiles)
        first += count
    dealt = classes.withColumn("tile", tiles.cast("long")).repartition("tile").sortWithinPartitions("tile", "node")

    def bundle(tile, rows):
        nodes, copies, vectors = (np.concatenate(c) for c in zip(*rows))
        vectors = vectors.reshape(len(nodes), -1)
        codes, scale, lost = quantise(_units(vectors))
        blobs = (nodes, copies, scale, lost, codes, vectors)
        return pa.RecordBatch.from_pydict(
            {"tile": [tile]} | {n: [x.tobytes()] for n, x in zip(("nodes", "copies", "scales", "errors", "codes", "vectors"), blobs)}
        )

    def run(batches):
        at, rows = None, []
        for batch in batches:
            tile = batch.column(0).to_numpy()
            cuts = [0, *(np.nonzero(np.diff(tile))[0] + 1).tolist(), len(tile)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi == lo:
                    continue
                if tile[lo] != at and at is not None:
                    yield bundle(at, rows)
                    rows = []
                at = int(tile[lo])
                part = batch.slice(lo, hi - lo)
                rows.append((part.column(1).to_numpy(), part.column(2).to_numpy(), part.column(3).flatten().to_numpy()))
        if at is not None:
            yield bundle(at, rows)

    return arrow_map(dealt.select("tile", "node", "copies", "embedding"), run, _TILE)


class _Tile:
    def __init__(self, row: dict):
        self.nodes = np.frombuffer(row["nodes"], np.int64)
        self.copies = np.frombuffer(row["copies"], np.int64)
        self.scale = np.frombuffer(row["scales"], np.float64)
        self.lost = np.frombuffer(row["errors"], np.float64)
        n = len(self.nodes)
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(n, -1).astype(np.float32)
        self.vectors = np.frombuffer(row["vectors"], f"f{len(row['vectors']) // self.codes.size}").reshape(n, -1)
        self.length = self.scale * np.sqrt((self.codes.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-12)


def linked(x: _Tile, y: _Tile, lo: int, hi: int, threshold: float):
    """Index pairs ``(i, j)`` of linked vectors, ``lo <= i < hi`` of ``x``."""
    product = _products(x.codes[lo:hi], y.codes)
    # below this no pair of the row can reach the threshold
    reach = threshold - x.lost[lo:hi] * y.length.max() - (x.length[lo:hi] + x.lost[lo:hi]) * y.lost.max()
    least = np.where(reach > 0, reach / (x.scale[lo:hi] * y.scale.max()), -np.inf)
    i, j = np.nonzero(product >= np.floor(least)[:, None].astype(product.dtype))
    near = product[i, j].astype(np.float64) * x.scale[lo + i] * y.scale[j]
    i += lo
    bound = x.lost[i] * y.length[j] + y.lost[j] * x.length[i] + x.lost[i] * y.lost[j] + 1e-12
    sure = near - bound >= threshold
    open_ = np.nonzero(~sure & (near + bound >= threshold))[0]
    for k in range(0, len(open_), 20_000):
        some = open_[k : k + 20_000]
        a, b = _scaled(x.vectors[i[some]]), _scaled(y.vectors[j[some]])
        cosine = np.einsum("nd,nd->n", a, b) / (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1))
        sure[some] = cosine >= threshold
    return i[sure], j[sure]


def _meet(x: _Tile, y: _Tile, same: bool, threshold: float, rows: int = 512):
    """Per touched vector of the two tiles: node, links, root of its local
    component."""
    n, m = len(x.nodes), len(y.nodes)
    links = np.zeros(n + m, np.int64)
    label = np.arange(n + m)
    shift = 0 if same else n
    for lo in range(0, n, rows):
        i, j = linked(x, y, lo, min(n, lo + rows), threshold)
        if same:
            i, j = i[i != j], j[i != j]  # both orders of a pair are here
        np.add.at(links, i, y.copies[j])
        if not same:
            np.add.at(links, n + j, x.copies[i])
        heads = np.nonzero(np.diff(i, prepend=-1))[0]
        for a, b in zip(heads, [*heads[1:], len(i)]):
            joined = np.unique(np.append(label[j[a:b] + shift], label[i[a]]))
            if len(joined) > 1:
                label[np.isin(label, joined[1:])] = joined[0]
    nodes = np.concatenate([x.nodes, y.nodes])
    touched = np.nonzero(links)[0]
    return nodes[touched], links[touched], nodes[label[touched]]


def _links(tiles: DataFrame, threshold: float) -> DataFrame:
    """``(node, links, root)`` of every pair of tiles of equal dimension."""
    n = tiles.agg(F.coalesce(F.max("tile") + 1, F.lit(0))).first()[0]
    width = max(n, 1)
    # a tile goes to the pairs (i, tile), i <= tile, and (tile, j), j > tile
    partner = F.explode(F.sequence(F.lit(0), F.lit(width - 1)))
    sent = tiles.select("*", partner.alias("other")).withColumn(
        "pair", F.least("tile", "other") * width + F.greatest("tile", "other")
    )
    dealt = sent.drop("other").repartition("pair").sortWithinPartitions("pair", "tile")
    names = ["tile", "nodes", "copies", "scales", "errors", "codes", "vectors", "pair"]

    def run(batches):
        first = None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in names}
                i, j = divmod(row["pair"], width)
                if i != j and row["tile"] == i:
                    first = _Tile(row)
                    continue
                y = _Tile(row)
                x = y if i == j else first
                if x.codes.shape[1] != y.codes.shape[1]:
                    continue
                out = _meet(x, y, i == j, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["node", "links", "root"])

    return arrow_map(dealt.select(*names), run, "node long, links long, root long")


def near_vectors(
    vectors: DataFrame, threshold: float = 0.9, tile_rows: int = 4096
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    kind = "float" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
    usable = (
        F.col("embedding").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists("embedding", lambda x: x != 0)
    )
    classes = checkpointed(
        rows.where(usable).groupBy("embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
        .select("embedding", "first", "copies", F.size("embedding").alias("dim"), F.monotonically_increasing_id().alias("node"))
    )
    found = checkpointed(_links(checkpointed(_tiles(classes, tile_rows)), threshold))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = connected_components(found.select("node", "root").distinct(), "node", "root")
    nodes = (
        classes.join(links, "node", "left")
        .join(parts.withColumnRenamed("id", "node"), "node", "left")
        .select("embedding", "first", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("component"))
    )
    nodes = checkpointed(nodes)
    named = nodes.groupBy("component").agg(F.min("first").alias("component_id"))
    nodes = nodes.join(named, "component").select("embedding", "n_links", "component_id")
    return rows.join(nodes, "embedding", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
