"""Int8 tile products against all cosines in double precision."""

import numpy as np
import pytest

from dialogprep.llm.embed_dedup import _products, near_vectors, quantise

SF001 = "/root/testdata/sf0.001"


def brute(ids, vectors, threshold=0.9):
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    links = [0] * len(ids)
    unit = {i: np.asarray(np.float32(vectors[i]), float) / np.linalg.norm(np.asarray(np.float32(vectors[i]), float)) for i in ok}
    for a in ok:
        for b in ok:
            if a < b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    low = {}
    for i in range(len(ids)):
        low[find(i)] = min(low.get(find(i), ids[i]), ids[i])
    return sorted((ids[i], links[i], low[find(i)], ids[i] == low[find(i)]) for i in range(len(ids)))


def run(spark, ids, vectors, **more):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 7) for i, v in zip(ids, vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int").repartition(3)
    return sorted(tuple(r) for r in near_vectors(df, **more).collect())


@pytest.mark.parametrize("tile_rows", [16, 4096])
def test_families_and_odd_vectors(spark, tile_rows):
    rng = np.random.default_rng(3)
    vectors = [None, [], [0.0, 0.0], [1.0, None], [1.0, float("nan")], [1.0, float("inf")], [1.0, 2.0], [2.0, 4.0], [1e30, 2e30]]
    for _ in range(8):
        base = rng.normal(size=24)
        vectors += [base + rng.normal(size=24) * s for s in (0, 0, 0.1, 0.3, 0.45, 0.5)] + [base * 3]
    hot = rng.normal(size=24)
    vectors += [hot] * 30 + [hot + rng.normal(size=24) * 0.05 for _ in range(30)]
    ids = [int(i) for i in rng.permutation(len(vectors)) + 50]
    assert run(spark, ids, vectors, tile_rows=tile_rows) == brute(ids, vectors)


def test_whole_small_table(spark):
    rows = spark.read.parquet(f"{SF001}/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], [r.embedding for r in rows]
    assert run(spark, ids, vectors, tile_rows=64) == brute(ids, vectors)


def test_quantisation_bound_holds():
    rng = np.random.default_rng(1)
    u = rng.normal(size=(500, 64)) ** 3
    u /= np.linalg.norm(u, axis=1)[:, None]
    codes, scale, lost = quantise(u)
    back = codes * scale[:, None]
    size = np.linalg.norm(back, axis=1)
    bound = lost[:, None] * size[None, :] + lost[None, :] * size[:, None] + lost[:, None] * lost[None, :]
    assert (np.abs(u @ u.T - back @ back.T) <= bound + 1e-12).all()


def test_empty_table_and_null_id(spark):
    assert run(spark, [], []) == []
    got = near_vectors(
        spark.createDataFrame([(None, [1.0, 2.0]), (5, [1.0, 2.0]), (None, None)], "vec_id long, embedding array<float>")
    ).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in got) == [("5", 1, "5"), ("None", 0, "None"), ("None", 1, "5")]


def test_products_of_codes_are_exact_at_any_length():
    rng = np.random.default_rng(5)
    x, y = rng.integers(120, 128, (2, 40, 4096))
    assert (_products(x.astype(np.float32), y.astype(np.float32)) == x @ y.T).all()


@pytest.mark.parametrize("scale", [1.0, 1e200, 1e-200])
def test_long_near_flat_vectors_in_doubles(spark, scale):
    """Codes near 127 everywhere, cosines close around the threshold, values beyond floats."""
    rng = np.random.default_rng(9)
    base = 1 + rng.normal(size=4096) * 0.01
    vectors = [base]
    for c in 0.9 + np.array([-1e-3, -1e-6, -1e-9, -1e-12, 1e-12, 1e-9, 1e-6, 1e-3]):
        side = rng.normal(size=4096)
        side -= base * (side @ base) / (base @ base)
        vectors.append(c * base / np.linalg.norm(base) + np.sqrt(1 - c * c) * side / np.linalg.norm(side))
    unit = np.array([v / np.linalg.norm(v) for v in vectors])
    near = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert near[0] == 4
    df = spark.createDataFrame([(i, [float(x) * scale for x in v]) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in near_vectors(df).collect()}
    assert [got[i].n_links for i in range(len(vectors))] == near.tolist()
    assert [got[i].component_id for i in range(len(vectors))] == [0, 1, 2, 3, 4, 0, 0, 0, 0]
