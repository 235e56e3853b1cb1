"""The parity-sketch join against all pairs compared one by one."""

import random
import re

import numpy as np
import pytest

from dialogprep.llm.shingle_join import Bands, near_duplicates, shingles

SF001 = "/root/testdata/sf0.001"


def sets_of(texts, k):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    return out


def brute(ids, texts, k, num, den):
    sets = sets_of(texts, k)
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(ids[i])
    return {ids[i]: (len(sets[i]), min(groups[find(i)])) for i in range(len(ids))}


def check(spark, ids, texts, k, num, den, **more):
    df = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)], "doc_id long, text string, node int").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, k, num, den, **more).collect()}
    assert got == brute(ids, texts, k, num, den)


def edited(rng, words, share):
    return [rng.choice(VOCABULARY) if rng.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(400)]


@pytest.mark.parametrize(("k", "num", "den"), [(3, 90, 100), (5, 80, 100)])
def test_families_and_boilerplate(spark, k, num, den):
    rng = random.Random(5)
    texts = [None, "", " \n", "one", "One ", "one two", "ONE TWO", "é É", "a b c", "a  b\tc"]
    for size in (6, 12, 40, 150):
        base = [rng.choice(VOCABULARY) for _ in range(size)]
        for share in (0.0, 0.005, 0.01, 0.02, 0.05):
            texts += [" ".join(edited(rng, base, share)) for _ in range(6)]
    common = [rng.choice(VOCABULARY) for _ in range(60)]  # a passage that many texts share
    for _ in range(60):
        own = [rng.choice(VOCABULARY) for _ in range(rng.choice([1, 2, 3, 5, 8, 30, 90]))]
        texts.append(" ".join(common + own if rng.random() < 0.5 else own + common))
    ids = list(range(100, 100 + len(texts)))
    rng.shuffle(ids)
    check(spark, ids, texts, k, num, den, group=3)
    check(spark, ids, texts, k, num, den, group=3, max_broadcast=0)


def test_shared_passage_forms_few_pairs(spark, monkeypatch):
    from dialogprep.llm import shingle_join as J

    made = {}
    plain = J._pairs_by_rare

    def counted(*args):
        found = plain(*args)
        made["n"] = found.count()
        return found

    monkeypatch.setattr(J, "_pairs_by_rare", counted)
    for n in (200, 400):
        rng = random.Random(n)
        common = [f"c{i}" for i in range(60)]
        texts = [" ".join(common + [f"o{rng.randrange(10**9)}" for _ in range(30)]) for _ in range(n - 2)]
        near = common + [f"n{i}" for i in range(30)]
        texts += [" ".join(near), " ".join([*near[:-1], "last"])]
        made["n"] = None
        check(spark, list(range(n)), texts, 5, 80, 100)
        assert made["n"] is not None and made["n"] <= n


@pytest.mark.parametrize("slots", [1, 64, 4096])
def test_rarest_shingles_meet_whatever_the_loads(slots):
    """Linked sets share one of their rarest shingles for any loads."""
    from dialogprep.llm.shingle_join import rarest

    rng = np.random.default_rng(slots)
    loads = rng.integers(1, 9, slots).astype(np.uint16) if slots > 1 else np.ones(2, np.uint16)
    for num, den in ((90, 100), (80, 100)):
        bands = Bands(num, den)
        for n in (1, 2, 5, 9, 10, 11, 40, 300):
            u = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
            for lost in range(n):
                new = np.unique(rng.integers(0, 2**63, rng.integers(0, n // 4 + 1)).astype(np.uint64))
                v = np.union1d(rng.permutation(u)[lost:], new)
                both = len(np.intersect1d(u, v))
                if den * both >= num * len(np.union1d(u, v)):
                    assert len(np.intersect1d(rarest(u, loads, bands), rarest(v, loads, bands)))


def test_whole_small_table(spark):
    rows = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    check(spark, [r.doc_id for r in rows], [r.text for r in rows], 3, 90, 100)


def test_empty_table_and_null_ids(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "A b c d e f"), (4, "A b c d e f"), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), str(r.component_id)) for r in near_duplicates(df).collect())
    assert got == [("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]


def test_links_through_null_and_repeated_ids(spark):
    base = [f"w{i}" for i in range(60)]
    chain = [" ".join(base), " ".join(base[:10] + ["x"] + base[11:40] + ["y"] + base[41:])]
    middle = " ".join(base[:10] + ["x"] + base[11:])
    rows = [(7, chain[0]), (8, chain[1]), (3, "quite another text of some words"), (3, "and one more that has its id")]
    kinds = sets_of([chain[0], middle, chain[1]], 5)
    alike = lambda a, b: len(a & b) / len(a | b)
    assert alike(kinds[0], kinds[2]) < 0.8 <= min(alike(kinds[0], kinds[1]), alike(kinds[1], kinds[2]))
    for between, want in ((None, 7), (9, 7), (2, 2)):
        df = spark.createDataFrame([*rows, (between, middle), (None, "nobody's text of six words")], "doc_id long, text string")
        got = sorted((r.doc_id or 0, r.component_id or 0) for r in near_duplicates(df, 5, 80, 100).collect())
        own = [(0, want)] if between is None else [(between, want)]
        assert got == sorted([(0, 0), (3, 3), (3, 3), (7, want), (8, want), *own])


def test_bands_cover_all_linked_sizes():
    for num, den in ((90, 100), (80, 100)):
        bands = Bands(num, den)
        for a in range(1, 400):
            for b in range(a, a * den // num + 1):
                shared = {x[0] for x in bands.of(a)} & {x[0] for x in bands.of(b)}
                assert shared or bands.distance(a, b) == 0
                for g, cells, slack in bands.of(a):
                    if g in shared:
                        assert cells - bands.distance(a, b) - 1 >= slack >= 0


def test_shingle_hashes_are_distinct():
    text = " ".join(f"w{i}" for i in range(5000))
    assert len(shingles(text, 3)) == 4998 and len(np.unique(shingles("a b", 3))) == 1


def test_words_equal_the_pattern(monkeypatch):
    from dialogprep.llm import shingle_join as J

    texts = ["a b\tA\x0bb\nc\x0c\rd é É", "  lead", "trail  ", "x" * 5000 + " y", "w " * 400, "\x1c\x85 \xa0", "ab " * 30 + "q" * 300 + " r"]
    for block in (1 << 18, 16):
        monkeypatch.setattr(J, "_BLOCK", block)
        J._powers.cache_clear()
        names = {}
        for t in texts:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
            words = re.findall(r"[^\x20\x09-\x0D]+", low)
            got = J.word_hashes(t).tolist()
            assert len(got) == len(words)
            assert all(names.setdefault(w, h) == h for w, h in zip(words, got))
        assert len(set(names.values())) == len(names)
    J._powers.cache_clear()


def test_sketches_differ_by_no_more_than_the_sets():
    from dialogprep.llm.shingle_join import apart, sketch

    rng = np.random.default_rng(1)
    for n in (1, 3, 200, 256, 257, 700, 3000):
        u = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for lost, new in ((0, 0), (0, n // 3 + 1), (n // 4, 0), (n // 5, n // 5), (n // 2, n)):
            v = np.union1d(rng.permutation(u)[lost:], rng.integers(0, 2**63, new).astype(np.uint64))
            x, y = sketch(u), sketch(v)
            assert len(x) * 8 >= max(256, len(u)) and apart(x, y) == apart(y, x) <= len(np.setxor1d(u, v))
        other = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        assert n < 100 or apart(sketch(u), sketch(other)) > len(u) // 4


def test_only_pairs_that_may_link_are_verified(spark, monkeypatch):
    """Texts of one half in common share cells but cannot link."""
    from dialogprep.llm import shingle_join as J

    made, plain = [], J._verify

    def counted(pairs, *args):
        made.append(pairs.count())
        return plain(pairs, *args)

    monkeypatch.setattr(J, "_verify", counted)
    texts = []
    for f in range(20):
        for size in (60, 400):
            common = [f"c{f}_{size}_{i}" for i in range(size)]
            texts += [" ".join(common + [f"o{f}_{t}_{i}" for i in range(size)]) for t in range(4)]
            texts.append(texts[-1] + " more")
    check(spark, list(range(len(texts))), texts, 5, 80, 100)
    assert made and made[0] <= 50  # 40 of them link; 400 share cells


def test_rare_shingles_pair_only_what_may_link(spark):
    """Many edits of one text that are too far from each other to link."""
    from dialogprep.llm import shingle_join as J

    rng = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    texts = [" ".join(rng.choice(VOCABULARY) if rng.random() < 0.06 else w for w in base) for _ in range(150)]
    texts += [texts[0] + " end", texts[1] + " end"]
    n = len(texts)
    rows = [(i, i // 2, 2, t) for i, t in enumerate(texts)]
    nodes = spark.createDataFrame(rows, "node long, component long, weight long, text string")
    sets = sets_of(texts, 5)
    linked = {
        (a, b) for b in range(n) for a in range(b)
        if a // 2 != b // 2 and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    }
    found = J._pairs_by_rare(nodes, sum(map(len, sets)), 5, J.Bands(80, 100), 1000)
    found = {(r.a, r.b) for r in found.collect()}
    assert len(linked) >= 2 and linked <= found and len(found) <= len(linked) + n


def test_components_after_more_edges(spark):
    from dialogprep.llm.components import connected_components, merged_components

    rng = random.Random(3)
    first = [(rng.randrange(60), rng.randrange(60)) for _ in range(25)]
    more = [(rng.randrange(80), rng.randrange(80)) for _ in range(15)]
    first, more = (spark.createDataFrame(e, "a long, b long") for e in (first, more))
    want = sorted(map(tuple, connected_components(first.union(more), "a", "b").collect()))
    got = merged_components(connected_components(first, "a", "b"), more, "a", "b")
    assert sorted(map(tuple, got.collect())) == want


def test_few_rows_take_few_tasks_whatever_the_partitions(spark):
    """A table of a few links is not dealt to every shuffle partition
    in each step, and a path as long as that is still one component."""
    from dialogprep.llm.components import connected_components

    settings = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in settings}
    sc = spark.sparkContext
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(1000, 1001)], "a long, b long")
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        sc.setJobGroup("few-rows", "")
        got = connected_components(edges, "a", "b").collect()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(map(tuple, got)) == [(i, 0) for i in range(41)] + [(1000, 1000), (1001, 1000)]
    status = sc.statusTracker()
    jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup("few-rows")]
    stages = [status.getStageInfo(s) for s in {s for j in jobs if j for s in j.stageIds}]
    wide = [s.numTasks for s in stages if s and s.numCompletedTasks >= 48]
    assert 0 < len(stages) and len(wide) <= 2  # the table of edges, once
