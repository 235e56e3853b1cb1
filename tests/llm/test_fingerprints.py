"""Fingerprints against a plain model of syncmers and of the next document."""

import hashlib

import numpy as np
import pytest

from dialogprep.llm import fingerprints as P

SF001 = "/root/testdata/sf0.001"


def plain_positions(raw):
    """Closed syncmers, k-mer by k-mer."""
    out = []
    for i in range(len(raw) - P.K + 1):
        inner = [raw[i + j : i + j + P.S] for j in range(P.K - P.S + 1)]
        codes = [int(P._mix(np.frombuffer(x, np.uint64).copy())[0]) for x in inner]
        if min(codes) in (codes[0], codes[-1]):
            out.append(i)
    return out


def plain_anchors(raw):
    """``(k-mer, position)`` of the definition; a text without any is its own anchor."""
    at = plain_positions(raw)
    return [(raw[i : i + P.K], i) for i in at] if at or not raw else [(raw, 0)]


def plain_likeness(a, b):
    """Dice over the longest common subsequence, by the textbook's table."""
    if not a or not b:
        return float(len(a) == len(b))
    row = np.zeros(len(b) + 1, int)
    for x in a:
        old, row = row, row.copy()
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(old[j + 1], row[j])
    return 2 * int(row[-1]) / (len(a) + len(b))


def check(spark, rows, plain=True):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, range int, ahead string").repartition(3)
    got = P.fingerprints(df).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        cut = len(t) // 4
        new = t[: len(t) - cut] + following[:cut]
        own, changed, ahead = (P.anchors(x.encode()) for x in (t, new, following))
        want.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), P.to_string(*own), P.to_string(*changed),
                     P.likeness(own[0], changed[0]), P.likeness(own[0], ahead[0])))
        if plain and len(t) + len(following) < 2000:
            x, y, z = (plain_anchors(u.encode()) for u in (t, new, following))
            assert [p for _, p in x] == own[1].tolist() and [p for _, p in y] == changed[1].tolist()
            for near, other in ((want[-1][5], y), (want[-1][6], z)):
                full = plain_likeness([u for u, _ in x], [u for u, _ in other])
                assert near <= full + 1e-12
                if len({u for u, _ in x}) == len(x) and len({u for u, _ in other}) == len(other):
                    assert near == pytest.approx(full)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    return got


@pytest.mark.parametrize("size", [16, 17, 24, 300])
def test_syncmers_equal_the_definition(size):
    raw = bytes(np.random.default_rng(size).integers(97, 105, size, dtype=np.uint8))
    assert P._block_syncmers(raw)[0].tolist() == plain_positions(raw)


def test_blocks_do_not_cut_anchors(monkeypatch):
    raw = bytes(np.random.default_rng(1).integers(97, 123, 5000, dtype=np.uint8))
    whole = P.anchors(raw)
    assert whole[1].tolist() == plain_positions(raw)
    monkeypatch.setattr(P, "_BLOCK", 64)
    assert all((x == y).all() for x, y in zip(P.anchors(raw), whole))


def test_whole_small_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = check(spark, rows)
    long = [r for r in got if r.n_chars > 400]
    assert np.mean([r.near_edited for r in long]) > 0.6
    assert np.mean([r.near_next < 0.2 for r in long]) > 0.9
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "abc"), (3, "abc"), (3, "zz"), (None, "null id text that is long enough"), (-5, "é" * 40),
            (9, "日本語" * 30), (10, "a" * 200_000), (2**60, "the last one, then the first one comes")]
    check(spark, rows)
    check(spark, rows[:1])
    check(spark, [(5, "alone " * 20)])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.fingerprints(empty).collect() == []


def near(x, y):
    return P.likeness(P.anchors(x)[0], P.anchors(y)[0])


def test_fingerprints_come_back_from_strings():
    rng = np.random.default_rng(2)
    for raw in (b"", b"abc", b"a" * 500, b"some words that are long enough to hold a number of anchors " * 3, rng.bytes(3000), b"ab" * 90 + rng.bytes(50)):
        found = P.anchors(raw)
        assert all((x == y).all() for x, y in zip(P.from_string(P.to_string(*found)), found))
    assert near(b"", b"abc") == 0.0 and near(b"", b"") == 1.0 and near(b"abc", b"abc") == 1.0


def test_likeness_of_repetitive_texts():
    rng = np.random.default_rng(4)
    word = lambda: bytes(rng.integers(97, 123, 7, dtype=np.uint8))
    line = b" ".join(word() for _ in range(12)) + b"\n"
    other = b" ".join(word() for _ in range(12 * 75)) + b"\n"
    assert near(line * 300, line * 225 + other[: len(line) * 75]) == pytest.approx(0.75, abs=0.02)
    assert near(line * 300, other[: len(line) * 75] + line * 225) == pytest.approx(0.75, abs=0.02)
    assert near(line * 10, line * 50) == pytest.approx(1 / 3, abs=0.02)  # Dice of one part and five
    assert near(b"a" * 100_000, b"a" * 200_000) == pytest.approx(2 / 3, abs=0.001)
    assert P.to_string(*P.anchors(b"a" * 100_000)) != P.to_string(*P.anchors(b"a" * 200_000))
    cut = line * 40 + other + line * 40
    assert near(cut, line * 39 + other + line * 40) > 0.97  # shorter in front of a passage
    small = [line * 6, line * 5 + word(), word() + line * 5, line[:40] * 4 + line * 3]
    for x in small:
        for y in small:
            full = plain_likeness([u for u, _ in plain_anchors(x)], [u for u, _ in plain_anchors(y)])
            assert full * 0.7 - 0.02 <= near(x, y) <= full + 1e-12 and near(x, y) == near(y, x)


def test_long_texts_keep_all_anchors(spark):
    rng = np.random.default_rng(3)
    word = lambda: bytes(rng.integers(97, 123, 7, dtype=np.uint8)).decode()
    first = [word() for _ in range(20_000)]
    other = first[:9000] + [word() for _ in range(100)] + first[9100:]
    passage = first[5000:5100] + [word() for _ in range(20_000)]
    rows = list(enumerate(map(" ".join, (first, other, passage))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in P.fingerprints(df).collect()}
    assert 0.98 < got[0].near_next < 1.0 and got[0].fingerprint != got[1].fingerprint
    assert 0.002 < got[1].near_next < 0.02  # a passage of 100 words is seen
    start = plain_positions(rows[0][1].encode()[:2000])
    assert P.from_string(got[0].fingerprint)[1][: len(start)].tolist() == start
    assert len(got[0].fingerprint.split(".")) > 30_000
