"""Runs of periodic words against brute force over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from dialogprep.llm.periodic_runs import maximal_runs, periodic_runs
from dialogprep.llm.queries import op12_periodic_runs

SF001 = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "a", "a a a a a", "A a a a a a a", "x " * 30_000, "a b " * 3, "a b " * 3 + "a b", "a b c " * 9 + "\n z z z z z z z",
       "é\xa0é " * 8, "y " * 5 + "n " + "y " * 6, "a b a b a b a b", "a b a b a b a b"]


def brute(words, min_length=6, min_exponent=4):
    found = {}
    for q in range(1, len(words) // min_exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(min_length, min_exponent * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (4, 2), (6, 3)])
def test_runs_equal_brute_force(limits):
    rng = random.Random(7)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            letters = rng.randint(1, 3)
            doc = [rng.randrange(letters) for _ in range(rng.randint(0, 50))]
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 8))]
            doc += unit * rng.randint(0, 9) + unit[: rng.randint(0, len(unit))]
            docs.append(doc + [rng.randrange(letters) for _ in range(rng.randint(0, 5))])
        offsets = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
        codes = np.array([x for d in docs for x in d], np.int64)
        got = [tuple(r) for r in np.stack(maximal_runs(codes, offsets, *limits), 1).tolist()]
        want = [(k, *r) for k, d in enumerate(docs) for r in brute(d, *limits)]
        assert [(k, s, n, q) for k, s, n, q in got] == sorted(want, key=lambda r: (r[0], r[1], r[3]))


def test_long_repetitions_take_a_linear_number_of_steps():
    n = 300_000
    codes = np.zeros(n, np.int64)
    got = maximal_runs(codes, np.array([0, n]))
    assert [x.tolist() for x in got] == [[0], [0], [n], [1]]


def test_odd_rows(spark):
    rows = [(None if i == 3 else i, t, "x", 1) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows + rows[-1:], "doc_id long, text string, runs string, n_words int")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.runs, r.collapsed) for r in periodic_runs(df).collect())
    want = []
    for doc_id, text, *_ in rows + rows[-1:]:
        words = words_of(text)
        runs = [(0, len(words), 1)] if len(words) > 10_000 else brute(words)
        want.append((-1 if doc_id is None else doc_id, len(words), runs, collapsed(words, runs)))
    assert [(i, n, [(x.start, x.length, x.period) for x in r], c) for i, n, r, c in got] == sorted(want)
    assert periodic_runs(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(df, min_exponent=1)


def test_query_equals_the_contract(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op12_periodic_runs(spark, SF001).collect()}
    assert set(got) == set(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    edited = 0
    for doc_id, text in docs.items():
        w = words_of(text)
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            edited += 1
        runs = brute(w)
        r = got[doc_id]
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None,) * 3
        milli = 1000 * best[1] // best[2] if runs else None
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *best, milli)
        assert r.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(w, runs))
    assert edited > 5
