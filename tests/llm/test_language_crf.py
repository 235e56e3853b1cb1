"""The CRF against enumeration of label paths, and accuracy on held-out rows."""

import itertools
import zlib

import numpy as np
import pytest

from dialogprep.llm import language_crf as crf_module
from dialogprep.llm.language_crf import Crf, features, fit, language_ids, languages, messages, posteriors, train, words_of
from dialogprep.llm.queries import op11_language_id

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
EN = "the cat sat on the mat and then it went out with the other cats"
DE = "der hund lief durch den garten und dann schlief er unter einem baum"


def enumerated(scores, anew, trans, start):
    n, k = scores.shape
    p = np.zeros((n, k))
    for path in itertools.product(range(k), repeat=n):
        total = sum(scores[t, y] + (start[y] if anew[t] else trans[path[t - 1], y]) for t, y in enumerate(path))
        for t, y in enumerate(path):
            p[t, y] += np.exp(total)
    return p / p.sum(axis=1, keepdims=True)


@pytest.mark.parametrize("block", [1, 2, 3, 128])
def test_posteriors_equal_enumeration(monkeypatch, block):
    monkeypatch.setattr(crf_module, "BLOCK", block)
    rng = np.random.default_rng(block)
    for _ in range(20):
        n, k = int(rng.integers(1, 7)), int(rng.integers(1, 4))
        scores, trans, start = rng.normal(size=(n, k)) * 4, rng.normal(size=(k, k)), rng.normal(size=k)
        anew = rng.random(n) < 0.3
        anew[0] = True
        assert np.allclose(posteriors(scores, anew, trans, start), enumerated(scores, anew, trans, start))


def test_long_chains_stay_finite():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(50_000, 3)) * 200
    anew = np.zeros(50_000, bool)
    anew[0] = True
    p = posteriors(scores, anew, rng.normal(size=(3, 3)) * 5, np.zeros(3))
    assert np.isfinite(p).all() and np.allclose(p.sum(axis=1), 1)
    assert all(np.isfinite(m).all() for m in messages(scores, anew, np.zeros((3, 3)), np.zeros(3)))


def test_features_of_a_word():
    found, n = features(["abcab", "é", "日本"])
    # n-grams of 1 to 3, prefixes and suffixes of 1 to 4, the word itself
    assert n.tolist() == [5 + 4 + 3 + 4 + 4 + 1, 1 + 1 + 1 + 1, 2 + 1 + 2 + 2 + 1]
    assert found[: n[0]].tolist() == features(["abcab"])[0].tolist()
    assert (found < crf_module.BUCKETS).all() and (found >= 0).all()


def test_code_switched_words_get_their_own_labels():
    langs = ["de", "en"]
    seqs = [[(w, 1) for w in EN.split()] + [(w, 0) for w in DE.split()]] * 20
    crf = fit(seqs, langs)
    labeller = crf_module.Labeller(crf)
    lang, score, label, _ = labeller.label([EN + ". " + DE + "!", EN, None, "123 ²½ !"])
    assert [langs[y] for y in label[: len((EN + " " + DE).split())]] == ["en"] * 15 + ["de"] * 13
    assert lang[1:] == ["en", "und", "und"] and score[1] > 0.9 and score[2:].tolist() == [0, 0]
    assert crf.trans[0, 0] > crf.trans[0, 1] or crf.trans[1, 1] > crf.trans[1, 0]
    assert words_of("Ab1c_D²e") == ["ab", "c", "d²e"]


def test_odd_rows(spark):
    rows = [(None if i == 3 else i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(40)]
    rows += [(50, None, "en"), (51, "", "de"), (52, " 12 !", "fr"), (53, EN, None), (54, (EN + " ") * 5000, "en"), (1, EN, "de"), (1, EN, "de")]
    df = spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = language_ids(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[i].lang_pred for i in (50, 51, 52, 53, 54)] == ["und", "und", "und", "en", "en"]
    assert all(0 <= r.score <= 1 for r in got) and not any(r.held_out for r in got if r.doc_id is None)
    assert language_ids(df.limit(0)).collect() == []
    unlabelled = language_ids(df.withColumn("lang", df.lang.substr(1, 0)).where("false").unionByName(df.selectExpr("doc_id", "text", "cast(null as string) lang", "lang_pred", "score"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_stretches(spark):
    crf = fit([[(w, 1) for w in EN.split()] + [(w, 0) for w in DE.split()]] * 20, ["de", "en"])
    df = spark.createDataFrame([(1, EN + " " + DE), (2, None)], "doc_id long, text string")
    got = {r.doc_id: [(s.lang, s.words) for s in r.stretches] for r in languages(df, crf, stretches=True).collect()}
    assert got == {1: [("en", 15), ("de", 13)], 2: []}


def test_held_out_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    got = op11_language_id(spark, SF01).collect()
    assert {r.doc_id for r in got} == set(docs) and len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    hits = [r.lang_pred == docs[r.doc_id].lang for r in got if r.held_out]
    assert len(hits) > 100 and sum(hits) / len(hits) > 0.98


def test_training_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    few = train(docs, per_lang=5, max_langs=2, max_words=10)
    assert len(few.langs) == 2 and isinstance(few, Crf)
    empty = train(docs.where("false"))
    assert empty.langs == []
