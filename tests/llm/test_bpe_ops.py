"""Token counts and packing against the library and an exact round trip."""

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dialogprep.llm.bpe import Encoder
from dialogprep.llm.packing import Schedule, pack
from dialogprep.llm.queries import op3_token_counts, op5_packing
from dialogprep.llm.token_counts import count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF001 = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  a  b", "a\n b", "\n\n a \t\tb ", "a <|endoftext|> b", "日本語 text", "x\xa0 y",
    "it's  we'll 've 123 4²5", "\x1c a\x85 b", "é" * 50 + " ’s", "word,\nThe next.\n\nEnd.\n", "a" * 5000,
    "one two " * 20_000, "one two " * 3, "one two " * 3,
]
SCHEMA = "doc_id long, text string, source string, n_tokens string, queue int"


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def odd_docs(spark):
    rows = [(None if i == 5 else i, t, None if i % 3 == 0 else "s" + str(i % 2), "x", 1) for i, t in enumerate(ODD)]
    return spark.createDataFrame(rows + rows[-1:], SCHEMA)


def test_encoder_equals_library(tok):
    enc = Encoder(PATH, False)
    assert enc.core is not None
    for text in ODD:
        want = tok.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(enc(text), enc.kind).tolist() == want


@pytest.mark.parametrize("name", ["word_bpe_49k.json"])
def test_encoder_falls_back_to_the_library(name):
    path = public_tokenizers.path(name)
    enc, tok = Encoder(path, True), Tokenizer.from_file(path)
    assert enc.core is None
    assert [enc(t) for t in ODD] == [len(tok.encode(t or "", add_special_tokens=False).ids) for t in ODD]


def test_counts_equal_library(spark, tok):
    got = op3_token_counts(spark, SF001).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        n = len(tok.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 1024)


def test_counts_of_odd_rows(spark, tok):
    got = count_tokens(odd_docs(spark), PATH).collect()
    want = [len(tok.encode(t or "", add_special_tokens=False).ids) for t in [*ODD, ODD[-1]]]
    assert sorted(r.n_tokens for r in got) == sorted(want)
    assert count_tokens(odd_docs(spark).limit(0), PATH).collect() == []


def check_pieces(pieces, texts, tok, window=2048):
    """Every id lies in one piece; windows are gapless; checksums agree."""
    ids = {}
    for doc_id, text in texts:
        ids[doc_id] = tok.encode(text or "", add_special_tokens=False).ids + [1]
    by_doc, by_seq = {}, {}
    for p in pieces:
        assert p.length > 0 and p.doc_tokens == len(ids[p.doc_id])
        own = np.asarray(ids[p.doc_id][p.start : p.start + p.length], "<u4")
        assert zlib.crc32(own.tobytes()) == p.ids_crc32
        by_doc.setdefault(p.doc_id, []).append((p.start, p.length))
        by_seq.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert set(by_doc) == set(ids)
    for doc_id, spans in by_doc.items():
        at = 0
        for start, length in sorted(spans):
            assert start == at
            at += length
        assert at == len(ids[doc_id])
    fill = {}
    for seq, spans in by_seq.items():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= window
        fill[seq] = at
    assert sorted(fill) == list(range(len(fill)))
    assert all(fill[s] == window for s in sorted(fill)[:-1])  # only the last one is padded


def test_packing_round_trip(spark, tok):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    check_pieces(op5_packing(spark, SF001).collect(), [(r.doc_id, r.text) for r in docs], tok)


def test_packing_odd_rows(spark, tok):
    df = odd_docs(spark).where("doc_id is not null").dropDuplicates(["doc_id"])
    texts = [(r.doc_id, r.text) for r in df.collect()]
    check_pieces(pack(df, PATH).collect(), texts, tok)
    check_pieces(pack(df.repartition(5), PATH, targets={"s0": 5, "s1": 1}).collect(), texts, tok)
    check_pieces(pack(df, PATH, max_queues=1, max_broadcast_rows=0).collect(), texts, tok)
    assert pack(df.limit(0), PATH).collect() == []
    twice = pack(odd_docs(spark), PATH).collect()  # a null id and a repeated row
    assert sum(r.length for r in twice) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for t in [*ODD, ODD[-1]])


def test_windows_keep_target_proportions(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn(
        "source", F.when(F.col("doc_id") % 10 < 6, "big").otherwise("small")
    )
    rows = pack(docs, PATH, targets={"big": 3, "small": 1}).collect()
    share = {}
    for r in rows:
        s = share.setdefault(r.sequence_id, [0, 0])
        s[r.source == "small"] += r.length
    ends = max(s for s, v in share.items() if v[0] and v[1])
    early = [v for s, v in share.items() if s < ends]
    assert len(early) > 5
    assert all(abs(v[1] - 512) <= 128 for v in early)


def test_schedule_is_a_permutation_in_order_of_due_times():
    for kind in (1, 2**55):  # int64 and unbounded integers
        tokens, targets = [1000, 37, 4096, 128], [3 * kind, kind, 5 * kind, 2 * kind]
        plan = Schedule(tokens, targets, 128)
        due = sorted(
            ((2 * c + 1) / (2 * w / kind), s, c) for s, (n, w) in enumerate(zip(plan.quanta, targets)) for c in range(n)
        )
        at = 0
        for _, s, c in due:
            assert int(plan.position(s, np.array([c]))[0]) == at
            at += min(128, tokens[s] - c * 128)
        assert (plan.kind is object) == (kind > 1)


def test_many_sources_keep_a_queue_each(spark, tok):
    words = [(i, "some words of a text " * (1 + i * 7 % 90), f"host{i % 300}.org") for i in range(700)]
    docs = spark.createDataFrame(words, "doc_id long, text string, source string").repartition(5).checkpoint()
    for targets in (None, {f"host{i}.org": 1 + i % 5 for i in range(290)}):
        few = sorted(map(tuple, pack(docs, PATH, targets=targets, max_queues=300).collect()))
        many = pack(docs, PATH, targets=targets).collect()
        assert sorted(map(tuple, many)) == few
        check_pieces(many, [(i, t) for i, t, _ in words], tok)
