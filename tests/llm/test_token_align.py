"""Token alignment against a plain model that calls both libraries."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from dialogprep.llm.queries import op13_token_alignment
from dialogprep.llm.token_align import token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF001 = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\n b", "\n\n a \t\tb ", "x <|endoftext|> <s></s> y", "日本語 text ﬁ", "x\xa0 y",
    "it's  we'll 've 123 4²5", "\x1c a\x85 b", "é" * 50 + " ’s", "word,\nThe next.\n\nEnd.\n", "a" * 3000, "has ▁ inside",
    "nul \x00 byte", "z​ w﻿ v᠎ u", "🙂 emoji 👩‍👩‍👧 zwj", "def f(x):\n    return  x\n", "one two " * 20_000, "one two " * 3,
    "Превед, мир  и дом", "ਪੰਜਾਬੀ ਬੋਲੀ", "　wide space",
]


class Model:
    def __init__(self):
        self.tok = Tokenizer.from_file(A)
        self.tok.encode_special_tokens = True
        self.sp = sentencepiece.SentencePieceProcessor(model_file=B)
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in own]
        self.byte = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}

    def bytes_a(self, i):
        return bytes(self.byte[c] for c in self.tok.id_to_token(i))

    def bytes_b(self, i):
        p = self.sp.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode()

    def document(self, text):
        """Spans of both sides, or None for a text without tokens."""
        if not text:
            return None
        want, sides = (" " + text).encode(), []
        for ids, of in ((self.tok.encode(" " + text, add_special_tokens=False).ids, self.bytes_a), (self.sp.encode(text), self.bytes_b)):
            at, spans = 0, []
            for i in ids:
                spans.append((i, at, at + len(of(i))))
                at = spans[-1][2]
            if b"".join(of(i) for i in ids) != want:
                return None
            sides.append(spans)
        return sides

    def rows(self, texts):
        docs, count = [], Counter()
        for text in texts:
            sides = self.document(text)
            if sides is None:
                docs.append(None)
                continue
            a, b = sides
            links, k = [], 0
            for i, x, y in a:
                while b[k][2] <= x:
                    k += 1
                j = k
                while j < len(b) and b[j][1] < y:
                    links.append((i, b[j][0]))
                    j += 1
            ends = {y for *_, y in a} & {y for *_, y in b}
            printed, ka, kb = [], 0, 0
            for end in sorted(ends):
                group = [[], []]
                while ka < len(a) and a[ka][2] <= end:
                    group[0].append(str(a[ka][0]))
                    ka += 1
                while kb < len(b) and b[kb][2] <= end:
                    group[1].append(str(b[kb][0]))
                    kb += 1
                printed.append("|".join(map(",".join, group)))
            docs.append((len(a), len(b), len(ends), links, ";".join(printed)))
            count.update(set(links))
        best = {}
        for (i, _), n in count.items():
            best[i] = max(n, best.get(i, 0))
        for d in docs:
            if d is None:
                yield 0, 0, 0, 0, 0, 0, ""
            else:
                n_a, n_b, groups, links, printed = d
                yield (n_a, n_b, groups, len(links), sum(count[x] == best[x[0]] for x in links), sum(count[x] for x in links),
                       hashlib.sha256(printed.encode()).hexdigest())


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_odd_rows_equal_the_model(spark, bound):
    rows = [(None if i == 4 else i, t, "x") for i, t in enumerate(ODD)]
    rows += rows[-3:]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    want = [(-1 if r[0] is None else r[0], *w) for r, w in zip(rows, Model().rows([r[1] for r in rows]))]
    got = [(-1 if r.doc_id is None else r.doc_id, *(r[c] for c in COLUMNS)) for r in token_alignment(df, A, B, bound).collect()]
    assert sorted(got) == sorted(want)
    assert token_alignment(df.limit(0), A, B, bound).collect() == []


def test_a_text_of_many_megabytes_beside_others(spark):
    texts = ["some words of a long text, repeated. " * 30_000, "a word", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in token_alignment(df, A, B).collect()}
    assert [got[i] for i in range(3)] == list(Model().rows(texts))


def test_query_equals_the_model(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in op13_token_alignment(spark, SF001).collect()}
    assert len(got) == len(docs)
    for d, want in zip(docs, Model().rows([d.text for d in docs])):
        assert got[d.doc_id] == want
