"""The whole pipeline against plain models of its stages, on small rows."""

import re

import public_tokenizers
from pyspark.sql import functions as F
from test_bpe_ops import check_pieces
from test_line_dedup import model as line_model
from test_mixing import model as mix_model
from test_shingle_join import brute
from tokenizers import Tokenizer

import corpus_pipeline as C
from dialogprep.llm.quality import statistics, train

SF001 = "/root/testdata/sf0.001"
TOKEN = r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"


def domain(source):
    number = re.search("([0-9]{1,6})$", source or "")
    return ("web", "books", "code", "forum")[int(number[1]) % 4] if number else "other"


def test_stages_equal_the_models(spark):
    import numpy as np

    docs = spark.read.parquet(f"{SF001}/documents.parquet").withColumn("quality_score", F.lit("extra")).withColumn("epoch", F.lit(1))
    rows = docs.collect()
    forest = train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    seen = [docs]
    for _, stage in C.STAGES:
        out = stage(spark, seen[-1], SF001)
        seen.append(out.checkpoint())
    assert all(s.columns == docs.columns for s in seen[:-1])

    kept = [r for r in rows if forest.score(np.array([statistics(r.text)]))[0] >= 0.5]
    assert sorted(r.doc_id for r in seen[1].collect()) == sorted(r.doc_id for r in kept)
    assert len(kept) < len(rows)

    groups = brute([r.doc_id for r in kept], [r.text for r in kept], 5, 80, 100)
    texts = line_model([r.text for r in kept], 10, classes=[groups[r.doc_id][1] for r in kept])
    got = {r.doc_id: r for r in seen[2].collect()}
    assert [got[r.doc_id].text for r in kept] == texts and all(r.n_chars == len(r.text) for r in got.values())

    comp = brute([r.doc_id for r in kept], texts, 5, 80, 100)
    stay = {i for i, (_, c) in comp.items() if c == i}
    assert {r.doc_id for r in seen[3].collect()} == stay and seen[3].count() == len(stay)

    left = [(r.doc_id, t, domain(r.source), r.lang, r.source) for r, t in zip(kept, texts) if r.doc_id in stay]
    taken, _ = mix_model(left, C.MIXTURE)
    by_id = {str(x[0]): x[1] for x in left}
    want = sorted((i, "".join(re.findall(TOKEN, by_id[i])[:take]) if take < n else by_id[i]) for i, _, _, n, take in taken)
    mixed = seen[4].collect()
    assert sorted((str(r.doc_id), r.text) for r in mixed) == want

    tok = Tokenizer.from_file(public_tokenizers.path(C.TOKENIZER))
    pieces = seen[5].collect()
    assert sum(p.length for p in pieces) == sum(len(tok.encode(t, add_special_tokens=False).ids) + 1 for _, t in want)
    once = [i for i, _ in want if sum(j == i for j, _ in want) == 1]
    if len(once) == len(want):
        check_pieces(pieces, [(r.doc_id, r.text) for r in mixed], tok)


def test_empty_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF001).checkpoint()
    assert docs.collect() == []


def test_odd_rows_pass(spark):
    rows = [(None, None, None, None, None), (1, "", "en", "src1", 0), (2, "Same text of seven words or so.", "en", "src1", 3),
            (2, "Same text of seven words or so.", "en", "src1", 3), (3, "Same text of seven words or so.", None, "odd", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in C.STAGES[1:]:
        docs = stage(spark, docs, SF001).checkpoint()
        if name == "near_dedup":
            assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "2", "None"]
    assert docs.count() > 0
