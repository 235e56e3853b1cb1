"""Held-out accuracy, the flattened forest against a walk, odd rows."""

import zlib

import numpy as np

from dialogprep.llm.quality import FEATURES, fit, quality, statistics

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(judged) > 80
    assert sum(p == t for p, t in judged) / len(judged) > 0.95


def test_held_out_labels_are_not_learnt_from(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    from dialogprep.llm.quality import held_out

    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality(docs, turned).collect()}
    assert a == b


def test_forest_equals_a_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = ((x[:, 0] > 0.3) | (x[:, 1] + x[:, 2] > 1)).astype(float)
    forest = fit(x, y, trees=30, depth=3)
    for row, got in zip(x[:50], forest.score(x[:50])):
        margin = forest.base
        for t in range(30):
            node = 0
            while node < 7:
                node = 2 * node + 1 + int(row[forest.feature[t, node]] > forest.threshold[t, node])
            margin += forest.value[t, node - 7]
        assert abs(1 / (1 + np.exp(-margin)) - got) < 1e-12
    assert ((forest.score(x) >= 0.5) == y).mean() > 0.9


def test_odd_rows_and_empty_tables(spark):
    texts = [None, "", " ", "a", "x" * 300_000, "A!! B!!", "é\n\n"]
    docs = spark.createDataFrame([(None if i == 3 else i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(0, 1), (0, 0), (2, None), (None, 1), (6, 1), (77, 0)], "doc_id long, quality int")
    rows = quality(docs, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
    none = quality(docs, labels.limit(0)).collect()
    assert all(r.score == 0.5 and r.predicted == 1 for r in none)
    assert quality(docs.limit(0), labels).collect() == []
    assert len(statistics("a b")) == len(FEATURES) and not statistics(None).any()
