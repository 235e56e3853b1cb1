"""Exact seeded split: counts, seeds, argument checks, selection path."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from dialogprep.operators import split as S
from dialogprep.plans import job


def cut(spark, folder, lines, fraction, seed, name=""):
    """Split these lines; sorted train and val lines as written."""
    source = folder / f"source{name}.jsonl"
    source.write_text("\n".join(lines), encoding="utf-8")
    targets = [str(folder / f"{side}{name}") for side in ("train", "val")]
    sizes = job.split_jsonl(spark, str(source), *targets, fraction, seed)
    sides = [sorted(r.value for r in spark.read.text(t).collect()) for t in targets]
    assert sizes == tuple(map(len, sides))
    return sides


@pytest.mark.parametrize(("n", "fraction", "k"), [(1, 0.01, 1), (7, 0.3, 2), (61, 0.5, 30), (130, 0.999, 129)])
def test_sizes_and_rows(spark, tmp_path, n, fraction, k):
    lines = [f'["line {i}", {i % 3}]' for i in range(n)]
    train, val = cut(spark, tmp_path, [x for line in lines for x in (line, "", " \t")], fraction, n)
    assert len(val) == k and sorted(train + val) == sorted(lines)


def test_seed_decides_and_layout_does_not(spark, tmp_path):
    lines = [f"{i:03d}" for i in range(90)]
    same = cut(spark, tmp_path, lines, 0.2, 11, "a")
    assert same == cut(spark, tmp_path, lines[::-1], 0.2, 11, "b")
    assert same != cut(spark, tmp_path, lines, 0.2, 12, "c")


def test_empty_source(spark, tmp_path):
    assert cut(spark, tmp_path, ["", " "], 0.5, 1) == [[], []]


def test_copies_of_a_line_fall_one_by_one(spark, tmp_path):
    lines = ["copy"] * 300 + [f"own {i}" for i in range(300)]
    shares = []
    for seed in range(4):
        train, val = cut(spark, tmp_path, lines, 0.2, seed, str(seed))
        assert len(val) == 120 and sorted(train + val) == sorted(lines)
        shares.append(val.count("copy"))
    # 60 expected; beyond 6 standard deviations (of about 5) either way is a fault
    assert all(30 < x < 90 for x in shares) and len(set(shares)) > 1


def test_copies_without_broadcast_and_as_hot_lines(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"t{i % 7}" if i % 3 else f"u{i}") for i in range(200)], "i long, t string").repartition(5)
    res = S.split_lines(df, "t", ["i"], 0.25, 3)
    plain = sorted(r.i for r in res.val.collect())
    assert len(plain) == res.k == 50 and res.train.count() == 150
    again = S.split_lines(df.repartition(2), "t", ["i"], 0.25, 3, max_broadcast=0)
    assert sorted(r.i for r in again.val.collect()) == plain
    assert sorted(plain + [r.i for r in again.train.collect()]) == list(range(200))


@pytest.mark.parametrize("share", [0, 1, 1.25, -3, float("nan")])
def test_bad_fraction(spark, share):
    with pytest.raises(ValueError):
        S.split_lines(spark.range(3), "id", ["id"], share)


def test_missing_and_hidden_source(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        job.split_jsonl(spark, str(tmp_path / "gone"), str(tmp_path / "a"), str(tmp_path / "b"))
    (tmp_path / "_s.jsonl").write_text("x\ny\n")
    assert job.split_jsonl(spark, str(tmp_path / "_s.jsonl"), str(tmp_path / "t"), str(tmp_path / "v"), 0.5, 1) == (1, 1)


def test_radix_selection_equals_sorting(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    expected = [
        r["doc_id"]
        for r in docs.withColumn("h", S.split_key(42, F.col("doc_id"))).orderBy("h", "doc_id").limit(137).collect()
    ]
    # Force several rounds of digit selection on a small table.
    monkeypatch.setattr(S, "DIRECT_LIMIT", 3)
    res = S.split(docs, F.col("doc_id"), "doc_id", 0.137, 42)
    assert res.k == 137
    assert sorted(r["doc_id"] for r in res.val.collect()) == sorted(expected)
    assert res.train.count() == 1000 - 137


def test_selection_on_identical_keys(spark, monkeypatch):
    # All rows hash alike: the selection must continue on the tie column.
    ev = spark.read.parquet(f"{SF01}/events.parquet").select("event_id")
    monkeypatch.setattr(S, "DIRECT_LIMIT", 50)
    res = S.split(ev, F.lit("same"), "event_id", 0.05, 1)
    assert sorted(r["event_id"] for r in res.val.collect()) == list(range(500))


def test_null_keys_are_split_too(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id")
    keyed = docs.withColumn("k", F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.col("doc_id")))
    res = S.split(keyed, F.col("k"), "doc_id", 0.1, 5)
    assert res.val.count() == 100 and res.train.count() == 900


def test_lines_written_as_read(spark, tmp_path):
    src = tmp_path / "src.jsonl"
    src.write_text('  {"id": 1}  \n\n{"id": 2}\n', encoding="utf-8")
    job.split_jsonl(spark, str(src), str(tmp_path / "t"), str(tmp_path / "v"), 0.5, 1)
    out = sorted(spark.read.text(str(tmp_path / "t")).toPandas()["value"]) + sorted(
        spark.read.text(str(tmp_path / "v")).toPandas()["value"]
    )
    assert sorted(out) == sorted(['  {"id": 1}  ', '{"id": 2}'])
