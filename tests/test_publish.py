"""Outputs appear whole or not at all, wherever a publication stops."""

import json

import pytest
from pyspark.sql import functions as F

from dialogprep.operators import validate as V
from dialogprep.plans import job
from dialogprep.sources import publish
from dialogprep.sources.listing import path_exists
from dialogprep.sources.ordered import read_ordered, write_ordered
from dialogprep.sources.publish import Publication, recover


class Stop(BaseException):
    """The driver dies."""


def put(spark, tmp_path, names, text):
    with Publication(spark, {n: str(tmp_path / n) for n in names}) as out:
        for n in names:
            spark.range(3).select(F.lit(f"{text} {n}").alias("value")).write.text(out.path(n))


def contents(spark, tmp_path, names):
    return {n: sorted({r.value for r in spark.read.text(str(tmp_path / n)).collect()}) for n in names if (tmp_path / n).exists()}


def hidden(tmp_path):
    return sorted(p.name for p in tmp_path.rglob("*") if p.name.startswith(("_a", "_b", "_publish")))


def test_a_publication_replaces_all_outputs(spark, tmp_path):
    names = ["a", "x/b"]
    put(spark, tmp_path, names, "old")
    put(spark, tmp_path, names, "new")
    assert contents(spark, tmp_path, names) == {"a": ["new a"], "x/b": ["new x/b"]}
    assert hidden(tmp_path) == []


def test_a_failed_task_leaves_the_old_outputs(spark, tmp_path):
    put(spark, tmp_path, ["a", "b"], "old")
    with pytest.raises(Exception, match="no luck"):
        with Publication(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}) as out:
            spark.range(3).select(F.lit("new").alias("value")).write.text(out.path("a"))
            spark.range(3).select(F.raise_error(F.lit("no luck")).cast("string").alias("value")).write.text(out.path("b"))
    assert contents(spark, tmp_path, ["a", "b"]) == {"a": ["old a"], "b": ["old b"]}
    assert hidden(tmp_path) == []


@pytest.mark.parametrize("step", range(12))
def test_a_stop_at_any_step_is_mended(spark, tmp_path, monkeypatch, step):
    """Every rename of a publication in turn is the one that never happens."""
    names = ["a", "x/b"]
    put(spark, tmp_path, names, "old")
    true, seen = publish._rename, [0]

    def rename(fs, source, target):
        if seen[0] == step:
            raise Stop
        seen[0] += 1
        true(fs, source, target)

    with monkeypatch.context() as m:
        m.setattr(publish, "_rename", rename)
        try:
            put(spark, tmp_path, names, "new")
            stopped = False
        except Stop:
            stopped = True
    # any job that publishes to one of the targets mends all of them
    done = recover(spark, [str(tmp_path / "x/b")]) + recover(spark, [str(tmp_path / "a")])
    got = contents(spark, tmp_path, names)
    assert got in ({"a": ["old a"], "x/b": ["old x/b"]}, {"a": ["new a"], "x/b": ["new x/b"]})
    assert hidden(tmp_path) == []
    if step >= 2 and stopped:  # both manifests were written: it goes forward
        assert got["a"] == ["new a"] and any(d.startswith("finished") for d in done)
    if step < 2:
        assert got["a"] == ["old a"]
    if not stopped:
        assert got["a"] == ["new a"]


def test_a_copy_broken_off_half_way_is_completed(spark, tmp_path, monkeypatch):
    """A store without renames: some files of a folder have arrived."""
    names = ["a"]
    put(spark, tmp_path, names, "old")
    true = publish._rename

    def rename(fs, source, target):
        if ".staging-" in source.getName():
            some = next(p for p in (tmp_path / source.getName()).iterdir() if p.name.startswith("part-"))
            (tmp_path / "a").mkdir()
            some.rename(tmp_path / "a" / some.name)
            raise Stop
        true(fs, source, target)

    with monkeypatch.context() as m:
        m.setattr(publish, "_rename", rename)
        with pytest.raises(Stop):
            put(spark, tmp_path, names, "new")
    recover(spark, [str(tmp_path / "a")])
    assert [r.value for r in spark.read.text(str(tmp_path / "a")).collect()] == ["new a"] * 3
    assert hidden(tmp_path) == []


def test_an_output_without_rows_is_an_empty_folder(spark, tmp_path):
    with Publication(spark, {"a": str(tmp_path / "a"), "b": None}):
        pass
    assert path_exists(spark, str(tmp_path / "a")) and spark.read.schema("value string").text(str(tmp_path / "a")).count() == 0


def record(i):
    return json.dumps({"messages": [{"role": "user", "content": f"question {i}"}, {"role": "assistant", "content": "yes"}]})


def test_validation_that_fails_keeps_the_old_data_set(spark, tmp_path, monkeypatch):
    (tmp_path / "in.jsonl").write_text("\n".join(record(i) for i in range(20)))
    target = str(tmp_path / "out")
    assert job.validate_jsonl(spark, str(tmp_path / "in.jsonl"), target).valid == 20
    before = sorted(r.value for r in spark.read.text(target).collect())
    broken = V.output_value

    def failing(lines, line="line"):
        out = broken(lines, line)
        return out.withColumn("value", F.when(F.col(line).contains("question 7"), F.raise_error(F.lit("lost"))).otherwise(F.col("value")))

    (tmp_path / "in.jsonl").write_text("\n".join(record(i) for i in range(5, 10)))
    with monkeypatch.context() as m:
        m.setattr(V, "output_value", failing)
        with pytest.raises(Exception, match="lost"):
            job.validate_jsonl(spark, str(tmp_path / "in.jsonl"), target)
    assert sorted(r.value for r in spark.read.text(target).collect()) == before
    assert job.validate_jsonl(spark, str(tmp_path / "in.jsonl"), target).valid == 5
    assert spark.read.text(target).count() == 5


def test_split_writes_both_sides_in_one_pass(spark, tmp_path):
    lines = [record(i % 30) for i in range(100)] + ["", "  "]
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    n = job.split_jsonl(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "t"), str(tmp_path / "v"), 0.25, 3)
    assert n == (75, 25)
    sides = [spark.read.text(str(tmp_path / d)).collect() for d in ("t", "v")]
    assert [len(s) for s in sides] == [75, 25]
    assert sorted(r.value for s in sides for r in s) == sorted(x for x in lines if x.strip())
    assert not list(tmp_path.glob("_*"))


def test_ordered_lines_with_their_manifest(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.concat(F.lit("line "), F.col("id")).alias("v"))
    path = str(tmp_path / "o")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = write_ordered(df.repartition(4), "v", ["k"], path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(p["rows"] for p in manifest) == 1000 and len(manifest) > 1
    bounds = [json.loads(p[x])["k"] for p in manifest for x in ("first", "last")]
    assert bounds == sorted(bounds) and bounds[0] == 0 and bounds[-1] == 999
    got = {r.position: r.value for r in read_ordered(spark, path).collect()}
    want = {i * 7919 % 1000 + 1: f"line {i}" for i in range(1000)}
    assert got == want
    assert write_ordered(df.limit(0), "v", ["k"], str(tmp_path / "none")) == []


def test_a_part_with_missing_lines_is_noticed(spark, tmp_path):
    df = spark.range(10).select(F.col("id").alias("k"), F.when(F.col("id") == 3, F.lit("two\nlines")).otherwise("one").alias("v"))
    with pytest.raises(OSError, match="lines, not"):
        write_ordered(df, "v", ["k"], str(tmp_path / "o"))
