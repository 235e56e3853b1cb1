"""The driver contract and the layout helpers."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from dialogprep.operators.layout import filter_once, keep_nonnull, spread


def test_entry_runs_on_smallest_scale(spark):
    df = E.entry(spark)
    assert df.columns == ["conv_id", "turn", "fp_key"]
    assert df.count() > 0


def test_every_query_has_an_oracle_and_named_columns(spark):
    q, o = E.queries(), E.oracle_sql()
    optional = {n for n in q if n.startswith("op") and n[2].isdigit() or n == "pipeline"}
    assert set(q) - optional == set(o) - optional and set(o) <= set(q)
    for name in ("noise_filter", "merge_blocks", "split_val", "validation_counts"):
        cols = q[name](spark, SF001).columns
        assert len(cols) == len(set(cols)) and all(cols)


def test_layout_helpers(spark):
    df = spark.range(0, 100, numPartitions=1).withColumn("v", F.when(F.col("id") % 3 == 0, F.col("id")))
    wide = spread(df, 4)
    assert wide.rdd.getNumPartitions() == 4 and wide.count() == 100
    assert spread(wide, 2) is wide
    kept = keep_nonnull(df, F.col("v") * 2, "w")
    assert sorted(r.w for r in kept.collect()) == [i * 2 for i in range(0, 100, 3)]
    assert filter_once(df, F.col("id") < 10).count() == 10
