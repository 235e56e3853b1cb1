"""Lines in one order over many part files, with a manifest that proves it.

Rows are range-partitioned and sorted, fixed in the checkpoint folder, and
written from there, so part file ``i`` holds partition ``i``. The manifest has
one row per part file: its name, rows, and first and last key. It is checked
before the write counts as done: keys rise from part to part, and every file
holds the rows it should.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialogprep.session import ensure_checkpoint_dir
from dialogprep.sources.listing import read_small_text
from dialogprep.sources.publish import _Files

MANIFEST = "_order.json"


def write_ordered(df: DataFrame, value: Column | str, keys: Sequence[str], path: str) -> list[dict]:
    """Write ``value`` as lines in the order of ``keys``; returns the manifest,
    which also lies in the folder (Spark's readers skip its name).

    ``path`` is a folder to be created (a publication's, as a rule). Rows of
    equal keys keep no particular order. No row gives an empty manifest.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    v = F.col(value) if isinstance(value, str) else value
    key = F.struct(*keys)
    rows = df.select(v.alias("value"), key.alias("key")).orderBy("key").checkpoint(eager=True)
    rows.select("value").write.mode("overwrite").text(path)
    # one row per partition
    parts = (
        rows.groupBy(F.spark_partition_id().alias("part"))
        .agg(F.count("*").alias("rows"), F.min("key").alias("first"), F.max("key").alias("last"))
    )
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("int")
    written = spark.read.text(path).groupBy(number.alias("part"), F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("found"))
    both = parts.join(written, "part", "full").select(
        "part", "file", "rows", "found", F.to_json("first").alias("first"), F.to_json("last").alias("last")
    )
    found = sorted(both.collect(), key=lambda r: r["part"])
    for r in found:
        if r["rows"] != r["found"]:
            raise OSError(f"part {r['part']} of {path} has {r['found']} lines, not {r['rows']}")
    overlap = parts.select(F.col("part"), "first", "last", F.rank().over(Window.orderBy("part")).alias("n"))  # one row per part file
    after = overlap.select((F.col("n") - 1).alias("n"), F.col("first").alias("next"))
    if overlap.join(after, "n").where("last > next").limit(1).count():
        raise OSError(f"the parts of {path} are not in order")
    manifest = [{"part": r["part"], "file": r["file"], "rows": r["rows"], "first": r["first"], "last": r["last"]} for r in found]
    _Files(spark).write(f"{path.rstrip('/')}/{MANIFEST}", json.dumps(manifest))
    return manifest


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """``position, value`` of a folder that :func:`write_ordered` wrote:
    offsets come from the manifest, so files are read side by side."""
    manifest = json.loads(read_small_text(spark, f"{path.rstrip('/')}/{MANIFEST}"))
    offsets, total = [], 0
    for part in manifest:
        offsets.append((part["file"], total))
        total += part["rows"]
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    local = lines.withColumn("n", F.row_number().over(Window.partitionBy("file").orderBy("block", "row_id")))
    start = spark.createDataFrame(offsets, "file string, start bigint")
    return local.join(start, "file").select((F.col("start") + F.col("n")).alias("position"), "value")
