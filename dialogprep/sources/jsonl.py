"""JSON-lines datasets: read with a stable line order, write one value per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.functions.text import py_strip
from dialogprep.sources.listing import is_hidden, path_exists, readable_copies, resolve

__all__ = ["path_exists", "read_lines", "to_json_line", "write_lines"]


def read_lines(spark: SparkSession, path: str, keep_blank: bool = False) -> DataFrame:
    """Lines of a JSONL file or folder, stripped, blank ones dropped.

    Columns: ``line`` (stripped text), ``raw`` (the line as read, without
    its line break), ``file`` (path), ``block`` (start of the file split),
    ``row_id`` (increasing within a split, unique per line). Ordering by
    ``(file, block, row_id)`` is the file order.
    """
    fs, source = resolve(spark, path)
    if not fs.exists(source):
        raise FileNotFoundError(f"Source '{path}' not found.")
    if is_hidden(source.getName()) and fs.getFileStatus(source).isFile():
        path = readable_copies(spark, [path])[0]
    df = spark.read.text(path).select(
        F.col("value"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    df = df.withColumn("line", py_strip("value")).withColumnRenamed("value", "raw")
    if not keep_blank:
        df = df.where(F.col("line") != "")
    return df


def write_lines(df: DataFrame, value: Column | str, path: str, partition_by: str | None = None) -> None:
    """Write one text line per row (overwrite)."""
    v = F.col(value) if isinstance(value, str) else value
    cols = [v.alias("value")] + ([F.col(partition_by)] if partition_by else [])
    writer = df.select(*cols).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.text(path)


def to_json_line(record: Column) -> Column:
    """Compact JSON text of a struct (non-ASCII kept as is)."""
    return F.to_json(record)
