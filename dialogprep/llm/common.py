"""Helpers shared by the operators: reading tables, cutting lineage, sizes."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import dialogprep
from dialogprep.session import ensure_checkpoint_dir

# ASCII white space as the contracts define it: \x20 and \x09-\x0D.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Reliable: the files outlive executors. Partitions and the order of rows
    inside them are fixed from here on.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int, n_rows: int | None = None) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows.

    ``df`` should be checkpointed, for it is counted here. Beyond the bound
    it comes back unmarked and the join is a shuffled one, whose hot keys
    AQE splits.
    """
    if (df.count() if n_rows is None else n_rows) <= max_rows:
        return F.broadcast(df)
    return df


# What a task takes of narrow rows, about.
TASK_BYTES = 8 << 20


def gathered(df: DataFrame, n_rows: int, row_bytes: int = 32) -> DataFrame:
    """``df`` of at most ``n_rows`` rows in no more partitions than those rows
    need, yet enough for all cores: tables of a few rows, made by a shuffle of
    very many partitions, would cost a task, files and log lines for each of
    them in every step. Larger tables stay as they are dealt."""
    need = -(-n_rows * row_bytes // TASK_BYTES)
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, need))


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that stand for a row's id and text, nulls included."""
    return F.struct(F.xxhash64(doc_id, text).alias("a"), F.xxhash64(F.lit(1), text, doc_id).alias("b"))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once a session.

    ``addPyFile`` serves a zip of the source files from the driver, so tasks
    can import it wherever they run; nothing has to be installed there.
    """
    sc = spark.sparkContext
    if getattr(sc, "_dialogprep_shipped", False):
        return
    package = Path(dialogprep.__file__).parent
    target = Path(tempfile.mkdtemp(prefix="dialogprep-ship-")) / "dialogprep.zip"
    with zipfile.ZipFile(target, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, str(Path(package.name) / source.relative_to(package)))
    sc.addPyFile(str(target))
    sc._dialogprep_shipped = True


def release_memory() -> None:
    """Give back what this Python worker has freed but still holds; workers
    are used again by later stages."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # no GNU libc


# Rows of whole texts, and bytes of them, that a task holds at once.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def arrow_map(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow`` with this package importable in the tasks, and
    batches of at most ``BATCH_ROWS`` rows and some ``BATCH_BYTES`` bytes:
    texts can be long. Smaller limits of the session stay. A task's worker
    gives its memory back at the end."""
    spark = df.sparkSession
    ship_package(spark)
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(key).lower().removesuffix("b")
        if now.lstrip("-").isdigit() and not 0 < int(now) <= most:
            spark.conf.set(key, str(most))

    def run(batches):
        try:
            yield from fn(batches)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)
