"""Paths and files as the session's Hadoop file systems see them.

Spark's readers skip names that begin with ``_`` or ``.``. User names, and
so folders and files of an export, can begin that way, so what the readers
would skip is found here and handed to them by explicit paths.
"""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.session import ensure_checkpoint_dir


def resolve(spark: SparkSession, path: str):
    """``(file system, qualified Hadoop path)`` of a path or URI."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(hpath)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = resolve(spark, path)
    return bool(fs.exists(hpath))


def is_hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def _glob(spark: SparkSession, fs, root, pattern: str):
    jvm = spark.sparkContext._jvm
    return fs.globStatus(jvm.org.apache.hadoop.fs.Path(root, pattern)) or []


def hidden_folders(spark: SparkSession, root_path: str) -> list[str]:
    """Folders below ``root_path``, at any level, with a hidden name.

    One glob per level, evaluated by the file system client: only hidden
    entries come back to Python, not one call per folder.
    """
    fs, root = resolve(spark, root_path)
    found: list[str] = []
    above = ""
    while True:
        found += [s.getPath().toString() for s in _glob(spark, fs, root, above + "[_.]*") if s.isDirectory()]
        above += "*/"
        if not len(_glob(spark, fs, root, above)):
            return found


def readable_copies(spark: SparkSession, paths: list[str], prefix: str = "visible") -> list[str]:
    """Copies of hidden files under names that Spark's readers accept.

    The readers ignore a file with a hidden name even as an explicit path.
    Copies are streamed into the shared checkpoint folder, each in a folder
    of its own as ``<prefix><name>``, and go when the application ends.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    out = []
    for path in paths:
        fs, source = resolve(spark, path)
        target_fs, target = resolve(spark, f"{ensure_checkpoint_dir(spark)}/copies/{uuid.uuid4().hex}/{prefix}{source.getName()}")
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, target_fs, target, False, conf)
        target_fs.deleteOnExit(target.getParent())
        out.append(target.toString())
    return out


def read_small_text(spark: SparkSession, path: str) -> str:
    """A small file's whole text, through the file system's own stream."""
    fs, hpath = resolve(spark, path)
    stream = fs.open(hpath)
    try:
        data = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def without_row(spark: SparkSession, scan: DataFrame, seen: DataFrame) -> DataFrame:
    """``path, reason`` of the files a scan lists that are not in ``seen``
    (one column of decoded paths): files of no byte give no row."""
    # "file:///x" and "file:/x" are one file
    plain = F.regexp_replace("path", "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")
    paths = spark.createDataFrame([(unquote(f),) for f in scan.inputFiles()], "path string").select(plain.alias("path"))
    return paths.join(seen.toDF("path").select(plain.alias("path")), "path", "left_anti").select(
        "path", F.lit("EMPTY_FILE").alias("reason")
    )


def check_apart(spark: SparkSession, inputs: dict[str, str | None], outputs: dict[str, str | None]) -> None:
    """Raise ValueError, before anything is written, when an output is the
    same as, contains, or lies under an input or another output."""

    def qualified(named):
        return {k: resolve(spark, p)[1].toString().rstrip("/") + "/" for k, p in named.items() if p}

    outs = qualified(outputs)
    others = qualified(inputs) | outs
    for name, out in outs.items():
        for other, path in others.items():
            if name != other and (out.startswith(path) or path.startswith(out)):
                raise ValueError(f"{name} ({out}) and {other} ({path}) must not be the same or nested folders")
