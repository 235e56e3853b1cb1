"""Chat-export folders -> one row per raw message.

Layout: ``<inbox>/<conversation>/message_<n>.json``, each file a JSON object
with a ``messages`` list of ``{sender_name, content, timestamp_ms}``. Every
directory holding at least one ``message_*.json`` is a conversation; its
files are concatenated in file-name order.

Spark's file listing skips names that start with ``_`` or ``.`` -- and user
names can start that way -- so such directories, at any level of the inbox,
are passed to the reader explicitly. The reader runs on the executors; files are
not splittable (multi-line JSON) but each is one small task input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialogprep.sources.listing import hidden_folders, resolve, without_row

MESSAGE_GLOB = "message_*.json"

EXPORT_SCHEMA = T.StructType(
    [
        T.StructField(
            "messages",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("sender_name", T.StringType()),
                        T.StructField("content", T.StringType()),
                        # Read as text: numbers keep their literal form and a
                        # non-numeric value does not null the whole file.
                        T.StructField("timestamp_ms", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)

@dataclass
class ExportScan:
    """Raw messages plus the files that could not be read.

    ``files`` is the parse of each file (``path``, ``messages``,
    ``corrupt``); ``messages`` and ``quarantine`` are derived from it, so
    landing ``files`` once lets both be read back without parsing again.
    """

    messages: DataFrame
    quarantine: DataFrame
    files: DataFrame | None = None


def input_paths(spark: SparkSession, inbox: str) -> tuple[list[str], str] | None:
    """Paths to hand the reader, and the inbox's own path part.

    The root itself (read recursively; Spark lists sub-folders in parallel)
    plus the hidden folders below it, which the recursive listing would skip.
    Returns None when the inbox does not exist.
    """
    fs, root = resolve(spark, inbox)
    if not fs.exists(root):
        return None
    return [root.toString(), *hidden_folders(spark, inbox)], root.toUri().getPath().rstrip("/")


def empty_files(spark: SparkSession, paths: list[str], parsed: DataFrame, n_parsed: int, glob: str = MESSAGE_GLOB) -> DataFrame:
    """``path, reason`` of listed files that gave no row at all.

    Spark reads no file without bytes. ``parsed`` is the parse of the other
    files, ``n_parsed`` in number: only if the driver's listing for the scan
    is longer are names compared.
    """
    scan = export_reader(spark, glob=glob).text(paths)
    if len(scan._jdf.inputFiles()) == n_parsed:
        return spark.createDataFrame([], "path string, reason string")
    return without_row(spark, scan, parsed.select("path"))


def _empty(spark: SparkSession) -> ExportScan:
    schema = "conversation string, conversation_name string, file_name string, pos int, sender_name string, content string, timestamp_ms string"
    q = "path string, reason string"
    return ExportScan(spark.createDataFrame([], schema), spark.createDataFrame([], q))


def export_reader(spark: SparkSession, streaming: bool = False, glob: str = MESSAGE_GLOB):
    """The reader of export files, each a row of whole text (batch or
    stream); :func:`parse_files` turns them into messages."""
    reader = spark.readStream if streaming else spark.read
    return reader.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob)


def parse_export(text: Column) -> Column:
    """One export file's text as ``EXPORT_SCHEMA``; ``messages`` is NULL and
    ``_corrupt_record`` set where it is no such JSON object."""
    return F.from_json(text, EXPORT_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})


def read_exports(spark: SparkSession, inbox: str, glob: str = MESSAGE_GLOB) -> ExportScan:
    """One row per raw message with its conversation and order columns.

    ``conversation`` is the directory path relative to the inbox (unique
    even when two sub-trees share a folder name); ``conversation_name`` is
    the folder's base name. ``(file_name, pos)`` is the input order.
    Unreadable files go to ``quarantine`` (path, reason); a folder whose
    files hold no messages yields no rows.
    """
    found = input_paths(spark, inbox)
    if found is None:
        return _empty(spark)
    paths, root = found
    scan = split_files(parse_files(export_reader(spark, glob=glob).text(paths)), root)
    scan.quarantine = scan.quarantine.union(empty_files(spark, paths, scan.files, scan.files.count(), glob))
    return scan


def parse_files(df: DataFrame) -> DataFrame:
    """Parsed export files -> ``path`` (decoded), ``messages``, ``corrupt``."""
    # _metadata.file_path is a percent-encoded URI; '+' must survive decoding.
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    parsed = df.select(path.alias("path"), parse_export(F.col("value")).alias("f"))
    corrupt = F.col("f._corrupt_record").isNotNull() & F.col("f.messages").isNull()
    return parsed.select("path", "f.messages", corrupt.alias("corrupt"))


def split_files(files: DataFrame, root: str) -> ExportScan:
    """Parsed files (see :func:`parse_files`) -> messages and quarantine;
    works on streams too."""
    quarantine = files.where("corrupt").select("path", F.lit("CORRUPT_JSON").alias("reason"))
    directory = F.regexp_extract(F.col("path"), r"^(.*)/[^/]*$", 1)
    file_name = F.regexp_extract(F.col("path"), r"([^/]*)$", 1)
    # Path part of the directory (scheme and authority dropped).
    dir_part = F.regexp_replace(directory, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    relative = F.when(dir_part == F.lit(root), F.lit(".")).otherwise(
        F.substring(dir_part, len(root) + 2, 1 << 30)
    )
    messages = (
        files.where(~F.col("corrupt"))
        .select(
            relative.alias("conversation"),
            F.regexp_extract(directory, r"([^/]*)$", 1).alias("conversation_name"),
            file_name.alias("file_name"),
            F.posexplode("messages").alias("pos", "m"),
        )
        .select(
            "conversation",
            "conversation_name",
            "file_name",
            "pos",
            F.col("m.sender_name").alias("sender_name"),
            F.col("m.content").alias("content"),
            F.col("m.timestamp_ms").alias("timestamp_ms"),
        )
    )
    return ExportScan(messages=messages, quarantine=quarantine, files=files)
