"""Cleaned conversations: our Parquet working form, and foreign JSON lists.

Cleaned messages are written as Parquet (one row per message, with the
conversation key and order columns) rather than one JSON file per
conversation: millions of tiny files do not scale, and Parquet keeps column
pruning and predicate pushdown for the next step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.functions.records import parse_strict
from dialogprep.operators.turns import parse_epoch_ms
from dialogprep.sources.large_lists import SEPARATOR, cut_items
from dialogprep.sources.listing import readable_copies, resolve, without_row

CLEANED_COLUMNS = ["conversation", "conversation_name", "file_name", "pos", "sender", "text", "timestamp"]


def write_cleaned(cleaned: DataFrame, path: str) -> None:
    cleaned.select(*CLEANED_COLUMNS).write.mode("overwrite").parquet(path)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# Lists up to this size are parsed whole, larger ones cut into items first
# (Spark parses JSON texts of up to 128 MB).
WHOLE_BYTES = 32 * 1024 * 1024


@dataclass
class CleanedScan:
    """Items of cleaned lists, and the files that gave none (path, reason);
    ``has_large`` if some list was too large for one task."""

    items: DataFrame
    quarantine: DataFrame
    has_large: bool = False


def parse_cleaned(value: Column) -> Column:
    """``array<variant>`` of a text that is one JSON list, else NULL."""
    return F.try_variant_get(parse_strict(value), "$", "array<variant>")


def item_columns(item: Column) -> dict[str, Column]:
    """``has_timestamp, sender, text, timestamp`` of one list item.

    ``has_timestamp``: the item is an object with a ``timestamp`` that is not
    null; ``timestamp`` is NULL where that is no number. ``text`` is the
    string form of any JSON value.
    """
    kind = F.schema_of_variant(item)
    stamp = F.try_variant_get(item, "$.timestamp", "variant")
    text = F.try_variant_get(item, "$.text", "variant")
    text_kind = F.schema_of_variant(text)
    return {
        "has_timestamp": F.coalesce(kind.startswith("OBJECT<") & stamp.isNotNull(), F.lit(False)),
        "sender": F.try_variant_get(item, "$.sender", "string"),
        "text": F.when(text_kind == "STRING", F.try_variant_get(text, "$", "string")).when(
            text.isNotNull() & (text_kind != "VOID"), F.to_json(text)
        ),
        "timestamp": parse_epoch_ms(F.try_variant_get(item, "$.timestamp", "string")),
    }


def scan_cleaned_lists(spark: SparkSession, folder: str) -> CleanedScan:
    """A folder of ``*.json`` files (not recursive, hidden names included),
    each a JSON list of ``{sender, text, timestamp}`` objects.

    Items: ``conversation`` and ``file_name`` (the file name), ``pos`` and
    the columns of :func:`item_columns`. Files that are empty, no single JSON
    value or no list go to ``quarantine``. Files of up to ``WHOLE_BYTES``
    are one task's input each; larger ones are read in ranges and cut into
    their items (:mod:`dialogprep.sources.large_lists`), so only one item has
    to be small enough to be parsed.
    """
    fs, root = resolve(spark, folder)
    schema = "conversation string, file_name string, pos int, has_timestamp boolean, sender string, text string, timestamp bigint"
    nothing = spark.createDataFrame([], "path string, reason string")
    if not fs.exists(root):
        return CleanedScan(spark.createDataFrame([], schema), nothing)
    reader = lambda: spark.read.option("pathGlobFilter", "*.json")
    scan = reader().text(root.toString(), wholetext=True)
    sources = [([root.toString()], 0)]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    hidden = [s.getPath().toString() for s in fs.globStatus(path(root, "[_.]*.json")) or [] if s.isFile()]
    if hidden:
        # a copy is named "visible" and the name of its file
        sources.append((readable_copies(spark, hidden), len("visible")))
    small = F.col("_metadata.file_size") <= WHOLE_BYTES
    parsed = items = bad = None
    for paths, prefix in sources:
        name = F.substring(_name(), prefix + 1, 4096).alias("name")
        whole = reader().text(paths, wholetext=True).where(small).select(name, parse_cleaned(F.col("value")).alias("items"))
        parsed = whole if parsed is None else parsed.union(whole)
        # the lengths alone are looked at, in tasks
        sizes = reader().format("binaryFile").load(paths)
        if not sizes.where(F.col("length") > WHOLE_BYTES).select("path").limit(1).count():
            continue
        fragments = reader().option("lineSep", SEPARATOR).text(paths).where(~small).select(
            name, F.col("_metadata.file_block_start").alias("range"), "value", F.col("_metadata.file_size").alias("size"),
        )
        cut, files = cut_items(fragments, ["name"])
        cut = cut.select("name", F.col("pos").cast("int").alias("pos"), parse_strict("item").alias("m"))
        lost = files.where("NOT is_list").select(F.col("name").alias("path"), F.lit("NO_JSON_LIST").alias("reason"))
        items, bad = (cut, lost) if items is None else (items.union(cut), bad.union(lost))
    # files of no byte are listed, but no source gives a row for them
    empty = without_row(spark, scan, reader().format("binaryFile").load(root.toString()).select("path"))
    empty = empty.select(F.regexp_extract("path", r"([^/]*)$", 1).alias("path"), "reason")
    no_list = parsed.where("items is null").select(F.col("name").alias("path"), F.lit("NO_JSON_LIST").alias("reason"))
    found = parsed.select("name", F.posexplode("items").alias("pos", "m"))
    found = found if items is None else found.union(items)
    found = found.select(
        F.col("name").alias("conversation"), F.col("name").alias("file_name"), "pos",
        *[v.alias(k) for k, v in item_columns(F.col("m")).items()],
    )
    quarantine = no_list.union(empty) if bad is None else no_list.union(empty).union(bad)
    return CleanedScan(found, quarantine.distinct(), has_large=items is not None)


def read_cleaned_lists(spark: SparkSession, folder: str, keep_dropped: bool = False) -> DataFrame:
    """The items of :func:`scan_cleaned_lists`.

    Items without a timestamp are left out, unless ``keep_dropped``;
    ``has_timestamp`` tells them apart.
    """
    items = scan_cleaned_lists(spark, folder).items
    return items if keep_dropped else items.where("has_timestamp")


def _decoded(path: Column) -> Column:
    """Paths are percent-encoded, and '+' must survive decoding."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _name() -> Column:
    return _decoded(F.regexp_extract(F.col("_metadata.file_path"), r"([^/]*)$", 1))
