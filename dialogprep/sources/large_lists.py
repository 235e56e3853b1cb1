"""JSON lists of any size, cut into their items by many tasks.

One JSON text can be parsed as a whole up to a limit only, and by one task. A
large file is read in byte ranges instead (Spark's text reader splits a file at
any separator; here records end at commas). Whether a comma separates items of
the list depends on all that stands before it: is it inside a string, and how
deep in brackets. So a first pass computes what each range does to that state,
for either state it may start in: whether it flips "inside a string", and by how
much the depth changes. A prefix scan over the ranges (one row each) gives every
range its true start, and a second pass cuts at the top-level commas. Items
that lie in one range are done then; only the pieces at the ends of ranges are
brought together.

Where every item is one JSON value and brackets enclose the whole, the file is
a list of just those items, however they were found; otherwise it is no JSON
list. So a damaged file is told as surely as by parsing it whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.functions.records import parse_strict
from dialogprep.session import ensure_checkpoint_dir

SEPARATOR = ","
_JSON_SPACE = " \t\n\r"
# Most ranges (of some 100 MB each) whose starts go to the tasks as a table.
MAX_STARTS = 200_000


def _passes():
    """The two passes over fragments in the order they stand in the file.

    Defined inside a function so that they travel to the tasks by value.
    """
    import numpy as np
    import pyarrow as pa

    def states(raw: bytes, inside: int, escaped: bool):
        """Per byte: +1/-1 for brackets, and whether it is in a string; and if
        the byte after the last one is escaped."""
        b = np.frombuffer(raw, np.uint8)
        live = np.ones(len(b), bool)
        live[0] = not escaped
        slash = np.flatnonzero(b == 92)
        after = False
        if slash.size:
            heads = np.r_[True, np.diff(slash) != 1]
            first = slash[heads][np.cumsum(heads) - 1]
            shift = (first == 0) & escaped
            marked = slash[(slash - first + shift) % 2 == 0] + 1
            after = bool(marked.size and marked[-1] == len(b))
            live[marked[: len(marked) - after]] = False
        within = (np.cumsum((b == 34) & live) + inside) % 2
        sign = ((b == 91) | (b == 123)).astype(np.int64) - ((b == 93) | (b == 125))
        return b, sign, within, after

    def chunks(batches):
        """``(list, range, bytes)`` of consecutive fragments of one range,
        each fragment with the separator after it."""
        for batch in batches:
            keys, ranges = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            values = batch.column(2).cast(pa.binary()).to_pylist()
            at = 0
            for k in range(1, len(keys) + 1):
                if k == len(keys) or keys[k] != keys[at] or ranges[k] != ranges[at]:
                    yield keys[at], ranges[at], b",".join(values[at:k]) + b",", k - at
                    at = k

    def effects(batches):
        now, out = None, []

        def flush():
            names = ("key", "range", "flips", "from_out", "from_ins", "bytes")
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.string()), *(pa.array([r[k] for r in out], pa.int64()) for k in range(1, 6))], names=names
            )
            out.clear()
            return batch

        escaped = False
        for key, place, raw, _ in chunks(batches):
            if now is None or now[:2] != [key, place]:
                if now:
                    out.append(now)
                now, escaped = [key, place, 0, 0, 0, 0], False
            _, sign, within, escaped = states(raw, now[2], escaped)
            total, inner = int(sign.sum()), int(sign[within == 1].sum())
            now[2:] = [int(within[-1]), now[3] + total - inner, now[4] + inner, now[5] + len(raw)]
            if len(out) >= 1000:
                yield flush()
        if now:
            out.append(now)
        yield flush()

    def pieces(batches, start):
        """Cut at top-level separators. The last piece of a range, which may go
        on in the next one, is marked and always there."""
        now, held, n, state = None, [], 0, None
        out, size = [], 0

        def flush():
            nonlocal size
            batch = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.int64()),
                 pa.array([r[2] for r in out], pa.int64()), pa.array([r[3] for r in out], pa.bool_()),
                 pa.array([r[4] for r in out], pa.binary()).cast(pa.string())],
                names=["key", "range", "local", "is_end", "piece"],
            )
            out.clear()
            size = 0
            return batch

        for key, place, raw, _ in chunks(batches):
            if now != (key, place):
                if now:
                    out.append((*now, n, True, b"".join(held)))
                now, held, n = (key, place), [], 0
                state = [*start(key, place), False]
            b, sign, within, escaped = states(raw, state[0], state[2])
            depth = state[1] + np.cumsum(np.where(within == 0, sign, 0))
            cuts = np.flatnonzero((b == 44) & (within == 0) & (depth == 1)).tolist()
            at = 0
            for cut in cuts:
                held.append(raw[at:cut])
                out.append((*now, n, False, b"".join(held)))
                size += len(out[-1][4])
                held, n, at = [], n + 1, cut + 1
                if size > 4 << 20:
                    yield flush()
            held.append(raw[at:])
            state = [int(within[-1]), int(depth[-1]), escaped]
        if now:
            out.append((*now, n, True, b"".join(held)))
        yield flush()

    return effects, pieces


def cut_items(fragments: DataFrame, file: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(items, files)`` of lists given as fragments.

    ``fragments`` has the column ``file`` (naming the list), ``range`` (its
    number or place), ``value`` (a text between separators) and ``size``, the
    bytes of the whole list. The fragments of a range stand one after the
    other in one partition, as a scan gives them. Items: ``file``, ``pos``,
    ``item`` (text of one JSON value). Files: ``file``, ``is_list``; those that
    are no list give no items. A null name is a list like any other.
    """
    spark = fragments.sparkSession
    ensure_checkpoint_dir(spark)
    # one name for a list, whatever columns name it
    key = F.to_json(F.struct(*file), {"ignoreNullFields": "false"})
    rows = fragments.select(key.alias("key"), F.col("range").cast("bigint").alias("range"), "value")
    effects, pieces = _passes()

    does = rows.mapInArrow(effects, "key string, range long, flips long, from_out long, from_ins long, bytes long").checkpoint(eager=True)
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    starts = does.withColumn("inside", F.coalesce(F.sum("flips").over(earlier), zero) % 2)
    starts = starts.withColumn("change", F.when(F.col("inside") == 0, F.col("from_out")).otherwise(F.col("from_ins")))
    starts = starts.withColumn("depth", F.coalesce(F.sum("change").over(earlier), zero)).select("key", "range", "inside", "depth")
    n_ranges = does.count()
    if n_ranges > MAX_STARTS:
        raise ValueError(f"{n_ranges} ranges: raise spark.sql.files.maxPartitionBytes or read fewer lists at once")
    table = spark.sparkContext.broadcast({(r["key"], r["range"]): (r["inside"], r["depth"]) for r in starts.collect()})

    def cut(batches):
        yield from pieces(batches, lambda key, place: table.value[key, place])

    found = rows.mapInArrow(cut, "key string, range long, local long, is_end boolean, piece string").checkpoint(eager=True)
    offsets = found.where("is_end").select(
        "key", "range", F.coalesce(F.sum("local").over(earlier), zero).alias("offset"),
        (F.lead("range").over(Window.partitionBy("key").orderBy("range")).isNull()).alias("final"),
    )
    placed = found.join(offsets, ["key", "range"]).withColumn("pos", F.col("offset") + F.col("local"))
    # the reader shows no separator at the very end, so one was added there
    surplus = F.col("is_end") & F.col("final")
    text = F.when(~surplus, F.col("piece")).when(F.col("piece").endswith(SEPARATOR), F.left("piece", F.length("piece") - 1))
    placed = placed.select("key", "range", "pos", F.when(surplus, F.col("pos")).alias("last"), text.alias("piece"),
                           ((F.col("local") == 0) | F.col("is_end")).alias("at_end"))
    parts = F.array_sort(F.collect_list(F.struct("range", "piece")))
    whole = F.when(F.forall(parts, lambda x: x["piece"].isNotNull()), F.array_join(F.transform(parts, lambda x: x["piece"]), ""))
    joined = placed.where("at_end").groupBy("key", "pos").agg(whole.alias("item"))
    items = placed.where("NOT at_end").select("key", "pos", F.col("piece").alias("item")).unionByName(joined)
    sizes = fragments.groupBy(*file).agg(F.max("size").alias("size")).select(key.alias("key"), *file, "size")
    ends = placed.groupBy("key").agg(F.max("last").alias("last")).join(
        does.groupBy("key").agg(F.sum("bytes").alias("bytes")), "key"
    ).join(sizes, "key")
    ends = ends.select("key", *file, "last", (F.col("bytes") - 1 == F.col("size")).alias("complete"))

    items = items.join(ends, "key")
    text = F.btrim("item", F.lit(_JSON_SPACE))
    first, last = F.col("pos") == 0, F.col("pos") == F.col("last")
    opened = F.when(first & ~text.startswith("["), F.lit(None)).when(first, F.substr(text, F.lit(2))).otherwise(text)
    closed = F.when(last & ~opened.endswith("]"), F.lit(None)).when(last, F.left(opened, F.length(opened) - 1)).otherwise(opened)
    bare = items.select("key", *file, "pos", "last", "complete", F.btrim(closed, F.lit(_JSON_SPACE)).alias("item"))
    none = F.coalesce((F.col("last") == 0) & (F.col("item") == ""), F.lit(False))
    good = F.col("complete") & (none | F.coalesce(parse_strict("item").isNotNull(), F.lit(False)))
    checked = bare.select("key", *file, "pos", "item", good.alias("good"), none.alias("none")).checkpoint(eager=True)
    files = checked.groupBy("key", *file).agg(F.every("good").alias("is_list"))
    lists = files.where("is_list").select("key")
    return checked.where("NOT none").join(lists, "key", "left_semi").select(*file, "pos", "item"), files.select(*file, "is_list")
