"""Corpus-wide line de-duplication (operator 6).

Lines are exploded map-side into 128-bit hashes of their normalised form,
one per document and form; the hashes are counted with a partial aggregation
(a line in a third of all documents costs one row per map task). Hashes over
the threshold then remove their lines, and each document is put together
again from the lines that stay, in their order. While the frequent hashes
fit the bound ``max_broadcast`` they go to the tasks as a set and no text is
shuffled; beyond it they are joined to (document, line position) rows and
only positions to drop move back to the texts.

Defined results: a null or empty text is one empty line and becomes the empty
text; keys shorter than ``min_chars`` code points are never dropped; every
row is a document of its own, also when rows repeat; an empty table gives no
rows; other columns are kept as they are.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialogprep.llm.common import arrow_map, checkpointed, row_key

_SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes) -> bytes:
    """A line without ASCII white space at its ends, A-Z in lower case."""
    return line.strip(_SPACE).lower()  # bytes.lower() changes A-Z only


def _digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars)


def _digests(text: str | None) -> dict[bytes, bytes]:
    """The distinct normalised lines of a text with their hashes."""
    return {k: _digest(k) for k in set(map(line_key, (text or "").encode().split(b"\n")))}


def frequent_lines(docs: DataFrame, min_docs: int, min_chars: int) -> DataFrame:
    """``(hash, n)`` of the normalised lines found in ``min_docs`` documents."""

    def hashes(batches):
        seen: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["hash", "n"]
            )
            seen.clear()
            return batch

        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(h for k, h in _digests(text).items() if _long_enough(k, min_chars))
                if len(seen) > 200_000:
                    yield flush()
        yield flush()

    found = arrow_map(docs.select(F.col("text").cast("string")), hashes, "hash binary, n long")
    return found.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)


def _known(frequent: DataFrame, max_broadcast: int):
    """The hashes as a broadcast set, or None where they are too many."""
    if frequent.count() > max_broadcast:
        return None
    return frequent.sparkSession.sparkContext.broadcast(frozenset(frequent.select("hash").toArrow().column("hash").to_pylist()))


def counted_by_class(docs: DataFrame, frequent: DataFrame, classes, min_docs: int, min_chars: int, max_broadcast: int) -> DataFrame:
    """``frequent`` without the lines of fewer than ``min_docs`` classes.

    Only documents that hold a frequent line are classed and counted.
    """
    known = _known(frequent, max_broadcast)

    def holding(batches):
        for batch in batches:
            found = []
            for text in batch.column(1).to_pylist():
                own = [h for k, h in _digests(text).items() if _long_enough(k, min_chars)]
                found.append([h for h in own if known is None or h in known.value])
            hashes = pa.array(found, pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([*batch.columns, hashes], names=["doc_id", "text", "row_key", "hashes"]).filter(
                pa.array([bool(x) for x in found], pa.bool_())
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row_key", row_key(F.col("doc_id"), F.col("text")))
    held = checkpointed(arrow_map(rows, holding, "doc_id long, text string, row_key struct<a:long,b:long>, hashes array<binary>"))
    of = classes(held.select("doc_id", "text")).groupBy("row_key").agg(F.min("class_id").alias("class_id"))
    lines = held.select("row_key", F.explode("hashes").alias("hash"))
    if known is None:
        lines = lines.join(frequent.select("hash"), "hash", "left_semi")
    counted = lines.join(of, "row_key").groupBy("hash", "class_id").agg(F.lit(1).alias("one"))
    result = checkpointed(counted.groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs))
    if known is not None:
        known.unpersist()
    return result


def _rebuild(docs: DataFrame, min_chars: int, test, extra: str | None = None) -> DataFrame:
    """``docs`` with ``text`` rebuilt, ``n_lines`` and ``n_dropped``.

    ``test()`` runs once a task; what it returns turns a row's ``extra``
    value into the predicate (position, key) of the lines that go.
    """
    fields = [f for f in docs.schema.fields if f.name != extra]
    schema = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name == "text" else f.dataType) for f in fields]
        + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    )
    names, at = docs.columns, docs.columns.index("text")

    def rebuild(batches):
        dropped = test()
        for batch in batches:
            more = batch.column(names.index(extra)).to_pylist() if extra else [None] * batch.num_rows
            texts, n_lines, n_dropped = [], [], []
            for text, own in zip(batch.column(at).to_pylist(), more):
                lines = (text or "").encode().split(b"\n")
                gone = dropped(own)
                kept = [
                    x for i, x in enumerate(lines)
                    if not (_long_enough(k := line_key(x), min_chars) and gone(i, k))
                ]
                texts.append(b"\n".join(kept).decode())
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
            cols = [pa.array(texts, pa.string()) if i == at else c
                    for i, c in enumerate(batch.columns) if names[i] != extra]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())],
                names=[f.name for f in schema.fields],
            )

    return arrow_map(docs, rebuild, schema)


def _positions(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(row_key, pos, hash)`` of all lines long enough."""

    def explode(batches):
        for batch in batches:
            keys, pos, hashes = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for i, line in enumerate((text or "").encode().split(b"\n")):
                    if _long_enough(k := line_key(line), min_chars):
                        keys.append(row)
                        pos.append(i)
                        hashes.append(_digest(k))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(pos, pa.int64()), pa.array(hashes, pa.binary())],
                names=["row_key", "pos", "hash"],
            )

    return arrow_map(docs.select("row_key", F.col("text").cast("string")), explode, "row_key binary, pos long, hash binary")


def dedup_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, max_broadcast: int = 2_000_000,
    classes: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """``docs`` with the remaining lines in ``text``, ``n_lines`` and
    ``n_dropped`` (clashing input columns of these names are replaced).

    With ``classes`` a line's documents are counted by class: it takes
    ``(doc_id, text)`` rows and returns ``(row_key, class_id)``. So lines that
    copies share because they are copies stay for de-duplication of
    documents, in place of going from all of them.
    """
    docs = docs.drop("n_lines", "n_dropped")
    frequent = checkpointed(frequent_lines(docs, min_docs, min_chars))
    if classes is not None:
        frequent = counted_by_class(docs, frequent, classes, min_docs, min_chars, max_broadcast)
    spread = _known(frequent, max_broadcast)
    if spread is not None:

        def by_hash():
            known = spread.value
            return lambda _: lambda i, key: _digest(key) in known

        return _rebuild(docs, min_chars, by_hash)

    # equal texts lose the same lines, so rows are addressed by their text
    keyed = docs.withColumn("row_key", F.unhex(F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)))
    texts = keyed.groupBy("row_key").agg(F.first("text").alias("text"))
    lost = (
        _positions(texts, min_chars).join(frequent.select("hash"), "hash", "left_semi")
        .groupBy("row_key").agg(F.collect_list("pos").alias("lost_pos"))
    )
    joined = keyed.join(lost, "row_key", "left").drop("row_key")

    def by_position():
        def of(own):
            known = frozenset(own or ())
            return lambda i, key: i in known

        return of

    return _rebuild(joined, min_chars, by_position, "lost_pos")
