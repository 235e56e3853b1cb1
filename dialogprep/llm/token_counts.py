"""Token counts of whole texts (operator 3).

Two tiers of lookup inside one map-side pass: a broadcast table holds the
token lengths of the frequent pieces of the corpus, and each Python worker
encodes the others once and keeps them in a bounded cache. No piece is ever
shuffled and a document never leaves its partition. The table only warms the
lookup; counts are the library's whatever it holds, so it is filled from a
bounded sample (``sample_docs``, ``sample_chars``, ``table_size``).

Defined results: a null or empty text has 0 bytes and 0 tokens; the text of
an added special token counts as that token, as the library does by default;
repeated rows and null ids are counted row by row; an empty table gives no
rows; further columns of the input are ignored.
"""

from __future__ import annotations

import uuid
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.bpe import encoder
from dialogprep.llm.common import arrow_map

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def frequent_pieces(
    docs: DataFrame, sample_docs: int, sample_chars: int, table_size: int
) -> list[str]:
    """The most frequent pieces of a Bernoulli sample over all rows.

    Bounded: about ``sample_docs`` documents, ``sample_chars`` characters of
    each, and ``table_size`` pieces in the end.
    """
    n = docs.count()
    if not n:
        return []
    share = min(1.0, sample_docs / n)

    def pieces(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update((text or "")[:sample_chars].split(" ")[1:-1])
        top = seen.most_common(table_size)
        yield pa.RecordBatch.from_pydict(
            {"piece": [p for p, _ in top], "n": [c for _, c in top]},
            schema=pa.schema([("piece", pa.string()), ("n", pa.int64())]),
        )

    found = arrow_map(docs.select("text").sample(share, seed=7), pieces, "piece string, n long")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(table_size)
    return [r.piece for r in top.collect() if len(r.piece) <= 64]


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    limit: int = 1024,
    sample_docs: int = 4096,
    sample_chars: int = 20_000,
    table_size: int = 50_000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``."""
    spark = docs.sparkSession
    pieces = frequent_pieces(docs, sample_docs, sample_chars, table_size)
    enc = encoder(tokenizer_path, True)
    table = spark.sparkContext.broadcast({p: enc.library(" " + p) for p in pieces})
    mark = uuid.uuid4().hex

    def counts(batches):
        enc = encoder(tokenizer_path, True)
        if enc.warmed != mark:
            enc.spaced.warm(table.value)
            enc.warmed = mark
        for batch in batches:
            n_bytes, n_tokens = [], []
            for text in batch.column(1).to_pylist():
                n_bytes.append(len(text.encode()) if text else 0)
                n_tokens.append(enc(text))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_bytes, pa.int64()),
                    pa.array(n_tokens, pa.int64()),
                    pa.array([x > limit for x in n_tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), counts, SCHEMA)
