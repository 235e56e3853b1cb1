"""Quality scores by histogram gradient-boosted trees (operator 8).

Statistics of each whole text (bytes, words, lines) are the only inputs.
Trees are fitted in numpy on a bounded sample of labelled rows
(``max_rows``, those of smallest id hash): features are binned at quantiles,
each level takes its split from histograms of gradients and Hessians of the
logistic loss. The fitted forest is flattened into arrays (feature, threshold
and value per node of complete trees), goes to the tasks with the function,
and is traversed for a batch of documents at a time.

Defined results: null and empty texts have all statistics 0 and get the
forest's score for that; without usable labels every score is 0.5; labels of
one document that disagree count as their mean; a null ``doc_id`` is never
held out and never learnt from; repeated rows are scored row by row; an empty
table gives no rows; other columns are no inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dialogprep.llm.common import arrow_map

FEATURES = (
    "log_bytes log_words word_bytes upper digits spaces high symbols bangs bars marks stops dashes quotes entropy "
    "distinct repeats top_word capped short long lines line_bytes same_lines"
).split()


def _class(chars: str) -> np.ndarray:
    mask = np.zeros(256)
    mask[list(chars.encode())] = 1
    return mask


_LOWER, _UPPER, _DIGIT = (_class("".join(map(chr, range(a, b)))) for a, b in ((97, 123), (65, 91), (48, 58)))
_SPACE = _class(" \t\n\x0b\x0c\r")
_HIGH = np.r_[np.zeros(128), np.ones(128)]
_SYMBOL = 1 - _LOWER - _UPPER - _DIGIT - _SPACE - _HIGH - _class(",.")
_CLASSES = np.stack(
    [_UPPER, _DIGIT, _SPACE, _HIGH, _SYMBOL, _class("!"), _class("|"), _class("#&$*%"), _class(",.;:?"), _class("-_=~"), _class("\"'<>{}[]()")]
)


def statistics(text: str | None) -> np.ndarray:
    """The features of one whole text, in the order of ``FEATURES``."""
    raw = (text or "").encode()
    if not raw:
        return np.zeros(len(FEATURES))
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    n = len(raw)
    share = counts[counts > 0] / n
    words = raw.split()
    m = max(1, len(words))
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    sizes = np.fromiter(map(len, words), float, len(words))
    lines = raw.split(b"\n")
    return np.array(
        [
            np.log1p(n),
            np.log1p(len(words)),
            sizes.sum() / m,
            *(_CLASSES @ counts / n),
            -(share * np.log2(share)).sum(),
            len(seen) / m,
            sum(map(bytes.__eq__, words, words[1:])) / m,
            max(seen.values(), default=0) / m,
            sum(map(bytes.isupper, words)) / m,
            (sizes <= 2).sum() / m,
            (sizes >= 15).sum() / m,
            np.log1p(len(lines)),
            np.log1p(n / len(lines)),
            1 - len(set(lines)) / len(lines),
        ]
    )


@dataclass
class Forest:
    """Complete trees of one depth as arrays; node ``i`` has the children
    ``2i + 1`` and ``2i + 2``, and a leaf's value stands in ``value``."""

    depth: int
    base: float
    feature: np.ndarray  # (trees, inner nodes)
    threshold: np.ndarray  # (trees, inner nodes)
    value: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        for _ in range(self.depth):
            above = np.take_along_axis(x, self.feature[trees, node], 1) > self.threshold[trees, node]
            node = 2 * node + 1 + above
        leaf = node - (2**self.depth - 1)
        return 1 / (1 + np.exp(-(self.base + self.value[trees, leaf].sum(axis=1))))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 1.0) -> Forest:
    """Boost ``trees`` histogram trees on the logistic loss."""
    inner, leaves = 2**depth - 1, 2**depth
    if not len(x):
        return Forest(depth, 0.0, np.zeros((1, inner), np.int64), np.zeros((1, inner)), np.zeros((1, leaves)))
    n, f = x.shape
    cuts = np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], axis=0)  # (bins - 1, f)
    binned = np.stack([np.searchsorted(cuts[:, j], x[:, j], side="left") for j in range(f)], 1)
    flat = binned + np.arange(f) * bins
    mean = np.clip(y.mean(), 0.01, 0.99)
    base = float(np.log(mean / (1 - mean)))
    margin = np.full(n, base)
    forest = Forest(depth, base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves)))
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width = 2**level
            at = node - (width - 1)
            cell = (at[:, None] * (f * bins) + flat).ravel()
            g = np.bincount(cell, np.repeat(grad, f), width * f * bins).reshape(width, f, bins).cumsum(2)
            h = np.bincount(cell, np.repeat(hess, f), width * f * bins).reshape(width, f, bins).cumsum(2)
            gt, ht = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[(h < 1) | (ht - h < 1)] = 0
            best = gain[:, :, :-1].reshape(width, -1).argmax(1)
            j, b = np.divmod(best, bins - 1)
            useful = gain[np.arange(width), j, b] > 1e-6
            ids = np.arange(width) + width - 1
            forest.feature[t, ids] = j
            forest.threshold[t, ids] = np.where(useful, cuts[b, j], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), j[at]] > forest.threshold[t, node])
        leaf = node - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        forest.value[t] = -rate * g / (h + ridge)
        margin += forest.value[t, leaf]
    return forest


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Forest:
    """Fit on at most ``max_rows`` labelled rows that are not held out."""
    wanted = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.avg("quality").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    # at most max_rows narrow rows, so they go to the texts, not the texts to them
    some = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(wanted), "doc_id")

    def measure(batches):
        for batch in batches:
            found = [statistics(t).tolist() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "y", "x"])

    rows = arrow_map(some, measure, "doc_id long, y double, x array<double>").collect()
    rows.sort(key=lambda r: (r.doc_id, r.x))
    return fit(np.array([r.x for r in rows]).reshape(-1, len(FEATURES)), np.array([r.y for r in rows]))


def score(docs: DataFrame, forest: Forest, name: str = "score") -> DataFrame:
    """``docs`` with the column ``name``; ``docs`` needs a ``text``."""
    docs = docs.drop(name)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            scores = np.empty(len(texts))
            for k in range(0, len(texts), 1024):
                scores[k : k + 1024] = forest.score(np.array([statistics(t) for t in texts[k : k + 1024]]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[f.name for f in schema.fields])

    return arrow_map(docs, run, schema)


def quality(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = score(docs, train(docs, labels, max_rows))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
