"""Document fingerprints from closed syncmers (operator 10).

A k-mer of the text's bytes is a closed syncmer when the smallest of its
inner s-mers (by hash) is the first or the last one. That depends on the
k-mer alone, so an edit moves no anchor outside the bytes it touches, and a
text and its edited version have the same anchors wherever they agree. All
occurrences of all anchors of a text, in order of position, make its
fingerprint: each one's hash and its distance from the one before. It grows
with its text (some two bytes a byte); stretches of one repeated anchor (a
letter held down) take one entry.

The likeness of two fingerprints is the Dice coefficient of their anchors,
counting only matches that come in the same order in both. What both begin
with and what both end with matches; between them an anchor's n-th occurrence
matches its n-th occurrence in the other, counted from the front or from the
back, whichever gives more matches in order. For texts without repeated anchors
that is the longest common subsequence of the anchors, for others at most that.

Each document also meets the next one by ascending ``doc_id``. Documents are
dealt by ranges of ids, sorted inside them, and read as a stream; the first
document of each range also goes to the range before it (the first of all to
the last), so no task needs another one's rows and the texts move once.

Defined results: a null text is the empty one, whose fingerprint is the empty
string; a text without any syncmer (under 16 bytes, or a few more) has one
anchor, the hash of the whole text; two empty fingerprints are alike (1.0),
an empty and another one are not (0.0); rows of equal ids are ordered by
their texts, null ids come first; a single row is its own next; an empty
table gives no rows; further columns are ignored. Very long texts are cut
into overlapping blocks, which changes no anchor; one text's anchors (12 bytes
each) fit into a task's memory.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import arrow_map

S, K = 8, 16  # s-mers of 8 bytes fit one integer; a k-mer is two of them
_B, _C = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BLOCK = 1 << 20
OUT_BYTES = 1 << 24  # of fingerprints that a task holds before it hands them on

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    x = (x ^ (x >> np.uint64(29))) * _C
    return x ^ (x >> np.uint64(32))


def _block_syncmers(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(positions, 32-bit hashes)`` of the closed syncmers of ``raw``."""
    b = np.frombuffer(raw, np.uint8)
    n = len(b) - S + 1
    # all s-mers as integers: the 8 bytes from each position on
    v = np.lib.stride_tricks.as_strided(b, (n, S), (1, 1)).copy().view(np.uint64).ravel()
    h = _mix(v)
    low = np.minimum(h[:-1], h[1:])
    low = np.minimum(low[:-2], low[2:])
    low = np.minimum(low[:-4], low[4:])  # over 8 s-mers
    low = np.minimum(low[:-1], h[K - S :])  # over the 9 of a k-mer
    at = np.nonzero((h[: len(low)] == low) | (h[K - S :] == low))[0]
    return at, (_mix(h[at] * _C + h[at + K - S]) >> np.uint64(32)).astype(np.uint32)


def anchors(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """``(hashes, positions)`` of all anchors, in order of position."""
    ats, codes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for begin in range(0, len(raw) - K + 1, _BLOCK):
        at, code = _block_syncmers(raw[begin : begin + _BLOCK + K - 1])  # blocks overlap by K - 1, so no k-mer is cut
        ats.append(at + begin)
        codes.append(code)
    code, at = np.concatenate(codes), np.concatenate(ats)
    if raw and not len(code):
        return np.array([xxhash.xxh32_intdigest(raw)], np.uint32), np.zeros(1, np.int64)
    return code, at


def to_string(code: np.ndarray, at: np.ndarray) -> str:
    """Hash (8 hex digits) and distance per anchor; ``*n`` for n equal entries in a row."""
    gap = np.diff(at, prepend=0)
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (gap[1:] != gap[:-1])
    heads = np.nonzero(new)[0]
    times = np.diff(np.append(heads, len(code)))
    out = list(map("%08x%x".__mod__, zip(code[heads].tolist(), gap[heads].tolist())))
    for i in np.nonzero(times > 1)[0].tolist():
        out[i] += f"*{times[i]:x}"
    return ".".join(out)


def from_string(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    """The anchors that ``to_string`` wrote."""
    entries = [x.partition("*") for x in fingerprint.split(".")] if fingerprint else []
    times = [int(n or "1", 16) for _, _, n in entries]
    code = np.repeat(np.array([int(x[:8], 16) for x, _, _ in entries], np.uint32), times)
    return code, np.cumsum(np.repeat(np.array([int(x[8:], 16) for x, _, _ in entries], np.int64), times))


def _rising(at: np.ndarray) -> int:
    """Length of the longest run that rises, in steps or not."""
    if (at[1:] > at[:-1]).all():
        return len(at)
    tails: list[int] = []
    for p in at.tolist():
        if not tails or p > tails[-1]:
            tails.append(p)
        else:
            tails[bisect_left(tails, p)] = p
    return len(tails)


def _numbered(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of its occurrence as one integer, ascending; the place of each."""
    order = np.argsort(code, kind="stable")
    ordered = code[order]
    start = np.searchsorted(ordered, ordered)
    return (ordered.astype(np.uint64) << np.uint64(32)) + (np.arange(len(code)) - start).astype(np.uint64), order


def _by_number(a: np.ndarray, b: np.ndarray) -> int:
    """Matches in order, an anchor's n-th occurrence with its n-th one."""
    (x, place), (y, other) = _numbered(a), _numbered(b)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return _rising(other[j][np.argsort(place[i])])


def _same_start(a: np.ndarray, b: np.ndarray) -> int:
    n = min(len(a), len(b))
    differ = np.nonzero(a[:n] != b[:n])[0]
    return int(differ[0]) if len(differ) else n


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of two texts' anchors (hashes in order) that match, 0 to 1."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    first = _same_start(a, b)
    x, y = a[first:], b[first:]
    last = _same_start(x[::-1], y[::-1])
    x, y = x[: len(x) - last], y[: len(y) - last]
    between = max(_by_number(x, y), _by_number(x[::-1], y[::-1])) if len(x) and len(y) else 0
    return 2 * (first + last + between) / (len(a) + len(b))


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of the next."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def _dealt(docs: DataFrame, n_ranges: int) -> DataFrame:
    """``range, ahead, doc_id, text``, each range sorted in one partition."""
    bounds, least, nulls = docs.agg(
        F.percentile_approx("doc_id", [i / n_ranges for i in range(1, n_ranges)], 10 * n_ranges) if n_ranges > 1 else F.array(),
        F.min("doc_id"),
        F.max(F.col("doc_id").isNull()),
    ).first()
    # every bound is the id of a document, the first one of its range
    bounds = np.array(sorted({int(x) for x in bounds or []} - (set() if nulls else {least})), np.int64)
    last = len(bounds)

    def deal(batches):
        for batch in batches:
            ids = batch.column(0)
            known = np.asarray(ids.is_valid())
            value = ids.fill_null(0).to_numpy()
            own = np.where(known, np.searchsorted(bounds, value, side="right"), 0)
            is_bound = known & np.isin(value, bounds)
            is_first = ~known if nulls else known & (value == least) if least is not None else ~known
            rows = np.concatenate([np.arange(len(own)), np.nonzero(is_bound)[0], np.nonzero(is_first)[0]])
            where = np.concatenate([own, own[is_bound] - 1, np.full(is_first.sum(), last)])
            ahead = np.zeros(len(rows), np.int32)
            ahead[len(own) :] = 1
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(where, pa.int64()), pa.array(ahead), ids.take(rows), batch.column(1).take(rows)],
                names=["range", "ahead", "doc_id", "text"],
            )

    rows = arrow_map(docs, deal, "range long, ahead int, doc_id long, text string")
    return rows.repartition("range").sortWithinPartitions("range", "ahead", F.col("doc_id").asc_nulls_first(), "text")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: see ``SCHEMA``."""
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def judge(doc_id, text, own, following, ahead):
        changed = edited(text, following)
        raw = changed.encode()
        new = own if changed == text else anchors(raw)
        return (
            doc_id, len(text), hashlib.sha256(raw).hexdigest(), to_string(*own), to_string(*new),
            likeness(own[0], new[0]), likeness(own[0], ahead[0]),
        )

    def made(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(list(zip(*out)) or [[]] * 7, [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2)],
            names=[f.split()[0] for f in SCHEMA.split(", ")],
        )

    def run(batches):
        held, done = None, None  # the row that waits for its next; the range that has met its next
        for batch in batches:
            out, held_bytes = [], 0
            for where, ahead, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
                if where == done or (ahead and (held is None or held[0] != where)):
                    continue
                found = anchors(text.encode())
                if held is not None:
                    out.append(judge(*held[1:], text, found))
                    held_bytes += len(out[-1][3]) + len(out[-1][4])
                held = None if ahead else (where, doc_id, text, found)
                done = where if ahead else None
                if held_bytes > OUT_BYTES:
                    yield made(out)
                    out, held_bytes = [], 0
            yield made(out)

    return arrow_map(_dealt(docs, 4 * width), run, SCHEMA)
