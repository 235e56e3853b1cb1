"""Periodic stretches of words in whole texts (operator 12).

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are equal) and a length of at least ``max(min_length,
min_exponent * q)`` that no neighbouring word extends keeping that period.

Runs come from the branching tandem repeats of an enhanced suffix array (suffix
order, its inverse, LCP values), without any tree. Per batch of documents:

1. Suffixes are put in order by prefix doubling. Words of different documents
   never compare equal, so one array holds many documents, and only groups
   of suffixes that are still tied are sorted again.
2. An LCP interval of depth ``d`` is the stretch of suffixes that share their
   first ``d`` words; its ends come from a descent in a table of range minima.
   For each suffix ``i`` in a child other than the largest, ``ISA[i + d]`` and
   ``ISA[i - d]`` are tested for being in the interval but in another child:
   then a square of period ``d`` begins at ``i`` (or ``i - d``) that cannot be
   moved to the right.
3. The square is rotated to the left as far as it goes, by the ranks of the
   doubling rounds; the rotations of one run merge into one row, and of
   several periods of one stretch (multiples of the smallest) the smallest
   stays.

An interval of fewer than ``min_exponent`` suffixes can hold no run: a run of
period ``q`` starts its ``q`` words that many times.

Defined results: a null or empty text, or one without words, has no runs and
the collapsed text ''; null ids and repeated rows are handled row by row; an
empty table gives no rows; further columns of the input are ignored. A text is
handled whole by one task at any length; memory is some 100 bytes a word, and
4 more per word and doubling round (at most log2 of the longest repeat).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import arrow_map

SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
# Words whose suffixes are put in order at once; a longer text goes alone.
CHUNK_WORDS = 1 << 17


def suffix_order(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Suffix array, LCP array and the ranks after each doubling round.

    ``codes`` numbers the words so that words of different documents differ;
    ``ends[i]`` is where the document of word ``i`` ends. ``ranks[r][i]`` is
    equal for two words iff the ``2**r`` words from each on are equal.
    ``lcp[p]`` belongs to the suffixes at ``p - 1`` and ``p``.
    """
    n = len(codes)
    sa = np.argsort(codes, kind="stable")
    apart = np.r_[True, np.diff(codes[sa]) != 0]
    split_in = np.where(apart, 0, -1).astype(np.int8)  # round that told p from p - 1
    rank = np.empty(n, np.int32)
    rank[sa] = np.flatnonzero(apart)[np.cumsum(apart) - 1]
    ranks = [rank.copy()]
    tied = np.flatnonzero(~apart | ~np.r_[apart[1:], True])
    while tied.size:
        step = 1 << (len(ranks) - 1)
        at = sa[tied]
        later = at + step
        inside = later < ends[at]
        second = np.zeros(len(at), np.int64)
        second[inside] = rank[later[inside]] + 1
        key = rank[at].astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        sa[tied] = at
        apart = np.r_[True, np.diff(key) != 0]
        fresh = tied[apart]
        split_in[fresh[split_in[fresh] < 0]] = len(ranks)
        rank[at] = fresh[np.cumsum(apart) - 1]
        ranks.append(rank.copy())
        tied = tied[~apart | ~np.r_[apart[1:], True]]

    lcp = np.zeros(n, np.int32)
    for r in range(len(ranks) - 2, -1, -1):
        p = np.flatnonzero(split_in > r)
        have = lcp[p]
        i, j = sa[p - 1] + have, sa[p] + have
        inside = (i < ends[sa[p - 1]]) & (j < ends[sa[p]])
        p, i, j = p[inside], i[inside], j[inside]
        lcp[p[ranks[r][i] == ranks[r][j]]] += 1 << r
    return sa, lcp, ranks


class _Minima:
    """First place on either side where the LCP falls below a bound."""

    def __init__(self, lcp: np.ndarray):
        low = np.r_[lcp, 0].astype(np.int32)
        self.rows = [low]
        while low.any() and (1 << len(self.rows)) <= len(lcp):
            half = 1 << (len(self.rows) - 1)
            low = np.minimum(low, np.r_[low[half:], np.zeros(half, np.int32)])
            self.rows.append(low)

    def after(self, p: np.ndarray, bound: np.ndarray) -> np.ndarray:
        at = p + 1
        for r in range(len(self.rows) - 1, -1, -1):
            at = at + ((self.rows[r][at] >= bound).astype(np.int64) << r)
        return at

    def before(self, p: np.ndarray, bound: np.ndarray) -> np.ndarray:
        at = p - 1
        for r in range(len(self.rows) - 1, -1, -1):
            first = at - (1 << r) + 1
            fits = (first >= 0) & (self.rows[r][np.maximum(first, 0)] >= bound)
            at = at - (fits.astype(np.int64) << r)
        return at


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``first[k] ... first[k] + size[k] - 1``."""
    skip = np.repeat(first - np.r_[0, np.cumsum(size)[:-1]], size)
    return skip + np.arange(len(skip))


def _branching_squares(sa, lcp, starts, ends, least):
    """``(i, d)`` of every square of period ``d`` at ``i`` that ends where its
    repetition ends, in LCP intervals of at least ``least`` suffixes."""
    n = len(sa)
    minima = _Minima(lcp)
    p = np.flatnonzero(lcp > 0)
    right = minima.after(p, lcp[p])
    wide = right - p >= 1
    p, right = p[wide], right[wide]
    left = minima.before(p, lcp[p])
    wide = right - left >= least
    p, left, right = p[wide], left[wide], right[wide]
    if not p.size:
        return p, p
    depth = lcp[p].astype(np.int64)

    # children: one from each boundary on, and the one before an interval's first
    ending = minima.after(p, depth + 1)
    head = np.r_[True, False][(minima.before(p, depth + 1) != left).astype(int)]
    child_first = np.r_[p, left[head]]
    child_end = np.r_[ending, p[head]]
    lo, hi, d = np.r_[left, left[head]], np.r_[right, right[head]], np.r_[depth, depth[head]]
    order = np.lexsort((child_first - child_end, hi, lo))  # the largest child of each interval first
    largest = np.r_[True, (np.diff(lo[order]) != 0) | (np.diff(hi[order]) != 0)]
    small = order[~largest]
    child_first, child_end, lo, hi, d = (x[small] for x in (child_first, child_end, lo, hi, d))

    size = child_end - child_first
    i = sa[_ranges(child_first, size)].astype(np.int64)
    child_first, child_end, lo, hi, d = (np.repeat(x, size) for x in (child_first, child_end, lo, hi, d))
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)

    def member(other: np.ndarray) -> np.ndarray:
        inside = (other >= starts[i]) & (other < ends[i])
        place = isa[np.where(inside, other, 0)]
        same = (place >= child_first) & (place < child_end)
        return inside & (place >= lo) & (place < hi) & ~same

    ahead, behind = member(i + d), member(i - d)
    return np.r_[i[ahead], i[behind] - d[behind]], np.r_[d[ahead], d[behind]]


def maximal_runs(codes: np.ndarray, offsets: np.ndarray, min_length: int = 6, min_exponent: int = 4):
    """``(document, start, length, period)`` arrays of all runs, in the order of
    document, start and period.

    ``codes`` are the words of all documents as numbers, document ``k`` being
    ``codes[offsets[k]:offsets[k + 1]]``; starts count from the document's.
    """
    none = np.zeros(0, np.int64)
    n = len(codes)
    if not n:
        return none, none, none, none
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    starts, ends = offsets[:-1][doc], offsets[1:][doc]
    sa, lcp, ranks = suffix_order(doc * (int(codes.max()) + 1) + codes, ends)
    at, period = _branching_squares(sa, lcp, starts, ends, max(2, min_exponent))
    end, first = at + 2 * period, starts[at]
    for r in range(len(ranks) - 1, -1, -1):  # rotate to the left
        before = at - (1 << r)
        fits = before >= first
        before = np.where(fits, before, 0)
        fits &= ranks[r][before] == ranks[r][np.minimum(before + period, n - 1)]
        at = at - (fits.astype(np.int64) << r)
    keep = end - at >= np.maximum(min_length, min_exponent * period)
    at, end, period = at[keep], end[keep], period[keep]
    order = np.lexsort((period, end, at))
    at, end, period = at[order], end[order], period[order]
    merged = np.r_[True, (np.diff(at) != 0) | (np.diff(end) != 0)][: len(at)]
    at, end, period = at[merged], end[merged], period[merged]
    order = np.lexsort((period, at))
    at, end, period = at[order], end[order], period[order]
    return doc[at], at - starts[at], end - at, period


def _collapsed(texts: list[bytes | None], min_length: int, min_exponent: int):
    """Per text: words, runs, and the text without the repetitions of runs."""
    words = [(t or b"").split() for t in texts]
    offsets = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int64)
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), np.int64, offsets[-1])
    doc, start, length, period = maximal_runs(codes, offsets, min_length, min_exponent)
    gone = np.zeros(len(codes) + 1, np.int64)
    np.add.at(gone, offsets[doc] + start + period, 1)
    np.add.at(gone, offsets[doc] + start + length, -1)
    stays = np.cumsum(gone) == 0
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    for k, ws in enumerate(words):
        own = slice(bounds[k], bounds[k + 1])
        runs = [
            {"start": s, "length": n, "period": q}
            for s, n, q in zip(start[own].tolist(), length[own].tolist(), period[own].tolist())
        ]
        if runs:
            kept = [w for w, stay in zip(ws, stays[offsets[k] : offsets[k + 1]].tolist()) if stay]
        else:
            kept = ws
        yield len(ws), runs, b" ".join(kept)


def _chunks(texts: list[bytes | None]):
    """Stretches of the list of about ``CHUNK_WORDS`` words (5 bytes each)."""
    first = held = 0
    for k, text in enumerate(texts):
        size = len(text or b"")
        if held and held + size > 5 * CHUNK_WORDS:
            yield first, k
            first, held = k, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    Words are stretches without ASCII white space, numbered from 0; ``runs``
    are in the order of start and period; ``collapsed`` holds the words that no
    run contains after its first period, joined by one space.
    """
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run repeats its period at least once")
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            for a, b in _chunks(texts):
                n_words, runs, kept = zip(*_collapsed(texts[a:b], min_length, min_exponent))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array(n_words, pa.int64()),
                        pa.array(runs, pa.list_(run_type)),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), find, SCHEMA)
