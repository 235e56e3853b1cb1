"""Near-duplicate documents by a parity-sketch join on word shingles (operator 9).

A document's set of shingle hashes becomes a parity sketch: the hash space is
cut into ``K`` cells and each cell holds the XOR of its shingles' 64-bit
codes. A shingle that only one of two sets has changes one cell, so the
number of cells that differ (the Hamming distance of the sketches, cell by
cell) is at most the symmetric difference. For Jaccard ``t`` that difference
is at most ``D = (1 - t) / (1 + t) * (a + b)``, hence two linked documents
agree in at least ``K - D`` of ``K > D`` cells (pigeonhole). ``K`` is fixed
per size band; a document joins in its own band and, if a larger partner can
lie there, in the next one.

1. Equal sets are one class (a node) from the start.
2. Cells shared by up to ``group`` nodes give all their pairs. A larger cell
   gives a star and a chain only, of pairs that are linear in its size. Map
   tasks do the same with what they hold of a cell before anything is
   shuffled, so a cell of very many near copies is no task's burden.
3. Candidates whose bit sketches differ in at most ``D`` bits (a bit differs
   only where an element does) are verified on the whole texts: exact
   intersection and union.
4. Cells that are empty or large are *unreliable*. A node whose unreliable
   cells are fewer than the cells it must share with any partner has been
   compared with all its partners in step 2. The other nodes are compared
   again where one of their unreliable cells still holds nodes of different
   components: first with one node of the cell's main component, which joins
   most of what belongs together. Of what is left, linked nodes share one of
   their ``n - ceil(t * n) + 1`` rarest shingles (in any fixed order of all
   shingles), so only nodes of different components that do are paired, if
   enough of both sets lies behind the shared shingle and their folded bit
   sketches differ in at most ``D`` bits. So no link between
   different texts is lost, groups of near copies, which one star connects,
   are never expanded into pairs, and texts that share a passage but have
   enough words of their own never meet.

Defined results: words are the stretches without ASCII white space, A-Z
lower-cased; a text of fewer words than a shingle is one shingle; null and
empty texts have no shingle, link with nothing and are their own component;
rows that share a ``doc_id`` are one document and so in one component; a null
``doc_id`` links like any other and takes the smallest id of its component
(null if there is none); an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from math import floor, log

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import arrow_map, broadcast_if_small, checkpointed, gathered, row_key
from dialogprep.llm.components import connected_components, merged_components

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_CODES = _mix(np.arange(1, 257, dtype=np.uint64) * _A)  # one 64-bit code per byte value
_BLOCK = 1 << 18


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    base = int(_B) | 1
    steps = np.full(_BLOCK, base, np.uint64), np.full(_BLOCK, pow(base, -1, 2**64), np.uint64)
    for x in steps:
        x[0] = 1
    return np.multiply.accumulate(steps[0]), np.multiply.accumulate(steps[1])


def _block_words(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words of up to ``_BLOCK`` bytes, all at once: the
    polynomial of a word is a difference of running sums over the bytes."""
    b = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate(([True], _SPACE[b], [True])).astype(np.int8))
    start, end = np.nonzero(edge == -1)[0], np.nonzero(edge == 1)[0]
    up, down = _powers()
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_CODES[b] * up[: len(b)])))
    size = end - start
    h = _mix((sums[end] - sums[start]) * down[start] + size.astype(np.uint64) * _A)
    for k in np.nonzero(size > 64)[0]:  # a polynomial is no good hash of very long words
        h[k] = xxhash.xxh3_64_intdigest(raw[start[k] : end[k]])
    return h


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a whole text, A-Z lower-cased, in order."""
    raw = (text or "").encode().lower()  # bytes.lower() changes A-Z only
    if len(raw) <= _BLOCK:
        return _block_words(raw) if raw else np.empty(0, np.uint64)
    parts, begin = [], 0
    while begin < len(raw):
        end = begin + _BLOCK
        if end < len(raw):
            cut = max(raw.rfind(c, begin, end) for c in (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r"))
            if cut <= begin:  # one word longer than a block: hashed by itself
                word = raw[begin:].split(None, 1)[0]
                if raw[begin] in b" \t\n\x0b\x0c\r":
                    begin += 1
                    continue
                parts.append(np.array([xxhash.xxh3_64_intdigest(word)], np.uint64))
                begin += len(word)
                continue
            end = cut
        parts.append(_block_words(raw[begin:end]))
        begin = end
    return np.concatenate(parts)


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(k, len(w))
    n = len(w) - k + 1
    h = np.full(n, k, np.uint64)
    for j in range(k):
        h = _mix(h * _A + w[j : j + n])
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def set_key(u: np.ndarray) -> int:
    """Node id of a set: signed 64 bits of a digest."""
    return int.from_bytes(hashlib.blake2b(u.tobytes(), digest_size=8).digest(), "little", signed=True)


class Bands:
    """Size bands, cells per band and how many cells partners must share."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        t = num / den
        self.ratio = t**-2.5 if t > 0.85 else t**-2.2

    def distance(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (self.den - self.num) * (a + b) // (self.den + self.num)

    def low(self, g: int) -> int:
        """Smallest size of band ``g``."""
        return int(self.ratio**g) + (self.ratio**g > int(self.ratio**g))

    def cells(self, g: int) -> int:
        top = self.low(g + 1) - 1
        d = self.distance(top, top)
        return 0 if d == 0 else d + 1 + max(2, d // 8)

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """``(band, cells, slack)`` a set of ``n`` shingles joins in.

        A node with at most ``slack`` unreliable cells shares a reliable one
        with each partner.
        """
        g = max(0, floor(log(n) / log(self.ratio)) - 1)
        while self.low(g + 1) <= n:
            g += 1
        out = []
        for band in (g, g + 1):
            if band > g and self.num * self.low(band) > self.den * n:
                break
            top = min(self.low(band + 1) - 1, n * self.den // self.num)
            if k := self.cells(band):
                out.append((band, k, k - self.distance(n, top) - 1))
        return out


def cell_keys(u: np.ndarray, band: int, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """Join keys of the non-empty cells, and the numbers of the empty ones."""
    at = ((u >> np.uint64(32)) * np.uint64(cells)) >> np.uint64(32)  # u is sorted, so is at
    heads = np.nonzero(np.concatenate(([True], at[1:] != at[:-1])))[0]
    parity = np.bitwise_xor.reduceat(_mix(u ^ _A), heads)
    own = at[heads]
    keys = _mix(parity + _mix((own + np.uint64(1)) * _A + np.uint64(band)))
    empty = np.ones(cells, bool)
    empty[own.astype(np.int64)] = False
    return keys, np.nonzero(empty)[0].astype(np.uint64)


def _empty_keys(numbers: np.ndarray, band: int) -> np.ndarray:
    return _mix(_mix((numbers + np.uint64(1)) * _A + np.uint64(band)) ^ _C)


def sketch(u: np.ndarray, width: int = 0) -> bytes:
    """Parity bits of the set: one bit flips per differing element. There are
    as many bits as elements, rounded up to a power of two, at least 256."""
    width = width or max(256, 1 << (len(u) - 1).bit_length())
    counts = np.bincount((_mix(u) & np.uint64(width - 1)).astype(np.int64), minlength=width)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(u: np.ndarray) -> list[int]:
    """The sketch of 256 bits in four 64-bit integers."""
    return np.frombuffer(sketch(u, 256), np.int64).tolist()


def apart(x: bytes, y: bytes) -> int:
    """In how many bits two sketches differ, the wider one folded to the
    width of the other; never more than the sets' symmetric difference."""
    if len(x) < len(y):
        x, y = y, x
    a, width = np.frombuffer(x, np.uint8).reshape(-1, len(y)), len(y)
    a = np.bitwise_xor.reduce(a, axis=0).tobytes() if len(x) > width else x
    return (int.from_bytes(a) ^ int.from_bytes(y)).bit_count()


def _pairs(key, node, size, num, den, group):
    """Of entries sorted by (key, size, node), without repeats: candidate
    pairs, mask of entries of groups that are too large, heads of groups."""
    heads = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0]
    count = np.diff(np.append(heads, len(key)))
    left, right = [], []
    for s in range(2, group + 1):
        first = heads[count == s]
        for i in range(s - 1 if len(first) else 0):
            for j in range(i + 1, s):
                left.append(first + i)
                right.append(first + j)
    large = np.repeat(count > group, count)
    rows = np.nonzero(large)[0]
    start = np.repeat(heads, count)[rows]
    far = rows[rows > start]
    left += [start[rows > start], far - 1]
    right += [far, far]
    left, right = np.concatenate(left), np.concatenate(right)
    ok = den * np.minimum(size[left], size[right]) >= num * np.maximum(size[left], size[right])
    left, right = node[left[ok]], node[right[ok]]
    pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], 1), axis=0)
    return pairs[pairs[:, 0] != pairs[:, 1]], large, heads


def _tidy(key, node, size, flag):
    """Sorted by (key, size, node); repeats of a node in a key once."""
    order = np.lexsort((flag == 0, node, size, key))
    key, node, size, flag = key[order], node[order], size[order], flag[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    return key[new], node[new], size[new], flag[new]


# Entries of cells in packed form: sorted keys, each with the place of its
# node in the blob's own list of nodes and their sizes.
_CELLS = "bucket long, pairs binary, keys binary, places binary, flags binary, nodes binary, sizes binary"
_PACKED = (("keys", np.uint64), ("places", np.uint32), ("flags", np.int8), ("nodes", np.int64), ("sizes", np.int32))


def _cell_blobs(docs: DataFrame, k: int, bands: Bands, n_buckets: int, group: int) -> DataFrame:
    """Cells of all documents as packed arrays per bucket of keys."""

    def emit(key, node, size):
        key, node, size = map(np.concatenate, (key, node, size))
        key, node, size, flag = _tidy(key, node, size, np.zeros(len(key), np.int8))
        pairs, large, heads = _pairs(key, node, size, bands.num, bands.den, group)
        # of cells that are large already here, only the head goes on
        keep = ~large
        keep[heads] = True
        flag = large.astype(np.int8)
        key, node, size, flag = key[keep], node[keep], size[keep], flag[keep]
        bucket = (key % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.nonzero(np.diff(bucket[order], append=-1))[0] + 1
        rows, begin = [], 0
        for end in ends.tolist():
            i = order[begin:end]
            own, first, place = np.unique(node[i], return_index=True, return_inverse=True)
            packed = (key[i], place.astype(np.uint32), np.packbits(flag[i]), own, size[i][first].astype(np.int32))
            rows.append((int(bucket[i[0]]), b"", *(x.tobytes() for x in packed)))
            begin = end
        if len(pairs):
            rows.append((int(pairs[0, 0] % n_buckets), pairs.tobytes(), *[b""] * len(_PACKED)))
        names = ("pairs", *(c for c, _ in _PACKED))
        return pa.RecordBatch.from_pydict(
            dict(zip(("bucket", *names), map(list, zip(*rows)))),
            schema=pa.schema([("bucket", pa.int64())] + [(c, pa.binary()) for c in names]),
        )

    def cells(batches):
        key, node, size, held = [], [], [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                u = shingles(text, k)
                for band, count, _ in bands.of(len(u)) if len(u) else ():
                    keys, _ = cell_keys(u, band, count)
                    key.append(keys)
                    node.append(np.full(len(keys), set_key(u), np.int64))
                    size.append(np.full(len(keys), len(u), np.int64))
                    held += len(keys)
            if held > 250_000:
                yield emit(key, node, size)
                key, node, size, held = [], [], [], 0
        if held:
            yield emit(key, node, size)

    return arrow_map(docs.select(F.col("text").cast("string")), cells, _CELLS)


def _candidates(blobs: DataFrame, bands: Bands, group: int) -> DataFrame:
    """``(kind, a, b)``: kind 0 a pair of nodes, kind 1 a large cell's key."""

    def unpacked(row):
        key, place, flag, node, size = (np.frombuffer(row[c], kind) for c, kind in _PACKED)
        flag = np.unpackbits(flag.view(np.uint8), count=len(key)).astype(np.int8)
        return key, node[place], size[place].astype(np.int64), flag

    def meet(held, known):
        empty = (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int8))
        key, node, size, flag = _tidy(*map(np.concatenate, zip(empty, *held)))
        pairs, large, heads = _pairs(key, node, size, bands.num, bands.den, group)
        pairs = np.unique(np.concatenate([pairs, *known]), axis=0)
        marked = np.unique(key[large | (flag > 0)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([0, 1], [len(pairs), len(marked)]), pa.int32()),
                pa.array(np.concatenate([pairs[:, 0], marked])),
                pa.array(np.concatenate([pairs[:, 1], np.zeros(len(marked), np.int64)])),
            ],
            names=["kind", "a", "b"],
        )

    def run(batches):
        at, held, known = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != at and at is not None:
                    yield from meet(held, known)
                    held, known = [], []
                at = row["bucket"]
                if row["keys"]:
                    held.append(unpacked(row))
                if row["pairs"]:
                    known.append(np.frombuffer(row["pairs"], np.int64).reshape(-1, 2))
        if at is not None:
            yield from meet(held, known)

    dealt = blobs.repartition("bucket").sortWithinPartitions("bucket")
    return arrow_map(dealt, run, "kind int, a long, b long")


def _pressed(texts: DataFrame) -> DataFrame:
    """``node, text`` with the text compressed: it moves once per chunk."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            blobs = [press.compress((t or "").encode()) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], names=["node", "text"])

    return arrow_map(texts, run, "node long, text binary")


def _verify(pairs: DataFrame, texts: DataFrame, k: int, bands: Bands, chunk: int = 32) -> DataFrame:
    """The pairs ``(a, b)`` whose texts' Jaccard reaches the threshold.

    ``texts`` is ``(node, text)``. A node's partners come in chunks, each with
    the node's own text once.
    """
    n_pairs = pairs.count()
    count = gathered(pairs.groupBy("a").agg(F.ceil(F.count("*") / chunk).alias("n")), n_pairs)
    dealt = gathered(pairs.join(count, "a"), n_pairs).withColumn("part", F.pmod(F.xxhash64("b"), F.col("n")))
    first = gathered(dealt.select("a", "part", F.lit(0).alias("role"), F.col("a").alias("node")).distinct(), n_pairs)
    rest = dealt.select("a", "part", F.lit(1).alias("role"), F.col("b").alias("node"))
    rows = first.union(rest).join(_pressed(texts), "node")
    dealt = rows.repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches):
        unpress = zstandard.ZstdDecompressor()
        at, own = None, []
        for batch in batches:
            left, right = [], []
            for a, part, role, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                u = shingles(unpress.decompress(text).decode(), k)
                if set_key(u) != node:
                    continue  # another row of the same doc_id
                if (a, part) != at:
                    at, own = (a, part), None
                if role == 0:
                    own = u
                elif own is not None:
                    both = len(np.intersect1d(own, u, assume_unique=True))
                    if bands.den * both >= bands.num * (len(own) + len(u) - both):
                        left.append(a)
                        right.append(node)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return arrow_map(dealt.select("a", "part", "role", "node", "text"), run, "a long, b long")


def _among(x: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Which of ``x`` are in the sorted array, by binary search."""
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def _unreliable(docs: DataFrame, k: int, bands: Bands, large: DataFrame, max_broadcast: int) -> DataFrame:
    """``(key, node)``: empty and large cells of the nodes that have too many
    of them to rely on the others."""
    known = None
    if large.count() <= max_broadcast:
        known = docs.sparkSession.sparkContext.broadcast(np.sort(large.select("a").toArrow().column("a").to_numpy()))

    def run(batches):
        for batch in batches:
            rows, of = [np.empty(0, np.int64)], []  # keys of a node and band; what they share
            for text in batch.column(0).to_pylist():
                u = shingles(text, k)
                for band, count, slack in bands.of(len(u)) if len(u) else ():
                    keys, empty = cell_keys(u, band, count)
                    keys = keys.view(np.int64)
                    if known is not None:
                        keys = keys[_among(keys, known.value)]
                        if len(keys) + len(empty) <= slack:
                            continue
                    for is_empty, some in ((False, keys), (True, _empty_keys(empty, band).view(np.int64))):
                        rows.append(some)
                        of.append((set_key(u), band, slack - len(empty), is_empty, len(some)))
            node, band, room, is_empty, n = list(zip(*of)) or [[]] * 5
            each = pa.array(np.repeat(np.arange(len(of)), np.array(n, np.int64)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            shared = [pa.array(c, t).take(each) for c, t in zip((node, band, room, is_empty), kinds)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(rows)), *shared], names=["key", "node", "band", "room", "is_empty"])

    schema = "key long, node long, band long, room long, is_empty boolean"
    cells = arrow_map(docs.select(F.col("text").cast("string")), run, schema)
    if known is None:
        mine = cells.join(large.select(F.col("a").alias("key"), F.lit(True).alias("is_large")), "key", "left")
        mine = mine.where("is_empty or is_large")
        many = mine.groupBy("node", "band").agg(
            F.countDistinct(F.when(~F.col("is_empty"), F.col("key"))).alias("n"), F.min("room").alias("r")
        ).where("n > r")
        cells = mine.join(many.select("node", "band"), ["node", "band"], "left_semi")
    # copies of a text have the same cells
    return cells.select("key", "node").distinct()


def _may_link(pairs: DataFrame, nodes: DataFrame, bands: Bands, n_pairs: int, node_bytes: int) -> DataFrame:
    """The pairs ``(a, b)`` to which the sizes and bit sketches of ``nodes``
    (``node, size, bits``, of ``node_bytes`` a row) leave a link possible.
    There are at most ``n_pairs`` pairs."""
    ends = [nodes.select(*[F.col(c).alias(n) for c, n in (("node", e), ("size", f"{e}_size"), ("bits", f"{e}_bits"))]) for e in ("a", "b")]
    met = gathered(pairs.join(ends[0], "a"), n_pairs, node_bytes).join(ends[1], "b")
    near = F.lit(bands.den) * F.least("a_size", "b_size") >= F.lit(bands.num) * F.greatest("a_size", "b_size")

    def run(batches):
        for batch in batches:
            a, b, *of = (c.to_pylist() for c in batch.columns)
            may = [apart(x, y) <= bands.distance(m, n) for m, n, x, y in zip(*of)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(may, pa.bool_()))

    met = gathered(met.where(near).select("a", "b", "a_size", "b_size", "a_bits", "b_bits"), n_pairs, 2 * node_bytes)
    return arrow_map(met, run, "a long, b long")


def _slots(u: np.ndarray, bits: int) -> np.ndarray:
    return (_mix(u ^ _C) >> np.uint64(64 - bits)).astype(np.int64)


def _slot_loads(texts: DataFrame, k: int, bits: int) -> np.ndarray:
    """How many shingles of the texts fall in each of ``2 ** bits`` slots, up
    to 65535. At most that many rows reach the driver."""

    def run(batches):
        def counted():
            slot, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n, pa.int64())], names=["slot", "n"])

        held, size = [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(_slots(shingles(text, k), bits))
                size += len(held[-1])
                if size > 1_000_000:
                    yield counted()
                    held, size = [], 0
        if size:
            yield counted()

    found = arrow_map(texts.select("text"), run, "slot long, n long").groupBy("slot").agg(F.least(F.sum("n"), F.lit(65535)).alias("n"))
    found = found.where("n > 1").toArrow()
    loads = np.ones(1 << bits, np.uint16)
    loads[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return loads


def rarest(u: np.ndarray, loads: np.ndarray, bands: Bands) -> np.ndarray:
    """The shingles of a set of which linked sets share one: the first
    ``n - ceil(t * n) + 1`` in the order by load of the slot, then by hash.

    Of sets ``x`` and ``y`` of which all that is common lies at place ``i`` of
    ``x`` or behind, at most ``len(x) - i`` elements are common.
    """
    n = len(u)
    order = np.lexsort((u, loads[_slots(u, len(loads).bit_length() - 1)]))
    return u[order[: n - -(-bands.num * n // bands.den) + 1]]


_ENTRY = "key long, component long, node long, weight long, place int, size int, bits array<long>"


def _rare_entries(nodes: DataFrame, k: int, bands: Bands, loads) -> DataFrame:
    """Entries of the rarest shingles of ``(node, component, weight, text)``:
    their place in the set's order, its size and sketch of 256 bits."""

    def run(batches):
        table = loads.value
        for batch in batches:
            sets = [shingles(text, k) for text in batch.column(3).to_pylist()]
            found = [rarest(u, table, bands).view(np.int64) for u in sets]
            each = pa.array(np.repeat(np.arange(len(found)), [len(u) for u in found]))
            keys = pa.array(np.concatenate([np.empty(0, np.int64), *found]))
            place = pa.array(np.concatenate([np.empty(0, np.int32), *(np.arange(len(u), dtype=np.int32) for u in found)]))
            size = pa.array([len(u) for u in sets], pa.int32()).take(each)
            bits = pa.array([folded(u) for u in sets], pa.list_(pa.int64())).take(each)
            of = [batch.column(i).take(each) for i in (1, 0, 2)]
            yield pa.RecordBatch.from_arrays([keys, *of, place, size, bits], names=["key", "component", "node", "weight", "place", "size", "bits"])

    return arrow_map(nodes.select("node", "component", "weight", "text"), run, _ENTRY)


def _pairs_by_rare(nodes: DataFrame, total: int, k: int, bands: Bands, max_broadcast: int) -> DataFrame:
    """Pairs ``(a, b)`` of nodes of different components that share one of
    their rarest shingles, of ``(node, component, weight, text)`` with
    ``total`` shingles, where neither the shingle's places in both sets nor
    their sketches rule a link out. ``weight`` is the size of a component."""
    sc = nodes.sparkSession.sparkContext
    # a slot for some two shingles; the table has at most 8 MB
    loads = sc.broadcast(_slot_loads(nodes, k, min(22, max(10, (total // 2).bit_length()))))
    entries = _rare_entries(nodes, k, bands, loads)
    # most shingles are in one component only: counted before rows move
    named = entries.groupBy("key").agg(F.max(F.struct("weight", "component")).alias("main"), F.min(F.struct("weight", "component")).alias("other"))
    mixed = checkpointed(named.where("main <> other").select("key", F.col("main.component").alias("main")))
    n_mixed = mixed.count()
    entries = entries.join(broadcast_if_small(gathered(mixed, n_mixed), max_broadcast, n_mixed), "key")
    # a row and its repeats are one node
    entries = checkpointed(entries.drop("weight").dropDuplicates(["key", "node"]))
    entries = gathered(entries, entries.count(), 120)
    loads.unpersist()
    x, y = (
        entries.select("key", F.col("component").alias(c), "main", *[F.col(n).alias(f"{e}_{n}") for n in ("node", "place", "size", "bits")])
        for c, e in (("c", "x"), ("d", "y"))
    )
    both = F.col("x_size") + F.col("y_size")
    parted = sum((F.bit_count(F.col("x_bits")[i].bitwiseXOR(F.col("y_bits")[i])) for i in range(4)), F.lit(0))
    # the common elements that a link takes are behind the first common one
    room = F.floor(F.lit(bands.den - bands.num) * both / F.lit(bands.den + bands.num))
    least = F.ceil(F.lit(bands.num) * both / F.lit(bands.num + bands.den))
    behind = F.least(F.col("x_size") - F.col("x_place"), F.col("y_size") - F.col("y_place"))
    met = x.where("c <> main").join(y.drop("main"), "key").where(
        (F.col("c") != F.col("d")) & ((F.col("d") == F.col("main")) | (F.col("x_node") < F.col("y_node"))) & (behind >= least) & (parted <= room)
    )
    return met.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame,
    k: int = 5,
    num: int = 80,
    den: int = 100,
    group: int = 6,
    bucket_keys: int = 1_000_000,
    max_broadcast: int = 1_000_000,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id, row_key`` for every row.

    Two documents link when ``den * |A & B| >= num * |A | B|``. ``class_id``
    names the component whatever ids its rows have (null without shingles);
    ``row_key`` is :func:`~dialogprep.llm.common.row_key` of id and text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keyed = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("row_key"))
    bands = Bands(num, den)

    def sets(batches):
        for batch in batches:
            found = [shingles(t, k) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(u) for u in found], pa.int64()),
                    pa.array([set_key(u) if len(u) else None for u in found], pa.int64()),
                    batch.column(2),
                    pa.array([sketch(u) if len(u) else None for u in found], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "node", "row_key", "bits"],
            )

    schema = "doc_id long, n_shingles long, node long, row_key struct<a:long,b:long>, bits binary"
    rows = checkpointed(arrow_map(keyed, sets, schema))
    # entries per shingle of the sketches, about, for the number of buckets
    share = 1.9 * 2 * (den - num) / (den + num)
    total, n_rows = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)), F.count("*")).first()
    width = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_buckets = max(4 * width, int(total * share) // bucket_keys)

    found = checkpointed(_candidates(_cell_blobs(docs, k, bands, n_buckets, group), bands, group))
    n_found = found.count()
    found = gathered(found, n_found)
    large = found.where("kind = 1").select("a")

    # a row and its sketch, of at most a bit for half a shingle; nodes are read again and again
    node_bytes = 96 + total // (4 * max(1, n_rows))
    one = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("row_key").alias("row_key"))
    one = checkpointed(gathered(one, n_rows, 64))

    sketches = rows.where("node is not null").groupBy("node").agg(F.first("n_shingles").alias("size"), F.first("bits").alias("bits"))
    sketches = checkpointed(gathered(sketches, n_rows, node_bytes))
    met = gathered(found.where("kind = 0").select("a", "b").distinct(), n_found)
    pairs = checkpointed(_may_link(met, sketches, bands, n_found, node_bytes))

    def texts_of(wanted: DataFrame) -> DataFrame:
        """``(node, text)`` of one row of each wanted node (and its repeats)."""
        some = checkpointed(gathered(one.join(wanted.distinct(), "node").select("node", "row_key"), n_rows, 64))
        return keyed.join(broadcast_if_small(some, max_broadcast), "row_key").select("node", "text")

    def both_ends(p: DataFrame) -> DataFrame:
        return p.select(F.col("a").alias("node")).union(p.select(F.col("b").alias("node")))

    # rows of one id are one document, whatever their texts
    ids = rows.where("doc_id is not null and node is not null")
    several = ids.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    same_id = ids.join(several, "doc_id").where("node <> a").select("a", F.col("node").alias("b"))

    links = checkpointed(_verify(pairs, texts_of(both_ends(pairs)), k, bands).union(same_id))
    parts = checkpointed(connected_components(gathered(links, n_found + n_rows), "a", "b"))

    loose = checkpointed(_unreliable(docs, k, bands, large, max_broadcast))
    n_loose = loose.count()
    loose = gathered(loose, n_loose)

    def still_mixed(parts: DataFrame) -> DataFrame:
        """Entries of the cells that hold nodes of several components."""
        named = parts.withColumnRenamed("id", "node")
        placed = loose.join(named, "node", "left").withColumn("component", F.coalesce("component", "node"))
        placed = checkpointed(gathered(placed, n_loose))
        mixed = placed.groupBy("key").agg(F.min("component").alias("main"), F.max("component").alias("other"))
        return checkpointed(gathered(placed.join(mixed.where("main <> other").select("key", "main"), "key"), n_loose))

    # a first round that is linear in the cells: every node outside a cell's
    # main component meets one node of it, another one in each cell
    placed = still_mixed(parts)
    one_of = placed.where("component = main").groupBy("key").agg(F.max_by("node", F.xxhash64("key", "node")).alias("rep"))
    first = placed.where("component <> main").join(gathered(one_of, n_loose), "key")
    first = gathered(first.select(F.least("node", "rep").alias("a"), F.greatest("node", "rep").alias("b")), n_loose).distinct()
    first = gathered(first.join(pairs, ["a", "b"], "left_anti"), n_loose)
    first = checkpointed(_may_link(first, sketches, bands, n_loose, node_bytes))
    if first.limit(1).count():
        found = checkpointed(_verify(first, texts_of(both_ends(first)), k, bands))
        found = gathered(found, n_loose)
        pairs = checkpointed(pairs.union(first))
        if found.limit(1).count():
            parts = checkpointed(merged_components(parts, found, "a", "b"))
            placed = still_mixed(parts)
    rest = checkpointed(gathered(placed.select("node", "component").distinct(), n_loose))
    if n_rest := rest.count():
        texts = texts_of(rest.select("node"))
        weighed = gathered(rest.join(rest.groupBy("component").agg(F.count("*").alias("weight")), "component"), n_rest)
        nodes = texts.join(broadcast_if_small(weighed, max_broadcast, n_rest), "node")
        more = checkpointed(_pairs_by_rare(nodes, total, k, bands, max_broadcast).join(pairs, ["a", "b"], "left_anti"))
        n_more = more.count()
        more = checkpointed(_may_link(gathered(more, n_more), sketches, bands, n_more, node_bytes))
        if more.limit(1).count():
            late = checkpointed(_verify(more, texts, k, bands))
            parts = checkpointed(merged_components(parts, late, "a", "b"))

    # from nodes to documents: the smallest doc_id of each component
    merged = one.join(parts.withColumnRenamed("id", "node"), "node", "left").select(
        "node", "doc_id", F.coalesce("component", "node").alias("class_id")
    )
    merged = checkpointed(gathered(merged, n_rows))
    named = gathered(merged.groupBy("class_id").agg(F.min("doc_id").alias("component_id")), n_rows)
    nodes = gathered(merged.select("node", "class_id").join(named, "class_id").select("node", "class_id", "component_id"), n_rows)
    return rows.join(nodes, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("class_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "class_id", "row_key",
    )
