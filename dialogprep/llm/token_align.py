"""Alignment of two tokenizers over the same texts (operator 13).

Tokenizer A (byte-level BPE) and B (pieces with byte fallback) cut the same
bytes, a space and the text. Offsets where tokens of both end cut them into
groups; inside a group every A and B token whose byte ranges overlap are linked.
The count of an id pair is the number of documents that hold it linked.

1. Map side, per stretch of documents: texts are cut before spaces that follow
   something else (no token of either side crosses such a place), distinct
   segments are encoded and aligned once, and documents are put together from
   them.
2. A precomputed array gives the B id of the same bytes for each A id. Links of
   that kind, which exact one-to-one groups consist of, are counted in one
   vector of vocabulary length per task. Only the other links are counted as
   pairs, distinct per chunk of documents before anything is shuffled.
3. Pair counts are summed by pair. They go to the tasks whole where they are
   few, else back to the chunks that hold the pair by a join; the counts and the
   highest count of each A id go as vectors of vocabulary length. Then each
   document's links are looked up.

Defined results: a null or empty text, or one whose tokens do not join to a
space and the text (U+2581, for instance), has no tokens: zeros and '' for
``groups_sha256``; strings of special tokens are plain text; null ids and
repeated rows are documents of their own; an empty table gives no rows; further
columns of the input are ignored. A long text is handled whole, by one task,
in memory that grows with its own length only.
"""

from __future__ import annotations

import hashlib
import pickle
import re
import zlib
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.bpe import _byte_of, _fast_core
from dialogprep.llm.common import arrow_map, checkpointed

SCHEMA = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)
CHUNK_SCHEMA = "chunk long, keys array<long>, held array<long>, same array<long>, blob binary"
CHUNK_TYPE = pa.schema(
    [("chunk", pa.int64()), *((name, pa.list_(pa.int64())) for name in ("keys", "held", "same")), ("blob", pa.binary())]
)
# Characters that some engine takes for white space and another does not.
_UNCLEAR = "\u180e\u200b\ufeff"
_CUT = re.compile(f"(?<=[^\\s{_UNCLEAR}]) ")
_RUN = re.compile(f"[\\s{_UNCLEAR}] ")
# Bytes of text that are handled at once; segments that a worker keeps, and their bytes.
CHUNK_BYTES = 2 << 20
MAX_KNOWN = 400_000
MAX_HELD = 16 << 20


def _starts(size: np.ndarray) -> np.ndarray:
    return np.r_[0, np.cumsum(size)].astype(np.int64)


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``first[k] ... first[k] + size[k] - 1``."""
    skip = np.repeat(first - _starts(size)[:-1], size)
    return skip + np.arange(len(skip))


class _Numbered(dict):
    """Key -> number, in the order of first sight."""

    def __missing__(self, key: str) -> int:
        number = self[key] = len(self)
        return number


class _Bytes:
    """Bytes of each id of a vocabulary, in one buffer."""

    def __init__(self, of_id: list[bytes]):
        self.buffer = np.frombuffer(b"".join(of_id), np.uint8)
        self.size = np.array([len(x) for x in of_id], np.int64)
        self.first = _starts(self.size)[:-1]

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.buffer[_ranges(self.first[ids], self.size[ids])]


class Store:
    """Aligned segments that a worker has seen, by number."""

    def __init__(self):
        self.number = _Numbered()
        self.done = self.held = 0
        self.good = np.zeros(0, bool)
        self.sizes = np.zeros((0, 3), np.int64)  # A ids, B ids, groups
        self.first_link = np.zeros(1, np.int64)
        self.links = np.zeros((0, 2), np.int32)  # A id, B id
        self.printed: list[bytes] = []

    def extend(self, good, sizes, n_links, links, printed) -> None:
        self.good = np.r_[self.good, good]
        self.sizes = np.r_[self.sizes, sizes]
        self.first_link = np.r_[self.first_link, self.first_link[-1] + np.cumsum(n_links)]
        self.links = np.r_[self.links, links.astype(np.int32)]
        self.printed += printed
        self.done = len(self.number)


class Aligner:
    """Ids of both tokenizers and their alignment, segment by segment."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path_a)
        self.tok.encode_special_tokens = True
        self.core = _fast_core(path_a)
        byte = _byte_of()
        bytes_a = [b""] * (max(self.tok.get_vocab().values()) + 1)
        for token, i in self.tok.get_vocab(with_added_tokens=False).items():
            bytes_a[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else b""
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.vocab_size())]
        plain = [not (self.sp.is_control(i) or self.sp.is_unknown(i)) for i in range(len(pieces))]
        bytes_b = [
            bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("\u2581", " ").encode() if plain[i] else b""
            for i, p in enumerate(pieces)
        ]
        self.space = self.sp.piece_to_id("\u2581")
        # pieces hold U+2581 at their start only, so no piece crosses a cut
        self.cuts = self.core is not None and not any("\u2581" in p.lstrip("\u2581") for p in pieces)
        self.a, self.b = _Bytes(bytes_a), _Bytes(bytes_b)
        of_bytes = {x: i for i, x in reversed(list(enumerate(bytes_b))) if x and not self.sp.is_byte(i)}
        self.same = np.array([of_bytes.get(x, -1) for x in bytes_a], np.int64)
        n = max(len(bytes_a), len(bytes_b))
        if n > 10**7:
            raise ValueError("ids of more than seven digits")
        digits = [str(i).encode() for i in range(n)]
        self.digits = np.array([len(x) for x in digits], np.int64)
        self.text_of = {
            sep: np.frombuffer(b"".join((x + sep).ljust(8, b"\0") for x in digits), np.uint64) for sep in (b",", b"|", b";", b"")
        }

    def segments(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        if text[0] == " " or _RUN.search(text):
            return _CUT.split(text)
        return text.split(" ")

    def _encoded_a(self, new: list[str], n_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each segment, and how many each has."""
        if not self.cuts:
            ids = [self.tok.encode(" " + s, add_special_tokens=False).ids for s in new]
        else:
            # a segment that ends in something else than white space can be followed by the next one
            closed = [bool(s) and not s[-1].isspace() and s[-1] not in _UNCLEAR for s in new]
            if all(closed):
                flat = np.array(self.core.encode_ordinary(" " + " ".join(new)), np.int64)
                ends = np.searchsorted(np.cumsum(self.a.size[flat]), np.cumsum(n_bytes))
                return flat, np.diff(ends + 1, prepend=0)
            ids = [self.core.encode_ordinary(" " + s) for s in new]
        return _flat(ids)

    def _encoded_b(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat([x or [self.space] for x in self.sp.encode(new, num_threads=1)])

    def _agree(self, side: _Bytes, ids, n_ids, own, n_bytes) -> np.ndarray:
        """Whether the ids of each segment join to its bytes."""
        size = np.add.reduceat(side.size[ids], _starts(n_ids)[:-1]) if len(ids) else n_ids
        good = (size == n_bytes) & (n_ids > 0)
        keep = np.repeat(good, n_ids)
        differ = side.joined(ids[keep]) != own[np.repeat(good, n_bytes)]
        wrong = np.bincount(np.repeat(np.flatnonzero(good), n_bytes[good])[differ], minlength=len(good))
        return good & (wrong == 0)

    def extend(self, store: Store) -> None:
        """Align the segments that ``store`` has numbered but not yet aligned."""
        new = list(islice(store.number, store.done, None))
        if not new:
            return
        own = [(" " + s).encode() for s in new]
        n_bytes = np.array([len(x) for x in own], np.int64)
        own = np.frombuffer(b"".join(own), np.uint8)
        store.held += len(own)
        a, n_a = self._encoded_a(new, n_bytes)
        b, n_b = self._encoded_b(new)
        good = self._agree(self.a, a, n_a, own, n_bytes) & self._agree(self.b, b, n_b, own, n_bytes)
        if not good.all():
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        seg_a, seg_b = np.repeat(np.arange(len(new)), n_a), np.repeat(np.arange(len(new)), n_b)
        end_a, end_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])

        at = np.searchsorted(end_b, end_a)
        cut_a = end_b[at] == end_a
        cut_b = np.zeros(len(b), bool)
        cut_b[at[cut_a]] = True
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n_groups = np.bincount(seg_a[cut_a], minlength=len(new))

        # one link per stretch between neighbouring ends of either side
        ends = np.sort(np.concatenate([end_a, end_b[~cut_b]]))
        at_a, at_b = np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)
        links = np.stack([a[at_a], b[at_b]], 1)

        # print all A ids, then all B ids of each group
        of_a = np.bincount(group_a, minlength=cut_a.sum())
        of_b = np.bincount(group_b, minlength=cut_a.sum())
        place_a = np.arange(len(a)) + (np.cumsum(of_b) - of_b)[group_a]
        place_b = np.arange(len(b)) + np.cumsum(of_a)[group_b]
        last_b = np.r_[np.diff(seg_b) != 0, True][: len(b)]
        text = np.empty(len(a) + len(b), np.uint64)
        text[place_a] = np.where(cut_a, self.text_of[b"|"][a], self.text_of[b","][a])
        text[place_b] = np.where(last_b, self.text_of[b""][b], np.where(cut_b, self.text_of[b";"][b], self.text_of[b","][b]))
        raw = text.view(np.uint8)
        printed = raw[raw != 0].tobytes()
        digits = np.bincount(seg_a, self.digits[a] + 1, len(new)) + np.bincount(seg_b, self.digits[b] + 1, len(new)) - (n_b > 0)
        upto = _starts(digits).tolist()
        store.extend(
            good,
            np.stack([n_a, n_b, n_groups], 1),
            n_a + n_b - n_groups,
            links,
            [printed[x:y] for x, y in zip(upto, upto[1:])],
        )


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    n = np.array([len(x) for x in ids], np.int64)
    return np.fromiter(chain.from_iterable(ids), np.int64, n.sum()), n


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One aligner per worker and pair of tokenizers."""
    return Aligner(path_a, path_b)


def _stretches(texts: list[str]):
    """Stretches of the list of about ``CHUNK_BYTES`` characters."""
    first = held = 0
    for k, text in enumerate(texts):
        size = len(text or "")
        if held and held + size > CHUNK_BYTES:
            yield first, k
            first, held = k, 0
        held += size
    if first < len(texts):
        yield first, len(texts)


def _sums(values: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums of consecutive stretches of the given sizes."""
    upto = _starts(values)
    bound = _starts(size)
    return upto[bound[1:]] - upto[bound[:-1]]


def _pack(**arrays) -> bytes:
    return zlib.compress(pickle.dumps(arrays, protocol=5), 1)


def _aligned_chunk(al: Aligner, store: Store, ids: list, texts: list[str], vector: np.ndarray):
    """Align some documents: ``(pair keys, documents that hold each, blob)``.

    ``vector`` takes the documents per A id of same-bytes links. Links are
    numbered: A id for those, else the vocabulary size plus the pair's place.
    """
    found = [al.segments(t) if t else [] for t in texts]
    codes = np.fromiter(map(store.number.__getitem__, chain.from_iterable(found)), np.int64)
    size = np.array([len(x) for x in found], np.int64)
    al.extend(store)

    doc = np.repeat(np.arange(len(texts)), size)
    bad = np.bincount(doc[~store.good[codes]], minlength=len(texts)) > 0
    codes, size = codes[~bad[doc]], np.where(bad, 0, size)
    doc = np.repeat(np.arange(len(texts)), size)
    counts = [_sums(store.sizes[codes, k], size) for k in range(3)]
    printed, bound, own = store.printed, _starts(size).tolist(), codes.tolist()
    sha = [
        hashlib.sha256(b";".join([printed[c] for c in own[x:y]])).hexdigest() if y > x else ""
        for x, y in zip(bound, bound[1:])
    ]

    present = np.zeros(len(store.good), bool)
    present[codes] = True
    used = np.flatnonzero(present)
    codes = (np.cumsum(present) - 1)[codes]
    n_links = store.first_link[used + 1] - store.first_link[used]
    a, b = store.links[_ranges(store.first_link[used], n_links)].T.astype(np.int64)
    link, other = a.copy(), al.same[a] != b
    keys, place = np.unique(a[other] * len(al.b.size) + b[other], return_inverse=True)
    link[other] = len(al.a.size) + place

    # documents per link: each document's distinct segments, then their distinct links
    n, kinds = max(1, len(used)), len(al.a.size) + len(keys)
    each = np.unique(doc * n + codes)
    doc_of, seg = each // n, each % n
    held = np.unique(np.repeat(doc_of, n_links[seg]) * kinds + link[_ranges(_starts(n_links)[seg], n_links[seg])])
    per_link = np.bincount(held % kinds, minlength=kinds)
    vector += per_link[: len(vector)]
    blob = _pack(ids=ids, counts=counts, sha=sha, size=size, codes=codes.astype(np.uint32),
                 n_links=n_links.astype(np.uint32), link=link.astype(np.uint32))
    return keys, per_link[len(vector) :], blob


def _looked_up(blob: bytes, keys: np.ndarray, n: np.ndarray, same: np.ndarray, best: np.ndarray, width: int) -> pa.RecordBatch:
    """Rows of the documents of one chunk; ``n`` counts its pairs ``keys``."""
    c = pickle.loads(zlib.decompress(blob))
    count = np.r_[same, n]
    highest = np.r_[same == best, n == best[keys // width]]
    link = c["link"].astype(np.int64)
    n_links = c["n_links"].astype(np.int64)
    codes = c["codes"].astype(np.int64)
    n_best = _sums(_sums(highest[link].astype(np.int64), n_links)[codes], c["size"])
    count_sum = _sums(_sums(count[link], n_links)[codes], c["size"])
    n_a, n_b, n_groups = c["counts"]
    columns = [pa.array(c["ids"], pa.int64())]
    columns += [pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_a + n_b - n_groups, n_best, count_sum)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(c["sha"], pa.string())], names=[f.split()[0] for f in SCHEMA.split(", ")])


def _vector(rows, size: int) -> np.ndarray:
    """At most one row ``(id, n)`` per id of a vocabulary, as an array."""
    out = np.zeros(size, np.int64)
    for i, n in rows:
        out[i] = n
    return out


def token_alignment(docs: DataFrame, path_a: str, path_b: str, max_broadcast: int = 1_000_000) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` for every row of ``docs``.

    Counts of up to ``max_broadcast`` pairs go to the tasks whole; more are
    joined to the chunks that hold them.
    """
    spark = docs.sparkSession
    al = aligner(path_a, path_b)
    n_a, width = len(al.a.size), len(al.b.size)

    def encode(batches):
        al, store = aligner(path_a, path_b), Store()
        vector = np.zeros(n_a, np.int64)
        chunk = TaskContext.get().partitionId() << 32

        def row(chunk, keys, held, same, blob):
            return pa.RecordBatch.from_pylist(
                [{"chunk": chunk, "keys": keys, "held": held, "same": same, "blob": blob}], schema=CHUNK_TYPE
            )

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for x, y in _stretches(texts):
                if store.done > MAX_KNOWN or store.held > MAX_HELD:
                    store = Store()
                keys, held, blob = _aligned_chunk(al, store, ids[x:y], texts[x:y], vector)
                yield row(chunk, keys, held, None, blob)
                chunk += 1
        if vector.any():
            yield row(None, None, None, vector, None)

    chunks = checkpointed(arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), encode, CHUNK_SCHEMA))
    # one row per id of A, however many documents there are
    totals = chunks.where("same IS NOT NULL").select(F.posexplode("same").alias("a", "n")).where("n > 0")
    same = _vector(totals.groupBy("a").agg(F.sum("n")).collect(), n_a)
    pairs = chunks.select(F.explode(F.arrays_zip("keys", "held")).alias("p")).groupBy("p.keys").agg(F.sum("p.held").alias("n"))
    pairs = checkpointed(pairs.select(F.col("keys").alias("key"), "n"))
    highest = pairs.groupBy(F.expr(f"key div {width}").alias("a")).agg(F.max("n"))
    best = np.maximum(same, _vector(highest.collect(), n_a))
    vectors = spark.sparkContext.broadcast((same, best))

    chunks = chunks.where("chunk IS NOT NULL")
    if pairs.count() <= max_broadcast:
        rows = pairs.orderBy("key").collect()
        known = spark.sparkContext.broadcast(
            (np.array([r.key for r in rows], np.int64), np.array([r.n for r in rows], np.int64))
        )

        def look_up(batches):
            for batch in batches:
                for r in batch.to_pylist():
                    keys = np.array(r["keys"], np.int64)
                    n = known.value[1][np.searchsorted(known.value[0], keys)] if len(keys) else keys
                    yield _looked_up(r["blob"], keys, n, *vectors.value, width)

        return arrow_map(chunks.select("keys", "blob"), look_up, SCHEMA)

    wanted = chunks.select("chunk", F.posexplode("keys").alias("place", "key")).join(pairs, "key")
    counted = wanted.groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("place", "n"))).alias("counted"))

    def look_up_joined(batches):
        for batch in batches:
            for r in batch.to_pylist():
                keys = np.array(r["keys"], np.int64)
                yield _looked_up(r["blob"], keys, np.array(r["n"] or [], np.int64), *vectors.value, width)

    joined = chunks.join(counted, "chunk", "left").select("keys", F.col("counted.n").alias("n"), "blob")
    return arrow_map(joined, look_up_joined, SCHEMA)
