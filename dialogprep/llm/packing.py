"""Mixture-controlled packing into fixed windows (operator 5).

Each source is a queue of tokens. A deficit round-robin deals quanta of the
queues into the windows in proportion to the queues' targets: quantum ``c``
of queue ``s`` is due at virtual time ``(2c + 1) / (2 target_s)``, and quanta
are dealt in the order of their due times. What a queue is owed at the end of
a window stays owed in the next one, whichever task fills it: the rank of a
quantum in that order is a sum over the queues in closed form (counts of
quanta due before it), so any task places its own documents without replaying
the windows before. A queue that runs dry leaves its share to the others.
Windows are filled to the last token; only the last one is padded.

Documents are tokenised once; their ids go to a checkpoint as compressed
bytes. A document's place in its queue comes from sums per (partition, queue)
of that checkpoint and a running sum inside the partition, so no text or id
is shuffled and a queue with a third of all rows is no task's burden.

Defined results: a null or empty text is its closing id alone; rows of null
source share a queue; repeated rows are packed one by one; an empty table
gives no rows. Every source has its own queue at any number of sources; beyond
``max_queues`` the quanta are put in order by a sort in place of the closed form.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.llm.bpe import encoder
from dialogprep.llm.common import arrow_map, broadcast_if_small, checkpointed

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"
)


class Schedule:
    """Where each quantum of each queue lies in the dealt order.

    ``tokens`` per queue and integer ``targets`` (any scale). All quanta have
    ``quantum`` tokens but the last one of a queue.
    """

    def __init__(self, tokens: list[int], targets: list[int], quantum: int):
        self.quantum = quantum
        self.tokens = tokens
        self.quanta = [-(-t // quantum) for t in tokens]
        self.short = [q * quantum - t for q, t in zip(self.quanta, tokens)]
        self.targets = targets
        # int64 holds the products below up to some 10^9 quanta a queue;
        # beyond it numpy keeps Python integers, which have no bound.
        large = max([*self.quanta, 1]) * 2 * max([*targets, 1]) >= 2**62
        self.kind = object if large else np.int64

    def position(self, queue: int, c: np.ndarray) -> np.ndarray:
        """First token's global position of quanta ``c`` of ``queue``."""
        c = c.astype(self.kind)
        due = 2 * c + 1
        at = np.zeros(len(c), dtype=self.kind)
        for r, (n, w) in enumerate(zip(self.quanta, self.targets)):
            if r == queue:
                before = c
            else:
                # quanta c' of r with (2c' + 1) / w < due / w_queue; of equal
                # due times the queue of smaller index goes first
                x = due * w
                v = self.targets[queue]
                before = (x + v) // (2 * v) if r < queue else (x + v - 1) // (2 * v)
                before = np.minimum(before, n)
            at = at + before * self.quantum
            if self.short[r] and r != queue:
                at = at - np.where(before == n, self.short[r], 0)
        return at


def tokenised(docs: DataFrame, tokenizer_path: str, end_id: int, queue) -> DataFrame:
    """``doc_id, source, queue, n, ahead, ids``: ``ids`` as compressed bytes,
    ``ahead`` the ids of the same queue before it in its partition."""

    def encode(batches):
        enc = encoder(tokenizer_path, False)
        end = np.asarray([end_id], dtype=enc.kind).tobytes()
        width = len(end)
        press = zstandard.ZstdCompressor(level=1)
        run: dict = {}
        for batch in batches:
            queues = batch.column(2).to_pylist()
            n, ahead, blobs = [], [], []
            for q, text in zip(queues, batch.column(3).to_pylist()):
                ids = enc(text) + end
                n.append(len(ids) // width)
                ahead.append(run.get(q, 0))
                run[q] = ahead[-1] + n[-1]
                blobs.append(press.compress(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(n, pa.int64()),
                 pa.array(ahead, pa.int64()), pa.array(blobs, pa.binary())],
                names=["doc_id", "source", "queue", "n", "ahead", "ids"],
            )
        enc.clear()

    cols = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        queue.cast("string").alias("queue"),
        F.col("text").cast("string").alias("text"),
    )
    return arrow_map(cols, encode, "doc_id long, source string, queue string, n long, ahead long, ids binary")


def cut_pieces(position, q: int, begin: np.ndarray, n: np.ndarray, window: int):
    """Arrays ``(row, start, position, length)`` of the pieces of documents
    that take ids ``begin .. begin + n`` of their queues (all ``n`` > 0).

    ``position(row, c)`` gives the global positions of quanta ``c`` of the
    documents' queues; a quantum has ``q`` tokens.
    """
    first, last = begin // q, (begin + n - 1) // q
    count = last - first + 1
    row = np.repeat(np.arange(len(n)), count)
    c = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]
    lo = np.maximum(c * q, begin[row])
    size = np.minimum((c + 1) * q, begin[row] + n[row]) - lo
    start, pos = lo - begin[row], position(row, c) + (lo - c * q)
    # cut where a quantum crosses the end of a window
    over = np.maximum((pos % window + size - window).astype(np.int64), 0)
    k = np.nonzero(over)[0]
    head = size - over
    row = np.insert(row, k + 1, row[k])
    start, pos = np.insert(start, k + 1, (start + head)[k]), np.insert(pos, k + 1, (pos + head)[k])
    size = np.insert(head, k + 1, over[k])
    # join neighbours that lie side by side in one window
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (pos[1:] != pos[:-1] + size[:-1]) | (pos[1:] % window == 0)
    heads = np.nonzero(new)[0]
    return row[heads], start[heads], pos[heads], np.add.reduceat(size, heads)


def _running(df: DataFrame, length: str) -> DataFrame:
    """``df`` with ``part`` and ``at``: the sum of ``length`` over the rows
    before, in the order of partitions and of rows inside them."""
    names = [*df.columns, "ahead"]
    spot = names.index(length)

    def run(batches):
        done = 0
        for batch in batches:
            sizes = batch.column(spot).to_numpy(zero_copy_only=False)
            upto = done + np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(upto - sizes, pa.int64())], names=names)
            done = int(upto[-1]) if len(upto) else done

    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)
    inside = checkpointed(arrow_map(df, run, schema + ", ahead long")).withColumn("part", F.spark_partition_id())
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sums = inside.groupBy("part").agg(F.sum(length).alias("n"))
    base = sums.select("part", F.coalesce(F.sum("n").over(order), F.lit(0).cast("long")).alias("base"))
    return inside.join(F.broadcast(base), "part").withColumn("at", F.col("base") + F.col("ahead")).drop("part", "base", "ahead")


BLOCK = 4096  # quanta made from one row


def sorted_quanta(totals: DataFrame, quantum: int, targets: dict[str, int] | None) -> DataFrame:
    """``queue, c, at``: the global position of each quantum of the queues
    in ``totals`` (``queue, n``), in the order of ``Schedule``."""
    quanta = F.expr(f"(n + {quantum - 1}) div {quantum}")
    totals = totals.select("queue", "n", quanta.alias("quanta"))
    if targets:
        known = totals.sparkSession.createDataFrame([(q, max(1, int(t))) for q, t in targets.items()], "queue string, target long")
        totals = totals.join(known, "queue", "left").withColumn("target", F.coalesce("target", F.lit(1).cast("long")))
    else:
        totals = totals.withColumn("target", F.col("quanta"))
    last = F.col("quanta") - 1
    blocks = totals.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(quanta - 1) div {BLOCK}"))).alias("block"))
    blocks = blocks.repartition("queue", "block")
    first = F.col("block") * BLOCK
    made = blocks.select("queue", "n", "target", F.explode(F.sequence(first, F.least(first + BLOCK - 1, last))).alias("c"))
    # (2c + 1) / target in two exact steps: whole part, then the rest's share
    due = 2 * F.col("c") + 1
    made = made.select(
        "queue", "c", F.least(F.lit(quantum), F.col("n") - F.col("c") * quantum).cast("long").alias("size"),
        F.expr("(2 * c + 1) div target").alias("due"), ((due % F.col("target")) / F.col("target")).alias("rest"),
    )
    order = ["due", "rest", "queue", "c"]
    dealt = made.repartitionByRange(*order).sortWithinPartitions(*order)
    return _running(dealt, "size").select("queue", "c", "at")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    window: int = 2048,
    quantum: int = 128,
    end_id: int = 1,
    targets: dict[str, int] | None = None,
    max_queues: int = 256,
    max_broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, source``.

    ``targets`` gives a queue's integer share; without it every queue's
    target is its number of quanta, so that all windows have the corpus's
    own proportions and all queues end together.
    """
    queue = F.coalesce(F.col("source").cast("string"), F.lit(""))
    n_queues = docs.select(queue).distinct().count()
    ids = checkpointed(tokenised(docs, tokenizer_path, end_id, queue)).withColumn("part", F.spark_partition_id())

    # tokens per (queue, partition); a running sum of them gives each
    # partition its place in each queue
    sums = checkpointed(ids.groupBy("queue", "part").agg(F.sum("n").alias("n")))
    ordered = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = checkpointed(
        sums.withColumn("base", F.coalesce(F.sum("n").over(ordered), F.lit(0).cast("long"))).drop("n")
    )
    totals = sums.groupBy("queue").agg(F.sum("n").alias("n"))
    begin = (F.col("base") + F.col("ahead")).alias("begin")
    if n_queues <= max_queues:
        totals = sorted(tuple(r) for r in totals.collect())  # one row per queue
        tokens = [int(t) for _, t in totals]
        shares = [max(1, int(targets.get(q, 1))) if targets else -(-t // quantum) for q, t in totals]
        plan = Schedule(tokens, shares, quantum)
        number = {q: i for i, (q, _) in enumerate(totals)}
    else:
        plan = None

    def positions(batch):
        if plan is None:  # the documents' quanta come with them, in order
            at = batch.column(6).flatten().to_numpy(zero_copy_only=False)
            return lambda row, c: at
        queues = np.array([number[x] for x in batch.column(2).to_pylist()], dtype=np.int64)

        def of(row, c):
            pos = np.zeros(len(row), dtype=plan.kind)
            for s in np.unique(queues):
                mine = queues[row] == s
                pos[mine] = plan.position(int(s), c[mine])
            return pos

        return of

    def place(batches):
        unpack = zstandard.ZstdDecompressor()
        kind = encoder(tokenizer_path, False).kind
        for batch in batches:
            n, begin = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))
            row, start, pos, length = cut_pieces(positions(batch), quantum, begin, n, window)
            crcs, at, blobs = [], -1, batch.column(5)
            for r, s, m in zip(row.tolist(), start.tolist(), length.tolist()):
                if r != at:
                    at, ids = r, np.frombuffer(unpack.decompress(blobs[r].as_py()), dtype=kind).astype("<u4")
                crcs.append(zlib.crc32(ids[s : s + m]))
            rows = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(crcs, pa.int64()), pa.array(n[row], pa.int64()),
                 pa.array((pos // window).astype(np.int64)), pa.array((pos % window).astype(np.int64)),
                 batch.column(1).take(rows)],
                names=[f.split()[0] for f in PIECES.split(", ")],
            )

    placed = ids.withColumn("row", F.monotonically_increasing_id()).join(broadcast_if_small(base, max_broadcast_rows), ["queue", "part"])
    columns = ["doc_id", "source", "queue", "n", "begin", "ids"]
    if plan is not None:
        return arrow_map(placed.select("doc_id", "source", "queue", "n", begin, "ids"), place, PIECES)
    placed = placed.select("row", "doc_id", "source", "queue", "n", begin, "ids")
    needed = F.sequence(F.expr(f"begin div {quantum}"), F.expr(f"(begin + n - 1) div {quantum}"))
    spans = (
        placed.select("row", "queue", F.explode(needed).alias("c")).join(sorted_quanta(totals, quantum, targets), ["queue", "c"])
        .groupBy("row").agg(F.sort_array(F.collect_list(F.struct("c", "at"))).getField("at").alias("at"))
    )
    return arrow_map(placed.join(spans, "row").select(*columns, "at"), place, PIECES)
