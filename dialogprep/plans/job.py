"""User-level jobs: clean exports, build the dataset, validate, split, run all.

Storage between steps is Parquet/JSONL written to the paths in the config
(which may be any Hadoop URI), so each step starts from a written table and
a lost executor only costs the current step's tasks.
"""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dialogprep.functions import records as R
from dialogprep.functions import text as T
from dialogprep.operators import lean
from dialogprep.operators import pairs as P
from dialogprep.operators import split as S
from dialogprep.operators import turns as U
from dialogprep.operators import validate as V
from dialogprep.operators.dedup import mark_first
from dialogprep.operators.sequence import DEFAULT_CHUNK_ROWS, DEFAULT_HOT_THRESHOLD, by_hotness
from dialogprep.sources import cleaned as C
from dialogprep.sources import exports as E
from dialogprep.sources import jsonl as J
from dialogprep.sources.listing import check_apart
from dialogprep.sources.ordered import write_ordered
from dialogprep.sources.publish import Publication
from dialogprep.sources.secrets import load_secrets

log = logging.getLogger(__name__)

# Bytes of text that one conversation may bring to one task.
HOT_BYTES = 256 << 20


@dataclass
class JobConfig:
    """Knobs of a full run. Output paths are folders (Spark writes parts);
    those that a job writes have to be given. With ``train_dir`` and
    ``val_dir`` a full run also splits its data set."""

    def need(self, *names: str) -> dict[str, str]:
        missing = [n for n in names if not getattr(self, n)]
        if missing:
            raise ValueError(f"JobConfig needs {', '.join(missing)}")
        return {n: getattr(self, n) for n in names}

    my_name: str
    inbox_dir: str | None = None
    raw_dir: str | None = None
    cleaned_dir: str | None = None
    output_dir: str | None = None
    quarantine_dir: str | None = None
    samples_dir: str | None = None
    train_dir: str | None = None
    val_dir: str | None = None
    val_fraction: float = 0.05
    seed: int | None = None
    ordered: bool = False
    message_glob: str = E.MESSAGE_GLOB
    secrets_path: str | None = None
    time_gap_limit: int = P.DEFAULT_TIME_GAP_LIMIT
    extra_noise: Sequence[str] = ()
    min_length: int = T.MIN_LENGTH
    max_length: int = T.MAX_LENGTH
    gap_from: str = "last"
    repair_sender: bool = False
    hot_threshold: int = DEFAULT_HOT_THRESHOLD
    chunk_rows: int = DEFAULT_CHUNK_ROWS


@dataclass
class JobResult:
    conversations_processed: int = 0
    total_samples: int = 0
    valid_samples: int = 0
    duplicates_removed: int = 0
    malformed_removed: int = 0
    elapsed_seconds: float = 0.0
    quarantined_files: int = 0
    train_lines: int = 0
    val_lines: int = 0
    paths: dict = field(default_factory=dict)


def clean_exports(spark: SparkSession, cfg: JobConfig) -> tuple[DataFrame, int, int]:
    """Exports -> parsed files (Parquet) -> cleaned messages (Parquet).

    Returns the cleaned frame read back, the number of conversations with at
    least one raw message, and the number of unreadable files. The three
    outputs are published together.
    """
    outputs = cfg.need("raw_dir", "cleaned_dir", "quarantine_dir")
    secrets = _checked(spark, cfg, outputs)
    with Publication(spark, outputs) as out:
        _, conversations, quarantined = _clean(spark, cfg, secrets, out)
    return C.read_cleaned(spark, cfg.cleaned_dir), conversations, quarantined


def _checked(spark: SparkSession, cfg: JobConfig, outputs: dict[str, str]) -> list[tuple[str, str]]:
    """What can be wrong before anything is written; returns the secrets."""
    T.check_name(cfg.my_name)
    check_apart(spark, {**cfg.need("inbox_dir"), "secrets_path": cfg.secrets_path}, outputs)
    return load_secrets(cfg.secrets_path, spark)


def _clean(spark: SparkSession, cfg: JobConfig, secrets: list[tuple[str, str]], out: Publication) -> tuple[DataFrame, int, int]:
    found = E.input_paths(spark, cfg.inbox_dir)
    conversations = 0
    if found is None:
        raw = E.read_exports(spark, cfg.inbox_dir).messages  # empty
        quarantine = spark.createDataFrame([], "path string, reason string")
    else:
        # Land the parsed files once (one row per file): multi-line JSON is
        # the slowest part to read, and the messages, the quarantine and the
        # counts are all derived from it.
        paths, root = found
        files = E.parse_files(E.export_reader(spark, glob=cfg.message_glob).text(paths))
        files, landing = _count_obs(files)
        files.write.mode("overwrite").parquet(out.path("raw_dir"))
        n_files = int(landing.get.get("n", 0) or 0)
        landed = spark.read.parquet(out.path("raw_dir"))
        scan = E.split_files(landed, root)
        conversations = conversation_count(landed)
        raw, quarantine = scan.messages, scan.quarantine.union(E.empty_files(spark, paths, landed, n_files, cfg.message_glob))
        quarantine = quarantine.unionByName(U.rejected_messages(E.split_files(U.with_bad_times(landed), root).messages))
    observed, obs = _count_obs(quarantine)
    observed.write.mode("overwrite").json(out.path("quarantine_dir"))
    cleaned = U.clean_messages(
        raw, cfg.my_name, secrets, cfg.extra_noise, cfg.min_length, cfg.max_length,
        repair_sender=cfg.repair_sender,
    )
    C.write_cleaned(cleaned, out.path("cleaned_dir"))
    return C.read_cleaned(spark, out.path("cleaned_dir")), conversations, int(obs.get.get("n", 0) or 0)


def conversation_count(files: DataFrame) -> int:
    """Conversations (folders) with at least one raw message, from the rows
    of the parsed files: no message is exploded."""
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.where(F.size("messages") > 0).agg(F.count_distinct(folder).alias("n")).first()["n"] or 0


def clean_inbox(
    spark: SparkSession,
    my_name: str,
    inbox_dir: str,
    output_dir: str,
    secrets_path: str | None = None,
    raw_dir: str | None = None,
) -> int:
    """Clean an inbox into ``output_dir`` (Parquet); returns the number of
    conversations with at least one message (0 for a missing inbox)."""
    cfg = JobConfig(
        my_name=my_name,
        inbox_dir=inbox_dir,
        cleaned_dir=output_dir,
        secrets_path=secrets_path,
        raw_dir=raw_dir or output_dir.rstrip("/") + "-raw",
        quarantine_dir=output_dir.rstrip("/") + "-quarantine",
    )
    _, conversations, _ = clean_exports(spark, cfg)
    return conversations


def generate_from_cleaned(
    spark: SparkSession,
    cleaned_dir: str,
    output_dir: str,
    time_gap_limit: int = P.DEFAULT_TIME_GAP_LIMIT,
    fmt: str = "parquet",
    ordered: bool = False,
    quarantine_dir: str | None = None,
) -> int:
    """Cleaned conversations -> JSONL samples; returns the sample count.

    ``fmt="parquet"`` reads this package's cleaned table, ``"json"`` a folder
    of per-conversation JSON lists, whose unusable files are listed in
    ``quarantine_dir`` where it is given. A missing folder gives 0.
    """
    if fmt not in ("parquet", "json"):
        raise ValueError("fmt must be 'parquet' or 'json'")
    if not J.path_exists(spark, cleaned_dir):
        return 0
    outputs = {"output_dir": output_dir, "quarantine_dir": quarantine_dir if fmt == "json" else None}
    check_apart(spark, {"cleaned_dir": cleaned_dir}, outputs)
    cfg = JobConfig(my_name="-", time_gap_limit=time_gap_limit, ordered=ordered)
    with Publication(spark, outputs) as out:
        if fmt == "parquet":
            cleaned = C.read_cleaned(spark, cleaned_dir)
        else:
            scan = C.scan_cleaned_lists(spark, cleaned_dir)
            if quarantine_dir:
                scan.quarantine.write.mode("overwrite").json(out.path("quarantine_dir"))
            # The count comes with the write that reads the items: files are
            # parsed once. No key of whole-read lists is too big for a task.
            cfg.hot_threshold = None
            dropped = Observation("dropped")
            cleaned = scan.items.observe(dropped, F.count_if(~F.col("has_timestamp")).alias("n")).where("has_timestamp")
        n = _write_samples(cleaned, out.path("output_dir"), cfg)
    if fmt == "json" and dropped.get.get("n"):
        log.warning("%d items without a timestamp were left out", dropped.get["n"])
    return n


def build_samples(
    messages: DataFrame,
    key: Sequence[str] = U.EXPORT_KEY,
    order: Sequence = U.EXPORT_ORDER,
    time_gap_limit: int = P.DEFAULT_TIME_GAP_LIMIT,
    gap_from: str = "last",
    hot_threshold: int = DEFAULT_HOT_THRESHOLD,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    sender: str = "sender",
    text: str = "text",
    timestamp: str = "timestamp",
    counts_from: DataFrame | None = None,
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """Cleaned messages -> (user, assistant) pairs with ``sample`` struct.

    Normal conversations go through one shuffle on the key; conversations
    over ``hot_threshold`` messages or ``hot_bytes`` bytes of text go through
    the chunked scan, without their texts until the pairs are known.
    ``counts_from`` is a cheaper frame with the same keys and no fewer rows
    (the messages before cleaning), so that finding them cleans nothing.
    """

    def chain(rows: DataFrame, scan) -> DataFrame:
        blocks = U.merge_blocks(rows, key, order, sender, text, timestamp, scan=scan)
        return P.reply_pairs(blocks, key, time_gap_limit, gap_from, scan=scan)

    def lean_chain(rows: DataFrame, scan) -> DataFrame:
        return lean.lean_pairs(rows, key, order, time_gap_limit, gap_from, scan, sender, text, timestamp)

    size = None
    if counts_from is None or text in counts_from.columns:
        size = F.octet_length(F.col(text).cast("string")).cast("bigint")
    pairs = by_hotness(messages, key, chain, hot_threshold, chunk_rows, counts_from, lean_chain, size, hot_bytes)
    return pairs.withColumn("sample", P.sample_record())


def generate_dataset(spark: SparkSession, cleaned: DataFrame, output_dir: str, cfg: JobConfig | None = None) -> int:
    """Write the samples as JSONL (no de-duplication); returns the count.

    With ``cfg.ordered`` the lines come in conversation order, then block
    order (part files in name order), as a range-partitioned sort.
    """
    with Publication(spark, {"output_dir": output_dir}) as out:
        return _write_samples(cleaned, out.path("output_dir"), cfg or JobConfig(my_name="-"))


def _write_samples(cleaned: DataFrame, path: str, cfg: JobConfig) -> int:
    samples = build_samples(cleaned, time_gap_limit=cfg.time_gap_limit, gap_from=cfg.gap_from,
                            hot_threshold=cfg.hot_threshold, chunk_rows=cfg.chunk_rows)
    line = J.to_json_line(F.col("sample"))
    if cfg.ordered:
        manifest = write_ordered(samples, line, ["conversation", "block"], path)
        return sum(part["rows"] for part in manifest)
    observed, obs = _count_obs(samples)
    J.write_lines(observed, line, path)
    return int(obs.get.get("n", 0) or 0)


def _count_obs(df: DataFrame):
    obs = Observation("count")
    return df.observe(obs, F.count(F.lit(1)).alias("n")), obs


def validate_jsonl(spark: SparkSession, source: str, output_dir: str) -> V.ValidationCounts:
    """Validate and de-duplicate a JSONL file or folder.

    Writes ``<output_dir>/status=VALID`` (the kept records) and one folder
    per rejection reason (the audit log) in one job. Raises
    FileNotFoundError when ``source`` does not exist.
    """
    check_apart(spark, {"source": source}, {"output_dir": output_dir})
    lines = J.read_lines(spark, source).drop("raw")
    classified = V.classify_lines(lines, ["file", "block", "row_id"], materialize=True)
    out = V.output_value(classified)
    observed, obs = V.observed_counts(out)
    with Publication(spark, {"output_dir": output_dir}) as target:
        J.write_lines(observed, "value", target.path("output_dir"), partition_by="status")
    return V.counts_from(obs)


def split_jsonl(
    spark: SparkSession,
    source: str,
    train_dir: str,
    val_dir: str,
    val_fraction: float = 0.05,
    seed: int | None = None,
) -> tuple[int, int]:
    """Seeded exact split of a JSONL source into train and val folders.

    The order key hashes the line text and, for equal lines, its occurrence
    number, so the split follows content, not file layout, and each copy of
    a line falls on its own. Raises before writing when a target is, holds
    or lies under the source.
    """
    S.check_fraction(val_fraction)
    outputs = {"train_dir": train_dir, "val_dir": val_dir}
    check_apart(spark, {"source": source}, outputs)
    with Publication(spark, outputs) as out:
        return _split(spark, source, out, val_fraction, seed)


def _split(spark: SparkSession, source: str, out: Publication, val_fraction: float, seed: int | None) -> tuple[int, int]:
    """Both sides from one evaluation: one write partitioned by side, whose
    folders then become the two outputs."""
    lines = J.read_lines(spark, source)
    res = S.split_lines(lines, "line", ["file", "block", "row_id"], val_fraction, seed)
    both = out.scratch("train_dir", "sides")
    obs = Observation("sides")
    counted = res.sides.observe(obs, F.count_if(F.col("side") == "train").alias("train"), F.count_if(F.col("side") == "val").alias("val"))
    # Lines are written as read (only blank lines are dropped).
    J.write_lines(counted, "raw", both, partition_by="side")
    out.take("train_dir", f"{both}/side=train")
    out.take("val_dir", f"{both}/side=val")
    n = obs.get
    if (n.get("train", 0), n.get("val", 0)) != (res.n - res.k, res.k):
        raise RuntimeError(f"the source changed during the split: {n}, not {res.n - res.k} and {res.k}")
    return res.n - res.k, res.k


def run(spark: SparkSession, cfg: JobConfig) -> JobResult:
    """Clean -> generate -> validate and de-duplicate, with counts.

    The samples are built from the written cleaned table, classified and
    de-duplicated in the same lineage (they are well-formed by construction,
    so only duplicates can be removed), and written once, partitioned by
    status: ``<output_dir>/status=VALID`` is the data set.
    """
    start = time.time()
    outputs = cfg.need("raw_dir", "cleaned_dir", "quarantine_dir", "samples_dir", "output_dir")
    outputs |= cfg.need("train_dir", "val_dir") if cfg.train_dir or cfg.val_dir else {}
    secrets = _checked(spark, cfg, outputs)
    if cfg.train_dir:
        S.check_fraction(cfg.val_fraction)
    result = JobResult()
    with Publication(spark, outputs) as out:
        _run(spark, cfg, secrets, out, result)
    result.elapsed_seconds = max(time.time() - start, 1e-9)
    result.paths = {
        "dataset": os.path.join(cfg.output_dir, "status=VALID"),
        "cleaned": cfg.cleaned_dir,
        "quarantine": cfg.quarantine_dir,
    }
    return result


def _run(spark: SparkSession, cfg: JobConfig, secrets: list[tuple[str, str]], out: Publication, result: JobResult) -> None:
    cleaned, result.conversations_processed, result.quarantined_files = _clean(spark, cfg, secrets, out)
    samples = build_samples(
        cleaned, time_gap_limit=cfg.time_gap_limit, gap_from=cfg.gap_from,
        hot_threshold=cfg.hot_threshold, chunk_rows=cfg.chunk_rows,
    )
    fp = R.fingerprint_of(F.col("sample.messages"))
    keyed = samples.select(
        J.to_json_line(F.col("sample")).alias("line"),
        "conversation",
        "block",
        R.fingerprint_key(fp).alias("fp_key"),
    )
    # Stage the samples: the de-duplication reads them twice (the minima and
    # the rows), and the block/pair chain should run once.
    keyed.write.mode("overwrite").parquet(out.path("samples_dir"))
    staged = spark.read.parquet(out.path("samples_dir")).withColumn("status", F.lit(R.VALID))
    marked = mark_first(staged, "fp_key", ["conversation", "block"], "_dp_first")
    marked = marked.withColumn("status", F.when(F.col("_dp_first"), F.col("status")).otherwise(F.lit(R.DUPLICATE)))
    rows = marked.withColumn(
        "value",
        F.when(F.col("status") == R.VALID, F.col("line")).otherwise(
            V.audit_value(F.col("status"), F.col("line"), F.col("line"))
        ),
    )
    if cfg.ordered:
        # Conversations by key, then block order (a range-partitioned sort).
        # Status first: the write partitioned by status needs rows sorted by
        # it, and with this order it keeps the sort instead of re-sorting
        # (a re-sort is not stable once it spills).
        rows = rows.orderBy("status", "conversation", "block")
    observed, obs = V.observed_counts(rows)
    J.write_lines(observed, "value", out.path("output_dir"), partition_by="status")
    counts = V.counts_from(obs)
    result.total_samples = counts.total
    result.valid_samples = counts.valid
    result.duplicates_removed = counts.duplicates
    result.malformed_removed = counts.malformed
    if cfg.train_dir:
        data = f"{out.path('output_dir')}/status=VALID"
        if J.path_exists(spark, data):
            result.train_lines, result.val_lines = _split(spark, data, out, cfg.val_fraction, cfg.seed)
