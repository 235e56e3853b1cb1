"""The cleaning step on a stream of export files.

Message scrubbing is stateless per row, so the batch transform applies as
is to Structured Streaming: new ``message_*.json`` files under the inbox are
parsed, exploded and cleaned, and appended to a Parquet table. The ordered
steps (blocks, pairs) need whole conversations and run in batch on that
table (:func:`dialogprep.plans.job.build_samples`).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from dialogprep.functions import text as T
from dialogprep.operators.turns import clean_messages, rejected_messages
from dialogprep.session import apply_conf
from dialogprep.sources.cleaned import CLEANED_COLUMNS
from dialogprep.sources.exports import export_reader, parse_files, split_files
from dialogprep.sources.listing import check_apart, resolve

# Levels below the inbox at which folders with hidden names are found.
HIDDEN_LEVELS = 8


def clean_stream(
    spark: SparkSession,
    inbox: str,
    my_name: str,
    output_dir: str,
    checkpoint_location: str,
    secrets: Sequence[tuple[str, str]] = (),
    extra_noise: Iterable[str] | None = None,
    min_length: int = T.MIN_LENGTH,
    max_length: int = T.MAX_LENGTH,
    available_now: bool = True,
    processing_time: str | None = None,
    quarantine_dir: str | None = None,
) -> StreamingQuery:
    """Start a stream that appends cleaned messages of new export files.

    ``checkpoint_location`` is this stream's own folder in shared storage: a
    restarted application goes on from it. With ``available_now`` the stream
    processes what is there and stops; else it runs every
    ``processing_time``. Corrupt files, by a stream of their own, and rows
    whose timestamp is no number go to ``quarantine_dir`` where it is given.
    """
    T.check_name(my_name)
    apply_conf(spark)
    check_apart(
        spark, {"inbox": inbox},
        {"output_dir": output_dir, "checkpoint_location": checkpoint_location, "quarantine_dir": quarantine_dir},
    )
    _, root = resolve(spark, inbox)
    # Every child is a root of its own, and so is every hidden folder below:
    # Spark skips names that start with "_" or "." beneath a root.
    hidden = ",".join("*/" * level + "[_.]*" for level in range(1, HIDDEN_LEVELS))
    files = export_reader(spark, streaming=True).text(f"{root.toString().rstrip('/')}/{{*,{hidden}}}")
    scan = split_files(parse_files(files), root.toUri().getPath().rstrip("/"))
    cleaned = clean_messages(scan.messages, my_name, secrets, extra_noise, min_length, max_length)

    def start(frame, fmt: str, target: str, state: str) -> StreamingQuery:
        writer = frame.writeStream.format(fmt).option("checkpointLocation", state).outputMode("append")
        if available_now:
            writer = writer.trigger(availableNow=True)
        elif processing_time:
            writer = writer.trigger(processingTime=processing_time)
        return writer.start(target)

    if quarantine_dir:
        rejected = scan.quarantine.unionByName(rejected_messages(scan.messages))
        start(rejected, "json", quarantine_dir, checkpoint_location.rstrip("/") + "-quarantine")
    return start(cleaned.select(*CLEANED_COLUMNS), "parquet", output_dir, checkpoint_location)
