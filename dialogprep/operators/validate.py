"""Validation and de-duplication of JSONL sample records.

Every non-blank line gets a status: MALFORMED_JSON, STRUCTURAL_INVALID,
DUPLICATE (same fingerprint as an earlier line) or VALID. The statuses are
computed in one pass; the outputs are one write partitioned by status, so
the data set and the audit log come from the same job, and the counts come
from an ``Observation`` on that write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from dialogprep.functions import records as R
from dialogprep.operators.dedup import mark_first
from dialogprep.session import ensure_checkpoint_dir


@dataclass
class ValidationCounts:
    total: int = 0
    valid: int = 0
    duplicates: int = 0
    malformed: int = 0


def classify_lines(
    lines: DataFrame, order: Sequence[str], line: str = "line", materialize: bool = False
) -> DataFrame:
    """Add ``status``, ``fp`` (fingerprint) and ``fp_key`` (its SHA-256).

    ``order`` is a unique line order (first wins among duplicates). The
    first-wins step reads the routed lines twice (minima, then rows); with
    ``materialize`` they are written once to the session's checkpoint folder
    so the JSON parsing runs once and the lineage is cut there.
    """
    routed = R.route_lines(lines, line).withColumn("fp_key", R.fingerprint_key("fp"))
    if materialize:
        ensure_checkpoint_dir(routed.sparkSession)
        routed = routed.checkpoint(eager=True)
    marked = mark_first(routed, "fp_key", order, "_dp_first")
    return marked.withColumn(
        "status", F.when(~F.col("_dp_first"), F.lit(R.DUPLICATE)).otherwise(F.col("status"))
    ).drop("_dp_first")


# Audit records escape non-ASCII characters, as the JSON writer of the
# reference does by default.
ASCII_JSON = {"writeNonAsciiCharacterAsCodePoint": "true"}


def audit_value(status: Column, raw_line: Column, data: Column) -> Column:
    """Audit record: ``{"reason", "raw_line"}`` for unparsable or structural
    rejects, ``{"reason", "data"}`` for duplicates, where ``data`` is the
    record's JSON text (already checked to be one JSON value)."""
    raw = F.to_json(F.struct(status.alias("reason"), raw_line.alias("raw_line")), ASCII_JSON)
    dup = F.concat(F.lit('{"reason":"DUPLICATE","data":'), data, F.lit("}"))
    return F.when(status == R.DUPLICATE, dup).otherwise(raw)


def output_value(lines: DataFrame, line: str = "line") -> DataFrame:
    """``value``: the record for VALID lines, the audit record otherwise.

    A kept record is written as its own (stripped) line: it is one JSON
    object, and this keeps its key order and values exactly (Spark's VARIANT
    writer would sort the keys).
    """
    return lines.withColumn(
        "value",
        F.when(F.col("status") == R.VALID, F.col(line)).otherwise(
            audit_value(F.col("status"), F.col(line), F.col(line))
        ),
    )


def observed_counts(df: DataFrame, name: str = "validation") -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    s = F.col("status")
    observed = df.observe(
        obs,
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == R.VALID).alias("valid"),
        F.count_if(s == R.DUPLICATE).alias("duplicates"),
        F.count_if(s.isin(R.MALFORMED_JSON, R.STRUCTURAL_INVALID)).alias("malformed"),
    )
    return observed, obs


def counts_from(obs: Observation) -> ValidationCounts:
    m = obs.get
    return ValidationCounts(
        total=int(m.get("total", 0) or 0),
        valid=int(m.get("valid", 0) or 0),
        duplicates=int(m.get("duplicates", 0) or 0),
        malformed=int(m.get("malformed", 0) or 0),
    )


def count_statuses(lines: DataFrame, line: str = "line") -> DataFrame:
    """One row per status with its count, straight from the lines.

    Lines are parsed once; of the records that share a fingerprint all but
    one are duplicates, whichever comes first, so no order is needed.
    """
    routed = R.route_lines(lines, line).select("status", R.fingerprint_key("fp").alias("fp_key"))
    groups = routed.groupBy("status", "fp_key").agg(F.count(F.lit(1)).alias("c"))
    valid = F.col("status") == R.VALID
    kept = F.struct(F.col("status"), F.when(valid & F.col("fp_key").isNotNull(), 1).otherwise(F.col("c")).cast("bigint").alias("n"))
    repeated = F.struct(F.lit(R.DUPLICATE).alias("status"), F.when(valid & F.col("fp_key").isNotNull(), F.col("c") - 1).otherwise(0).cast("bigint").alias("n"))
    return groups.select(F.inline(F.array(kept, repeated))).groupBy("status").agg(F.sum("n").alias("n")).where("n > 0")


def status_counts(classified: DataFrame) -> DataFrame:
    """One row per status with its count."""
    return classified.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
