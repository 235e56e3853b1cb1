"""dialogprep: chat exports -> clean, de-duplicated fine-tuning pairs, on Spark."""

from dialogprep.operators.pairs import DEFAULT_TIME_GAP_LIMIT, mark_pairs, reply_pairs, sample_record
from dialogprep.operators.split import split
from dialogprep.operators.turns import clean_messages, merge_blocks, merge_turns, other_party
from dialogprep.plans.job import (
    JobConfig,
    JobResult,
    build_samples,
    clean_exports,
    clean_inbox,
    generate_dataset,
    generate_from_cleaned,
    run,
    split_jsonl,
    validate_jsonl,
)
from dialogprep.session import apply_conf, get_spark

__all__ = [
    "DEFAULT_TIME_GAP_LIMIT",
    "JobConfig",
    "JobResult",
    "apply_conf",
    "build_samples",
    "clean_exports",
    "clean_inbox",
    "clean_messages",
    "generate_dataset",
    "generate_from_cleaned",
    "get_spark",
    "mark_pairs",
    "merge_blocks",
    "merge_turns",
    "other_party",
    "reply_pairs",
    "run",
    "sample_record",
    "split",
    "split_jsonl",
    "validate_jsonl",
]
