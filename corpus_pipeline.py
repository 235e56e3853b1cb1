"""From raw documents to packed training sequences, in five stages.

Each stage works on all that its predecessor kept. ``run`` applies them to
``documents``; every stage's result is cut from its lineage in the shared
checkpoint folder before the next one reads it.

Columns beside those of ``documents`` pass through the first four stages.
Nulls, empty texts, ties, repeated rows and empty tables have the results
that each operator's docstring states.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.llm.common import broadcast_if_small, checkpointed, row_key, table
from dialogprep.llm.line_dedup import dedup_lines
from dialogprep.llm.mixing import Mix, first_tokens, mixed
from dialogprep.llm.packing import pack
from dialogprep.llm.quality import score, train
from dialogprep.llm.queries import MIX, TOKENIZER, with_domain
from dialogprep.llm.shingle_join import near_duplicates

CORE = ("doc_id", "text", "lang", "source", "n_chars")
MIXTURE = Mix(MIX.levels, MIX.weights, percent=90, max_epochs=2, seed=23)
MAX_BROADCAST = 1_000_000


def _apart(docs: DataFrame, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Run ``step`` with other columns renamed, so that none can clash with
    a column it makes, and return the columns of ``docs``."""
    names = {c: c if c in CORE else f"extra_{i}" for i, c in enumerate(docs.columns)}
    out = step(docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()])


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores below one half go."""
    forest = train(docs, table(spark, sf_dir, "labels"))
    return _apart(docs, lambda d: score(d, forest, "quality_score").where(F.col("quality_score") >= 0.5))


def _groups(docs: DataFrame) -> DataFrame:
    """``row_key, class_id``: near duplicates have one class, a text without
    a word is a class of its own."""
    found = near_duplicates(docs, k=5, num=80, den=100)
    return found.select("row_key", F.coalesce("class_id", F.col("row_key.a")).alias("class_id"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents go from all of them. Near duplicates
    count as one document, so what only they share stays for the next stage,
    which keeps one of them whole."""
    return _apart(docs, lambda d: _recounted(dedup_lines(d, min_docs=10, min_chars=1, classes=_groups)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) one row stays: that
    of the smallest id, null last, ties by a hash of the text. Rows that share
    an id are in one group; texts without a word are in none."""

    def step(d: DataFrame) -> DataFrame:
        found = checkpointed(near_duplicates(d, k=5, num=80, den=100).where("class_id IS NOT NULL").select("doc_id", "class_id", "row_key"))
        first = F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")
        one = found.groupBy("class_id").agg(F.min(first).alias("first"), F.count("*").alias("n")).where("n > 1")
        one = one.select("class_id", F.col("first.row_key").alias("kept"))
        marked = found.join(one, "class_id").groupBy("row_key").agg(
            F.max(F.col("row_key") == F.col("kept")).alias("stays"), F.count("*").alias("n")
        )
        marked = checkpointed(marked.where("NOT stays OR n > 1"))
        keyed = d.withColumn("row_key", row_key(F.col("doc_id").cast("long"), F.col("text").cast("string")))
        seen = keyed.join(broadcast_if_small(marked, MAX_BROADCAST), "row_key", "left")
        # rows equal in id and text are told apart by nothing: any one of them
        repeated = seen.where("stays").dropDuplicates(["row_key"])
        return seen.where("stays IS NULL").unionByName(repeated)

    return _apart(docs, step)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by target weights, once per epoch that takes them; at a
    leaf's cut a document gives its first tokens only."""

    def step(d: DataFrame) -> DataFrame:
        taken = mixed(with_domain(d), MIXTURE)
        short = F.col("take_tokens") < F.col("n_tokens")
        text = F.when(short, first_tokens(F.col("text"), F.col("take_tokens"))).otherwise(F.col("text"))
        return _recounted(taken.withColumn("text", text))

    return _apart(docs, step)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens that keep the mixture."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality", quality_filter),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# A trained classifier has no SQL form: tests compare with a plain model.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = checkpointed(docs)
    return docs
