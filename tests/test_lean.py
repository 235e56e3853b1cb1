"""Pairs found without texts equal pairs of merged blocks."""

import functools
import random

import pytest

from dialogprep.operators import lean
from dialogprep.operators import pairs as P
from dialogprep.operators import turns as U
from dialogprep.operators.sequence import scan_chunked
from dialogprep.plans import job

SCHEMA = "conversation string, file_name string, pos int, sender string, text string, timestamp bigint"


def said(seed):
    rng = random.Random(seed)
    rows = []
    for c in ("a", "b", None, "d"):
        for i in range(rng.randint(1, 60)):
            text = rng.choice(["x", " 　", None, "", "é" * rng.randint(1, 4), "two words", " padded ", "line\nbreak", "🙂"])
            rows.append((c, "f", i, rng.choice(["me", "other", "other", None]), text, rng.choice([i, i, i + 50_000_000 * (i > 30), None])))
    return rows


def tuples(df):
    return sorted((tuple(r) for r in df.select("conversation", "block", "user", "assistant", "user_ts", "reply_ts").collect()), key=repr)


@pytest.mark.parametrize("gap_from", ["last", "first"])
def test_equal_to_merged_blocks(spark, gap_from):
    for seed in range(2):
        df = spark.createDataFrame(said(seed), SCHEMA).repartition(3)
        want = tuples(P.reply_pairs(U.merge_blocks(df), U.EXPORT_KEY, gap_from=gap_from))
        assert want and tuples(lean.lean_pairs(df, gap_from=gap_from)) == want
        chunked = lambda d, k, o, **kw: scan_chunked(d, k, o, 4, **{x: v for x, v in kw.items()})
        assert tuples(lean.lean_pairs(df, gap_from=gap_from, scan=functools.partial(chunked))) == want


def test_heavy_conversations_take_the_lean_way(spark, monkeypatch):
    rows = [("big", "f", i, "other" if i % 7 else "me", f"message {i} " + "x" * 200, i) for i in range(300)]
    rows += [("small", "f", i, "other" if i % 2 else "me", f"note {i}", i) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    want = tuples(job.build_samples(df, hot_threshold=None))
    seen = []
    true = lean.lean_pairs
    monkeypatch.setattr(lean, "lean_pairs", lambda d, *a, **k: (seen.append(d.count()), true(d, *a, **k))[1])
    assert tuples(job.build_samples(df, hot_bytes=10_000)) == want and seen == [300]


def test_a_text_that_fits_into_no_row_is_named(spark):
    rows = [("a", "f", 0, "other", "x" * 500, 0), ("a", "f", 1, "me", "fine", 1), ("a", "f", 2, "other", "y" * 900, 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(Exception, match="500 bytes in block 1"):
        lean.lean_pairs(df, max_text_bytes=400).collect()
    assert lean.lean_pairs(df, max_text_bytes=600).count() == 1  # the larger block pairs with nothing
