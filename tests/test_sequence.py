"""The chunked (hot-key) scan must give exactly what the window scan gives."""

import functools

import pytest
from pyspark.sql import functions as F

from conftest import SF01, rows
from dialogprep.operators import pairs as P
from dialogprep.operators import turns as U
from dialogprep.operators.sequence import by_hotness, scan_chunked, scan_window, split_hot_keys
from dialogprep.plans.queries import EVENT_ORDER, event_messages


@pytest.fixture(scope="module")
def msgs(spark):
    return event_messages(spark, SF01).cache()


def chunked(n):
    return functools.partial(lambda df, key, order, chunks, **kw: scan_chunked(df, key, order, chunks, **kw), chunks=n)


@pytest.mark.parametrize("n_chunks", [3, 17])
def test_seq_prev_next_equal(spark, msgs, n_chunks):
    kw = dict(seq="seq", prev=["sender"], nxt=["text"], run_of="sender", run="run")
    a = scan_window(msgs, ["user_id"], EVENT_ORDER, **kw)
    b = chunked(n_chunks)(msgs, ["user_id"], EVENT_ORDER, **kw)
    cols = ["event_id", "seq", "prev_sender", "next_text", "run"]
    assert rows(a, *cols) == rows(b, *cols)


def test_one_key_holding_every_row(spark, msgs):
    # Worst case: a single key with all rows, cut into many chunks.
    one = msgs.withColumn("user_id", F.lit(7).cast("bigint"))
    a = U.merge_blocks(one, ["user_id"], EVENT_ORDER, timestamp="ts_ms", scan=scan_window)
    b = U.merge_blocks(one, ["user_id"], EVENT_ORDER, timestamp="ts_ms", scan=chunked(23))
    assert rows(a) == rows(b)
    assert a.count() > 1000


def test_pairs_equal_through_hot_split(spark, msgs):
    def chain(d, scan):
        blocks = U.merge_blocks(d, ["user_id"], EVENT_ORDER, timestamp="ts_ms", scan=scan)
        return P.reply_pairs(blocks, ["user_id"], scan=scan)

    plain = chain(msgs, scan_window)
    # Every user above the threshold -> all rows take the chunked path.
    split = by_hotness(msgs, ["user_id"], chain, hot_threshold=10, chunk_rows=300)
    assert rows(plain) == rows(split)
    assert plain.count() == 869


def test_split_routes_only_hot_keys(spark, msgs):
    counts = {r["user_id"]: r["count"] for r in msgs.groupBy("user_id").count().collect()}
    threshold = sorted(counts.values())[-5]  # the four biggest users are hot
    s = split_hot_keys(msgs, ["user_id"], hot_threshold=threshold, chunk_rows=50)
    hot_users = {r[0] for r in s.hot.select("user_id").distinct().collect()}
    assert hot_users == {u for u, c in counts.items() if c > threshold}
    assert s.normal.count() + s.hot.count() == msgs.count()
    assert s.chunks >= 2


def test_no_hot_keys_means_no_split(spark, msgs):
    s = split_hot_keys(msgs, ["user_id"], hot_threshold=10**9)
    assert s.hot is None


def test_null_hot_key_keeps_rows(spark, msgs):
    nul = msgs.withColumn("user_id", F.lit(None).cast("bigint"))
    a = U.merge_blocks(nul, ["user_id"], EVENT_ORDER, timestamp="ts_ms", scan=scan_window)
    b = U.merge_blocks(nul, ["user_id"], EVENT_ORDER, timestamp="ts_ms", scan=chunked(9))
    assert rows(a) == rows(b)
    assert b.agg(F.sum("n_messages")).first()[0] == msgs.count()


def test_detection_can_be_turned_off(spark, msgs):
    def chain(d, scan):
        return U.merge_blocks(d, ["user_id"], EVENT_ORDER, timestamp="ts_ms", scan=scan)

    assert rows(by_hotness(msgs, ["user_id"], chain, hot_threshold=None)) == rows(chain(msgs, scan_window))


def test_sampled_detection_finds_the_hot_key(spark, msgs, monkeypatch):
    import dialogprep.operators.sequence as Q

    # Half of all rows on one key; detection counts a 10% sample.
    skewed = msgs.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(0)).otherwise(F.col("user_id")))
    monkeypatch.setattr(Q, "SAMPLE_ROWS_PER_HOT_KEY", 100)
    s = split_hot_keys(skewed, ["user_id"], hot_threshold=1000, chunk_rows=1000)
    assert {r[0] for r in s.hot.select("user_id").distinct().collect()} == {0}
    assert s.normal.count() + s.hot.count() == skewed.count()
    assert 3 <= s.chunks <= 8


def test_merge_turns_chunked_equals_window(spark, msgs):
    a = U.merge_turns(msgs, ["user_id"], EVENT_ORDER, scan=scan_window)
    b = U.merge_turns(msgs, ["user_id"], EVENT_ORDER, scan=chunked(13))
    assert rows(a) == rows(b)
    one = msgs.withColumn("user_id", F.lit(5).cast("bigint"))
    assert rows(U.merge_turns(one, ["user_id"], EVENT_ORDER, scan=scan_window)) == rows(
        U.merge_turns(one, ["user_id"], EVENT_ORDER, scan=chunked(7))
    )


def test_hot_keys_without_broadcast_over_a_shuffled_input(spark, msgs, monkeypatch):
    import dialogprep.operators.sequence as Q

    def chain(d, scan):
        return U.merge_blocks(d, ["user_id"], EVENT_ORDER, timestamp="ts_ms", scan=scan)

    want = rows(chain(msgs, scan_window))
    monkeypatch.setattr(Q, "MAX_BROADCAST_HOT_KEYS", 0)
    monkeypatch.setattr(Q, "SAMPLE_ROWS_PER_HOT_KEY", 30)  # the detection samples
    moved = msgs.repartition(7).repartition(5, "event_id")
    assert rows(by_hotness(moved, ["user_id"], chain, hot_threshold=60, chunk_rows=50)) == want
