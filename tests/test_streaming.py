"""Cleaning on a stream of export files equals batch cleaning."""

import json

from dialogprep.operators import turns as U
from dialogprep.sources import exports as E
from dialogprep.streaming.clean import clean_stream


def _write(folder, name, messages):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"messages": messages}), encoding="utf-8")


def _msg(sender, content, ts):
    return {"sender_name": sender, "content": content, "timestamp_ms": ts}


def _cleaned_rows(df):
    return sorted((r.conversation, r.file_name, r.pos, r.sender, r.text, r.timestamp) for r in df.collect())


def test_stream_matches_batch_and_appends(spark, tmp_path):
    inbox = tmp_path / "inbox"
    _write(inbox / "a", "message_1.json", [_msg("Alice", "hello there", 1000), _msg("Robin", "sent a photo", 2000)])
    _write(inbox / "b", "message_1.json", [_msg("Robin", "call 555-867-5309", 5)])
    _write(inbox / "_hidden", "message_1.json", [_msg("Hid", "from a hidden folder", 9)])
    _write(inbox / "d" / "_deep" / "x", "message_1.json", [_msg("Dee", "below a hidden folder", 9)])
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    clean_stream(spark, str(inbox), "Robin", out, ckpt).awaitTermination()
    batch = U.clean_messages(E.read_exports(spark, str(inbox)).messages, "Robin")
    assert _cleaned_rows(spark.read.parquet(out)) == _cleaned_rows(batch)

    _write(inbox / "c", "message_1.json", [_msg("Cy", "new one", 7)])
    clean_stream(spark, str(inbox), "Robin", out, ckpt).awaitTermination()
    got = _cleaned_rows(spark.read.parquet(out))
    assert len(got) == 5 and ("c", "message_1.json", 0, "other", "new one", 7) in got
    assert ("_hidden", "message_1.json", 0, "other", "from a hidden folder", 9) in got


def test_stream_quarantine(spark, tmp_path):
    inbox, bad = tmp_path / "inbox", str(tmp_path / "bad")
    _write(inbox / "a", "message_1.json", [_msg("Alice", "hello there", "never"), _msg("Alice", "again", 2)])
    (inbox / "a" / "message_2.json").write_text("{cut")
    clean_stream(spark, str(inbox), "Robin", str(tmp_path / "out"), str(tmp_path / "ck"), quarantine_dir=bad).awaitTermination()
    for stream in spark.streams.active:
        stream.awaitTermination()
    assert [r.text for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["again"]
    assert sorted(r.reason for r in spark.read.json(bad).collect()) == ["BAD_TIMESTAMP", "CORRUPT_JSON"]
