"""Export folders end to end: reading, cleaning, samples, full run."""

import json

import pytest

from dialogprep.operators import pairs as P
from dialogprep.operators import turns as U
from dialogprep.plans import job
from dialogprep.sources import cleaned as C
from dialogprep.sources import exports as E
from dialogprep.sources.secrets import load_secrets, parse_secrets


FIELDS = ("sender_name", "content", "timestamp_ms")


def write_export(base, tree):
    """An export under ``base``: folder -> file -> rows or verbatim text. A
    tuple row is (sender, content, time); other items are written as given."""
    for folder, files in tree.items():
        (base / folder).mkdir(parents=True)
        for name, rows in files.items():
            if not isinstance(rows, str):
                rows = json.dumps({"messages": [dict(zip(FIELDS, r)) if isinstance(r, tuple) else r for r in rows]})
            (base / folder / name).write_text(rows, encoding="utf-8")
    return str(base)


def config(tmp_path, inbox, **kw):
    return job.JobConfig(
        my_name="Robin",
        inbox_dir=inbox,
        raw_dir=str(tmp_path / "raw"),
        cleaned_dir=str(tmp_path / "cleaned"),
        output_dir=str(tmp_path / "out"),
        quarantine_dir=str(tmp_path / "quarantine"),
        samples_dir=str(tmp_path / "samples"),
        **kw,
    )


def test_read_exports_layout(spark, tmp_path):
    inbox = write_export(tmp_path / "inbox",
        {
            "alice_1": {
                "message_1.json": [("Alice", "first", 1000)],
                "message_2.json": [("Robin", "second", 2000)],
                "other_data.json": [("Alice", "ignored", 3000)],
            },
            "_bob 2+x%": {"message_1.json": [("Bob", "hidden dir", 1000)]},
            "broken": {"message_1.json": "INVALID JSON"},
            "empty": {"message_1.json": []},
            "deep/nested/carol": {"message_1.json": [("Carol", "nested", 5)]},
        },
    )
    scan = E.read_exports(spark, inbox)
    got = sorted((r.conversation, r.conversation_name, r.file_name, r.pos, r.content) for r in scan.messages.collect())
    assert got == [
        ("_bob 2+x%", "_bob 2+x%", "message_1.json", 0, "hidden dir"),
        ("alice_1", "alice_1", "message_1.json", 0, "first"),
        ("alice_1", "alice_1", "message_2.json", 0, "second"),
        ("deep/nested/carol", "carol", "message_1.json", 0, "nested"),
    ]
    q = scan.quarantine.collect()
    assert len(q) == 1 and q[0].path.endswith("broken/message_1.json") and q[0].reason == "CORRUPT_JSON"


def test_missing_inbox_is_empty(spark, tmp_path):
    scan = E.read_exports(spark, str(tmp_path / "nope"))
    assert scan.messages.count() == 0


def test_clean_messages_rules(spark, tmp_path):
    inbox = write_export(tmp_path / "inbox",
        {
            "c": {
                "message_1.json": [
                    ("Alice", "reacted to your message", 1000),
                        ("Alice", "hello", 2000),
                        {"sender_name": "Alice", "content": None, "timestamp_ms": 3},
                        {"sender_name": "Alice", "timestamp_ms": 4},
                        {"sender_name": "Alice", "content": "no time"},
                        {"content": "no sender", "timestamp_ms": 7},
                        ("Robin Hood", "call 555-867-5309", "6.0"),
                ]
            }
        },
    )
    raw = E.read_exports(spark, inbox).messages
    out = U.clean_messages(raw, "Robin")
    got = sorted((r.sender, r.text, r.timestamp) for r in out.collect())
    assert got == [
        ("me", "call [PHONE_NUMBER]", 6),
        ("other", "hello", 2000),
        ("other", "no sender", 7),
        ("other", "no time", 0),
    ]


def test_other_party(spark, tmp_path):
    inbox = write_export(tmp_path / "inbox",
        {
            "a": {"message_1.json": [("Robin", "x1", 1), ("Carol Ann", "x2", 2)]},
            "b": {"message_1.json": [("Robin", "y1", 1)]},
            "c": {"message_1.json": [{"content": "z", "timestamp_ms": 1}]},
        },
    )
    raw = E.read_exports(spark, inbox).messages
    got = {r.conversation: r.other_party for r in U.other_party(raw, "Robin").collect()}
    assert got == {"a": "carolann", "b": "unknown_sender", "c": "other_user"}


def blocks_of(spark, msgs):
    df = spark.createDataFrame(
        [("k", i, s, t, ts) for i, (s, t, ts) in enumerate(msgs)],
        "conversation string, pos int, sender string, text string, timestamp bigint",
    )
    return U.merge_blocks(df, order=["timestamp", "pos"])


def test_merge_blocks_cases(spark):
    b = blocks_of(spark, [("other", "hi", 1000), ("other", "there", 2000)]).collect()
    assert len(b) == 1 and b[0].text == "hi\nthere" and b[0].last_ts == 2000 and b[0].first_ts == 1000
    b = blocks_of(spark, [("other", "  ", 1000), ("other", "ok", 2000), (None, "x", 3), ("other", None, 4)]).collect()
    assert len(b) == 1 and b[0].text == "ok"
    b = blocks_of(spark, [("other", "a", 1000), ("me", "b", 2000), ("other", "c", 3000)]).orderBy("block").collect()
    assert [r.text for r in b] == ["a", "b", "c"]


PAIR_CASES = [
    # (blocks as sender, text, minute of the last message; limit in minutes; kept block numbers)
    ("q a q a q", 30, [1, 3]),
    ("a q a a", 30, [2]),
    ("q q a", 30, [2]),
    ("a a", 30, []),
    ("q@0 a@30 q@40 a@71", 30, [1]),
    ("q@0 a@31", 31, [1]),
    ("q@9 a@2", 1, [1]),  # a reply that is older than its question is within any limit
    ("q! a", 30, []),
    ("q a!", 30, []),
]


@pytest.mark.parametrize(("blocks", "limit", "kept"), PAIR_CASES)
def test_reply_pair_cases(spark, blocks, limit, kept):
    rows = []
    for n, code in enumerate(blocks.split(), 1):
        what, _, minute = code.partition("@")
        text = "?" if what.endswith("!") else f"text {n}"
        rows.append(("k", n, {"q": "other", "a": "me"}[what[0]], text, 0, 60_000 * int(minute or n)))
    df = spark.createDataFrame(rows, "conversation string, block int, sender string, text string, first_ts bigint, last_ts bigint")
    assert sorted(r.block for r in P.reply_pairs(df, ["conversation"], 60_000 * limit).collect()) == kept


def test_default_limit_is_half_a_day():
    assert P.DEFAULT_TIME_GAP_LIMIT == 12 * 60 * 60 * 1000


def test_cleaned_lists_source(spark, tmp_path):
    items = [
        {"sender": "me", "text": "shown last", "timestamp": 30.9},
        {"sender": "other", "text": {"k": [1, "é"]}, "timestamp": "10"},
        {"sender": "other", "timestamp": 20},
        {"sender": "other", "text": True, "timestamp": None},
        {"text": "no time at all"},
        ["a list"], 17, None,
    ]
    folder = tmp_path / "lists"
    (folder / "below").mkdir(parents=True)
    texts = {
        "all kinds+1.json": json.dumps(items), "_under.json": '[{"sender": "me", "text": "u", "timestamp": 1}]',
        ".dot.json": '[{"sender": "me", "text": "d", "timestamp": 1}]', "object.json": json.dumps(items[0]),
        "cut.json": json.dumps(items)[:-9], "tail.json": json.dumps(items) + " trailing", "none.json": "", "a.jsonl": "[]",
        "below/deep.json": json.dumps(items),
    }
    for name, text in texts.items():
        (folder / name).write_text(text, encoding="utf-8")
    scan = C.scan_cleaned_lists(spark, str(folder))
    got = sorted((r.conversation, r.pos, r.sender, r.text, r.timestamp) for r in scan.items.where("has_timestamp").collect())
    assert got[:5] == [
        (".dot.json", 0, "me", "d", 1), ("_under.json", 0, "me", "u", 1), ("all kinds+1.json", 0, "me", "shown last", 30),
        ("all kinds+1.json", 1, "other", '{"k":[1,"é"]}', 10), ("all kinds+1.json", 2, "other", None, 20),
    ]
    bad = sorted((r.path, r.reason) for r in scan.quarantine.collect())
    assert bad == [("cut.json", "NO_JSON_LIST"), ("none.json", "EMPTY_FILE"), ("object.json", "NO_JSON_LIST"), ("tail.json", "NO_JSON_LIST")]
    assert C.scan_cleaned_lists(spark, str(tmp_path / "missing")).items.collect() == []


def test_a_block_without_a_readable_time_loses_its_pairs_only(spark, tmp_path):
    said = [("other", "first question", 1), ("me", "first answer", "soon"), ("other", "second question", 5), ("me", "second answer", 9)]
    (tmp_path / "l").mkdir()
    rows = [dict(zip(("sender", "text", "timestamp"), x)) for x in said]
    (tmp_path / "l" / "a.json").write_text(json.dumps(rows))
    out = job.build_samples(C.read_cleaned_lists(spark, str(tmp_path / "l")), order=["pos"], hot_threshold=None).collect()
    # were the unreadable message dropped, both questions would be one block
    assert [(r.user, r.assistant) for r in out] == [("second question", "second answer")]


def test_secrets_file(spark, tmp_path):
    f = tmp_path / "secrets.json"
    f.write_text(json.dumps({"Alice": "[NAME]", "London": "[CITY]", " ": "[X]", "ALICE": "[N2]"}))
    assert load_secrets(str(f)) == [("alice", "[N2]"), ("london", "[CITY]")]
    assert load_secrets(str(tmp_path / "missing.json")) == []
    assert load_secrets(str(f), spark) == [("alice", "[N2]"), ("london", "[CITY]")]
    assert load_secrets(str(tmp_path / "missing.json"), spark) == []
    assert parse_secrets("not json at all") == []
    assert parse_secrets("[1, 2]") == []
    hidden = tmp_path / ".secrets.json"
    for unusable in ("", "not json at all", "[1, 2]"):
        hidden.write_text(unusable)
        for session in (None, spark):
            with pytest.raises(ValueError):
                load_secrets(str(hidden), session)
    hidden.write_text(f.read_text())
    assert load_secrets(str(hidden), spark) == load_secrets(str(hidden)) == [("alice", "[N2]"), ("london", "[CITY]")]


def test_full_run(spark, tmp_path):
    """Three folders hold one exchange in different words of case and time,
    one exchange is spread over two files, the rest gives no sample."""
    greeting = lambda who, t: [(who, "are you\nat home?", t), ("Robin", "yes, come over", t + 60_000)]
    inbox = write_export(
        tmp_path / "inbox",
        {
            "p": {"message_7.json": greeting("Pia", 5)},
            "q/r": {"message_1.json": greeting("Quentin", 900) + [("Quentin", "changed the theme", 1)]},
            "_s": {"message_1.json": greeting("Sam", 77)},
            "two files": {"message_2.json": [("Robin", "on the Kattegat ferry", 40)], "message_1.json": [("Tove", "where are you", 30)]},
            "late": {"message_1.json": [("Uli", "hello??", 0), ("Robin", "sorry, only now", 43_200_001)]},
            "only noise": {"message_1.json": [("Vic", "missed call", 3)]},
            "no messages": {"message_1.json": []},
            "cut": {"message_1.json": '{"messages": [{"content"'},
            "void": {"message_1.json": ""},
            "clock": {"message_1.json": [("Wim", "when?", "noon"), ("Robin", "later", 5)]},
        },
    )
    (tmp_path / "_words.json").write_text(json.dumps({"kattegat": "[SEA]"}))
    cfg = config(tmp_path, inbox, secrets_path=str(tmp_path / "_words.json"), train_dir=str(tmp_path / "t"), val_dir=str(tmp_path / "v"), val_fraction=0.5, seed=1)
    res = job.run(spark, cfg)
    counts = (res.conversations_processed, res.total_samples, res.valid_samples, res.duplicates_removed, res.malformed_removed)
    assert counts == (7, 4, 2, 2, 0)
    assert (res.train_lines, res.val_lines) == (1, 1) and res.elapsed_seconds > 0
    reasons = sorted(r.reason for r in spark.read.json(cfg.quarantine_dir).collect())
    assert reasons == ["BAD_TIMESTAMP", "CORRUPT_JSON", "EMPTY_FILE"] and res.quarantined_files == 3
    read = lambda status: [json.loads(r.value) for r in spark.read.text(f"{cfg.output_dir}/status={status}").collect()]
    kept = sorted([m["content"] for m in r["messages"]] for r in read("VALID"))
    assert kept == [["are you\nat home?", "yes, come over"], ["where are you", "on the [SEA] ferry"]]
    assert [(r["reason"], [m["role"] for m in r["data"]["messages"]]) for r in read("DUPLICATE")] == [("DUPLICATE", ["user", "assistant"])] * 2


def test_outputs_must_stand_apart(spark, tmp_path):
    inbox = write_export(tmp_path / "inbox", {"a": {"message_1.json": [("Al", "hi", 1)]}})
    before = (tmp_path / "inbox" / "a" / "message_1.json").read_bytes()
    for name, path in (("cleaned_dir", inbox), ("output_dir", inbox + "/a"), ("raw_dir", str(tmp_path)), ("samples_dir", str(tmp_path / "out" / "x"))):
        cfg = config(tmp_path, inbox)
        setattr(cfg, name, path)
        with pytest.raises(ValueError):
            job.run(spark, cfg)
    src = tmp_path / "lines"
    src.mkdir()
    (src / "l.jsonl").write_text('{"messages": []}\n')
    with pytest.raises(ValueError):
        job.validate_jsonl(spark, str(src), str(src))
    for train, val in ((str(src), "v"), ("t", str(src)), ("t", str(src / "v")), ("same", "same")):
        with pytest.raises(ValueError):
            job.split_jsonl(spark, str(src), str(tmp_path / train), str(tmp_path / val))
    assert (src / "l.jsonl").read_text() == '{"messages": []}\n'
    assert (tmp_path / "inbox" / "a" / "message_1.json").read_bytes() == before
    with pytest.raises(ValueError, match="cleaned_dir"):
        job.run(spark, job.JobConfig(my_name="Robin", inbox_dir=inbox, raw_dir=str(tmp_path / "r")))


def test_hidden_folders_at_any_level(spark, tmp_path):
    tree = {p: {"message_1.json": [("Al", p, 1)]} for p in ("_a", ".b", "c/_d", "c/.e/f", "_g/_h/i", "j/k/_l", "m")}
    scan = E.read_exports(spark, write_export(tmp_path / "inbox", tree))
    assert sorted((r.conversation, r.content) for r in scan.messages.collect()) == sorted((p, p) for p in tree)


def test_run_with_hot_conversation(spark, tmp_path):
    msgs = []
    for i in range(60):
        msgs.append(("Alice", f"question {i}", 1000 * i))
        msgs.append(("Robin", f"answer {i}", 1000 * i + 500))
    inbox = write_export(tmp_path / "inbox", {"big": {"message_1.json": msgs}})
    plain = job.run(spark, config(tmp_path, inbox))
    hot_cfg = config(tmp_path, inbox, hot_threshold=10, chunk_rows=13)
    hot_cfg.output_dir = str(tmp_path / "out_hot")
    hot_cfg.samples_dir = str(tmp_path / "samples_hot")
    hot = job.run(spark, hot_cfg)
    assert plain.valid_samples == hot.valid_samples == 60
    a = sorted(spark.read.text(f"{tmp_path}/out/status=VALID").toPandas()["value"])
    b = sorted(spark.read.text(f"{tmp_path}/out_hot/status=VALID").toPandas()["value"])
    assert a == b


def test_generate_dataset_writes_jsonl(spark, tmp_path):
    d = tmp_path / "cleaned"
    d.mkdir()
    for i in range(3):
        (d / f"conv{i}.json").write_text(json.dumps([
            {"sender": "other", "text": f"q{i}", "timestamp": 1000 * i + 1000},
            {"sender": "me", "text": f"a{i}", "timestamp": 1000 * i + 2000},
        ]))
    cleaned = C.read_cleaned_lists(spark, str(d))
    n = job.generate_dataset(spark, cleaned, str(tmp_path / "train"))
    assert n == 3
    for v in spark.read.text(str(tmp_path / "train")).toPandas()["value"]:
        assert "messages" in json.loads(v)


def test_blank_name_rejected(spark, tmp_path):
    with pytest.raises(ValueError):
        job.clean_exports(spark, job.JobConfig(my_name="  "))


def test_ordered_output(spark, tmp_path):
    convs = {
        f"c{i}": {"message_1.json": [("Al", f"q{i} one", 1), ("Robin", f"a{i} one", 2),
                                                   ("Al", f"q{i} two", 3), ("Robin", f"a{i} two", 4)]}
        for i in range(4)
    }
    inbox = write_export(tmp_path / "inbox", convs)
    cfg = config(tmp_path, inbox, ordered=True)
    job.run(spark, cfg)
    files = sorted((tmp_path / "out" / "status=VALID").glob("part-*"))
    lines = [l for f in files for l in f.read_text(encoding="utf-8").splitlines()]
    users = [json.loads(l)["messages"][0]["content"] for l in lines]
    assert users == [f"q{i} {w}" for i in range(4) for w in ("one", "two")]


def test_zero_samples_run(spark, tmp_path):
    inbox = write_export(tmp_path / "inbox", {"solo": {"message_1.json": [("Robin", "only me here", 1)]}})
    cfg = config(tmp_path, inbox)
    res = job.run(spark, cfg)
    assert (res.conversations_processed, res.total_samples, res.valid_samples, res.duplicates_removed) == (1, 0, 0, 0)


def test_equal_timestamps_keep_file_then_position_order(spark, tmp_path):
    # File names sort as strings: message_10.json comes before message_2.json.
    inbox = write_export(tmp_path / "inbox",
        {
            "t": {
                "message_2.json": [("Al", "from two", 5), ("Robin", "reply", 9)],
                "message_10.json": [("Al", "from ten a", 5), ("Al", "from ten b", 5)],
            }
        },
    )
    cleaned = U.clean_messages(E.read_exports(spark, inbox).messages, "Robin")
    blocks = U.merge_blocks(cleaned).orderBy("block").collect()
    assert [b.text for b in blocks] == ["from ten a\nfrom ten b\nfrom two", "reply"]
    assert (blocks[0].first_ts, blocks[0].last_ts, blocks[0].n_messages) == (5, 5, 3)


def test_clean_inbox_and_generate(spark, tmp_path):
    inbox = write_export(tmp_path / "inbox",
        {
            "a": {"message_1.json": [("Al", "question here", 1000), ("Robin", "an answer", 2000)]},
            "b": {"message_1.json": [("Bo", "sent a photo", 1000)]},
        },
    )
    out = str(tmp_path / "cleaned")
    assert job.clean_inbox(spark, "Robin", inbox, out) == 2
    assert job.clean_inbox(spark, "Robin", str(tmp_path / "missing"), str(tmp_path / "c2")) == 0
    assert job.generate_from_cleaned(spark, out, str(tmp_path / "train")) == 1
    assert job.generate_from_cleaned(spark, str(tmp_path / "nope"), str(tmp_path / "t2")) == 0
    line = spark.read.text(str(tmp_path / "train")).first()[0]
    assert json.loads(line) == {"messages": [{"role": "user", "content": "question here"},
                                             {"role": "assistant", "content": "an answer"}]}


def test_generate_from_json_lists_reports_drops(spark, tmp_path, caplog):
    d = tmp_path / "cleaned"
    d.mkdir()
    (d / "a.json").write_text(json.dumps([
        {"sender": "other", "text": "hello", "timestamp": 1000},
        {"sender": "other", "text": "no ts"},
        {"sender": "me", "text": "hi you", "timestamp": 2000},
    ]))
    with caplog.at_level("WARNING"):
        n = job.generate_from_cleaned(spark, str(d), str(tmp_path / "train"), fmt="json")
    assert n == 1
    assert any("1 items without a timestamp" in r.getMessage() for r in caplog.records)


def test_odd_files_are_quarantined_or_kept(spark, tmp_path):
    inbox = write_export(tmp_path / "inbox",
        {
            "mixed": {
                "message_1.json": [("Al", "fine text", 1), "not an object"],
                "message_2.json": [("Al", "second file", 2), ("Al", {"k": "v"}, 3)],
            }
        },
    )
    scan = E.read_exports(spark, inbox)
    got = sorted((r.file_name, r.content) for r in scan.messages.collect())
    # An object-valued content is kept as its JSON text.
    assert got == [("message_2.json", "second file"), ("message_2.json", '{"k":"v"}')]
    assert [r.path.endswith("mixed/message_1.json") for r in scan.quarantine.collect()] == [True]


def test_generate_ordered(spark, tmp_path):
    d = tmp_path / "cleaned"
    d.mkdir()
    for i in (3, 1, 2):
        (d / f"conv{i}.json").write_text(json.dumps([
            {"sender": "other", "text": f"q{i} a", "timestamp": 1}, {"sender": "me", "text": f"r{i} a", "timestamp": 2},
            {"sender": "other", "text": f"q{i} b", "timestamp": 3}, {"sender": "me", "text": f"r{i} b", "timestamp": 4},
        ]))
    out = tmp_path / "train"
    assert job.generate_from_cleaned(spark, str(d), str(out), fmt="json", ordered=True) == 6
    lines = [l for f in sorted(out.glob("part-*")) for l in f.read_text(encoding="utf-8").splitlines()]
    assert [json.loads(l)["messages"][0]["content"] for l in lines] == [f"q{i} {w}" for i in (1, 2, 3) for w in "ab"]


def test_full_run_agrees_with_conv_samples(spark, tmp_path):
    import bench
    from conftest import SF01
    from dialogprep.plans.queries import q_conv_samples

    bench.export_inbox(spark, SF01, str(tmp_path / "inbox"))
    cfg = config(tmp_path, str(tmp_path / "inbox"), message_glob="part-*.json")
    cfg.my_name = "assistant"
    res = job.run(spark, cfg)
    expected = sorted((r.user, r.assistant) for r in q_conv_samples(spark, SF01).collect())
    kept = [json.loads(v)["messages"] for v in spark.read.text(f"{cfg.output_dir}/status=VALID").toPandas()["value"]]
    got = sorted((m[0]["content"], m[1]["content"]) for m in kept)
    assert res.total_samples == len(expected) and res.conversations_processed == 100
    assert got == sorted(set(expected)) and res.duplicates_removed == len(expected) - len(set(expected))
