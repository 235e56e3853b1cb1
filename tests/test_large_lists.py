"""Lists cut into items equal lists parsed whole, wherever ranges end."""

import json
import random

import pytest

from dialogprep.sources import cleaned as C

LISTS = {
    "turns": [{"sender": "me", "text": f'x, "y" [z] {{q}} \\ é {i}', "timestamp": i} for i in range(200)],
    "none": [], "nested": [1, [2, [3, {"a": [4]}]], "s,t", None, True, {"timestamp": 5, "text": ["l", {"k": "],"}]}],
    "one": [[]], "marks": ["\\", '"', ",", "[{", '\\"', '\\\\",'],
}
RAW = {
    "open": "[1,2", "comma after": "[1],", "comma in": "[1,]", "tail": "[1] x", "object": '{"a":[1]}', "two": "[1],[2]",
    "spaces": " [ 1 , 2 ] \n", "string": '["a,b]', "comma first": "[,1]", "mark": "﻿[1]", "blank list": "[ ]", "no comma": "[1 2]",
    "escaped end": '["a\\", 1]', "closed twice": "[]]", "backslash": "\\[1]", "_hidden": '[{"timestamp":1},2]', "text": '"a"', "blank": " ",
}


def scan(spark, folder, monkeypatch, limit):
    monkeypatch.setattr(C, "WHOLE_BYTES", limit)
    found = C.scan_cleaned_lists(spark, str(folder))
    return sorted(map(repr, found.items.collect())), sorted(map(repr, found.quarantine.collect())), found.has_large


@pytest.mark.parametrize("range_bytes", ["64", "300", "1m"])
def test_cut_lists_equal_whole_ones(spark, tmp_path, monkeypatch, range_bytes):
    for name, items in LISTS.items():
        for indent in (None, 2):
            (tmp_path / f"{name}{indent}.json").write_text(json.dumps(items, indent=indent), encoding="utf-8")
    for name, text in RAW.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    rng = random.Random(range_bytes)
    base = json.dumps(LISTS["nested"] + LISTS["marks"])
    for k in range(12):  # damaged at random
        at = rng.randrange(len(base))
        (tmp_path / f"damaged{k}.json").write_text(base[:at] + rng.choice(['"', "\\", ",", "]", "{", ""]) + base[at + 1 :], encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
    try:
        whole = scan(spark, tmp_path, monkeypatch, 1 << 25)
        cut = scan(spark, tmp_path, monkeypatch, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole[:2] == cut[:2] and len(whole[0]) > 400 and len(whole[1]) > 10
    assert (whole[2], cut[2]) == (False, True)


def test_a_list_that_spark_cannot_parse_whole(spark, tmp_path):
    """Over 128 MB, in one line."""
    n, said = 20_000, "some words " * 650
    with open(tmp_path / "long.json", "w") as f:
        f.write("[")
        f.writelines(("," if i else "") + json.dumps({"sender": "me", "text": said, "timestamp": i}) for i in range(n))
        f.write("]")
    (tmp_path / "short.json").write_text('[{"sender": "other", "text": "hi", "timestamp": 7}]')
    assert (tmp_path / "long.json").stat().st_size > 128 << 20
    found = C.scan_cleaned_lists(spark, str(tmp_path))
    rows = found.items.groupBy("conversation").agg({"timestamp": "sum", "pos": "max", "*": "count"}).collect()
    got = {r.conversation: (r["count(1)"], r["max(pos)"], r["sum(timestamp)"]) for r in rows}
    assert got == {"long.json": (n, n - 1, n * (n - 1) // 2), "short.json": (1, 0, 7)}
    assert found.quarantine.collect() == []
