"""Hierarchical budgets and epoch prefixes against a recursive model."""

import hashlib
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from dialogprep.llm.mixing import Mix, first_tokens, leaf_plan, mixed

LEVELS = ("domain", "lang", "source")


def share(budget, children):
    """Integer shares of ``(name, cap, weight)``: raise a common level until
    the budget is used up, closing children that are full."""
    order = sorted(children, key=lambda c: (Fraction(c[1], c[2]) if c[2] else Fraction(10**30), c[0]))
    out, room, weight = {}, budget, sum(c[2] for c in order)
    for k, (name, cap, w) in enumerate(order):
        if w == 0 or cap * weight <= w * room:
            out[name] = cap
            room, weight = room - cap, weight - w
            continue
        done = 0
        for n, _, v in order[k:]:
            out[n] = room * (done + v) // weight - room * done // weight
            done += v
        break
    return out


def model(rows, mix):
    row_hash = lambda i, t: hashlib.md5(f"{'' if i is None else i}:{t or ''}".encode()).hexdigest()
    docs = [(i, tuple(x or "" for x in path), len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), row_hash(i, t)) for i, t, *path in rows]
    docs = [d for d in docs if d[2]]
    tokens = {}
    for _, path, n, _ in docs:
        tokens[path] = tokens.get(path, 0) + n
    w = lambda path: mix.weights.get(path, mix.default_weight)
    cap = {p: n * mix.max_epochs * all(w(p[: i + 1]) > 0 for i in range(3)) for p, n in tokens.items()}
    supply = lambda head: sum(c for p, c in cap.items() if p[: len(head)] == head)
    budget = mix.budget_tokens if mix.budget_tokens is not None else sum(tokens.values()) * mix.percent // 100
    budgets = {(): min(budget, supply(()))}
    for depth in range(3):
        for head in [h for h in budgets if len(h) == depth]:
            kids = sorted({p[: depth + 1] for p in cap if p[:depth] == head})
            budgets |= {head + (n,): b for n, b in share(budgets[head], [(k[-1], supply(k), w(k)) for k in kids]).items()}
    taken = []
    for path, total in tokens.items():
        left, epoch = budgets[path], 0
        while left > 0:
            own = [d for d in docs if d[1] == path]
            key = lambda d: hashlib.md5(f"{mix.seed}:{epoch}:{d[3]}".encode()).hexdigest()  # noqa: B023, E731
            for k in sorted({key(d) for d in own}):
                ties = [d for d in own if key(d) == k]
                give = min(left, sum(d[2] for d in ties))
                each = ties[0][2] if give == sum(d[2] for d in ties) else give // len(ties)
                taken += [(str(d[0]), path, epoch, d[2], each) for d in ties if each]
                left -= give
                if not left:
                    break
            epoch += 1
    return sorted(taken), {p: budgets[p] for p in tokens}


def fixture():
    rows = []
    for i in range(300):
        d, lang, s = "ab"[i % 5 == 0], ["en", "de", None][i % 3], f"s{i % 7}"
        rows.append((i, "w " * (1 + i * 7 % 13) + "\n", d, lang, s))
    rows += [(1000 + i, "hot source text " * 5, "a", "en", "s1") for i in range(150)]
    rows += [(5, "tie tie tie", "a", "en", "s1")] * 3 + [(None, "x y", "c", "xx", None), (7, None, "a", "en", "s2"), (8, " \n", "d", "d", "d")]
    return rows


@pytest.mark.parametrize(
    "mix",
    [
        Mix(LEVELS, {("a",): 1, ("b",): 9, ("a", "en"): 3}, percent=70, max_epochs=1),  # b and its siblings run short
        Mix(LEVELS, {("a",): 0, ("b", "en", "s0"): 50}, percent=50, max_epochs=3),
        Mix(LEVELS, {}, budget_tokens=10**9, max_epochs=2),
        Mix(LEVELS, {}, budget_tokens=0),
        Mix(LEVELS, {("b",): 100}, budget_tokens=777, max_epochs=4, max_broadcast=0),
    ],
)
def test_equals_the_model(spark, mix):
    rows = fixture()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, domain string, lang string, source string, epoch int, budget int")
    want, budgets = model(rows, mix)
    plan = leaf_plan(df.drop("epoch", "budget"), mix).collect()
    assert {(r._1, r._2, r._3): r.budget for r in plan} == budgets
    got = mixed(df.repartition(4), mix)
    assert [c for c in got.columns if c in ("doc_id", "text", "domain", "lang", "source")] == ["doc_id", "text", "domain", "lang", "source"]
    found = sorted((str(r.doc_id), (r.domain or "", r.lang or "", r.source or ""), r.epoch, r.n_tokens, r.take_tokens) for r in got.collect())
    assert found == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, domain string, lang string, source string")
    assert mixed(df, Mix(LEVELS, {})).collect() == []


def test_first_tokens(spark):
    rows = spark.createDataFrame([(" a  b\tc\n", 2), ("é  x y", 1), ("a", 5), ("a b", 0)], "t string, n long")
    got = [r[0] for r in rows.select(first_tokens(F.col("t"), F.col("n"))).collect()]
    assert got == [" a  b", "é", "a", ""]


def test_input_columns_of_any_name_are_kept(spark):
    rows = fixture()
    names = ("tokens", "budget", "epochs", "cut_key", "cut_tokens", "_row", "_1", "_input", "want")
    plain = spark.createDataFrame(rows, "doc_id long, text string, domain string, lang string, source string")
    df = plain.withColumns({c: F.lit(f"own {c}") for c in names}).withColumn("epoch", F.lit("replaced"))
    mix = Mix(LEVELS, {("b",): 9}, percent=70)
    got = mixed(df.repartition(3), mix)
    assert got.columns == [*plain.columns, *names, "epoch", "n_tokens", "take_tokens"]
    kept = got.collect()
    assert all(r[c] == f"own {c}" for r in kept for c in names)
    of = ("doc_id", "text", "epoch", "n_tokens", "take_tokens")
    assert sorted(map(repr, (tuple(r[c] for c in of) for r in kept))) == sorted(
        map(repr, (tuple(r[c] for c in of) for r in mixed(plain, mix).collect()))
    )


def test_very_long_text(spark):
    df = spark.createDataFrame([(1, "word " * 60_000, "a", "en", "s"), (2, "a b", "a", "en", "t")], "doc_id long, text string, domain string, lang string, source string")
    got = {r.doc_id: r.n_tokens for r in mixed(df, Mix(LEVELS, {}, percent=100, max_epochs=1)).collect()}
    assert got == {1: 60_000, 2: 2}
