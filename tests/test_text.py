"""Text rules as Spark columns, checked case by case and against Python."""

import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from dialogprep.functions import text as T


def evaluate(spark, col_fn, values):
    """Apply a Column function to a list of strings; return the results."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    out = df.select("i", col_fn(F.col("t")).alias("o")).orderBy("i").collect()
    return [r["o"] for r in out]


def scrub_one(spark, value, **kw):
    return evaluate(spark, lambda c: T.scrub(c, **kw), [value])[0]


# -- noise -------------------------------------------------------------------


def test_every_phrase_drops_in_any_case_and_place(spark):
    phrases = T.noise_phrases()
    assert len(phrases) == 17
    framed = [f"<<{p.upper() if i % 2 else p}>> and more" for i, p in enumerate(phrases)]
    assert evaluate(spark, lambda c: T.scrub(c), framed) == [None] * 17
    # one letter less, and the phrase is another word
    near = [p[:-1] + "#" for p in phrases]
    kept = evaluate(spark, lambda c: T.is_noise(c), near)
    assert not any(kept)


def test_substrings_count(spark):
    assert evaluate(spark, lambda c: T.scrub(c), ["they overreacted", "a plain line"]) == [None, "a plain line"]


def test_empty_and_null_dropped(spark):
    assert evaluate(spark, lambda c: T.scrub(c), ["", None]) == [None, None]


def test_length_bounds(spark):
    out = evaluate(spark, lambda c: T.scrub(c), ["x", "ok", "a" * 1000, "a" * 1001])
    assert out == [None, "ok", "a" * 1000, None]


def test_custom_length_bounds(spark):
    out = evaluate(spark, lambda c: T.scrub(c, min_length=5, max_length=50), ["hi", "hello", "x" * 51])
    assert out == [None, "hello", None]


def test_length_measured_before_redaction(spark):
    # 11 characters before, longer after the phone token: kept.
    assert scrub_one(spark, "555-867-530", max_length=11) == "[PHONE_NUMBER]"


def test_phone_redaction(spark):
    token = "[PHONE_NUMBER]"
    cases = {
        "ring 0171 2345 678!": f"ring {token}!",
        "+1(212)5550100": token,
        "10000 steps": f"{token} steps",
        "room 4711, floor 9": "room 4711, floor 9",
        "a1b2c3d4e5": "a1b2c3d4e5",
    }
    assert evaluate(spark, lambda c: T.scrub(c), list(cases)) == list(cases.values())


def test_phone_pattern_eats_date_part(spark):
    assert evaluate(spark, T.redact_phones, ["at 2024-01-15 10:30"]) == ["at [PHONE_NUMBER]:30"]
    assert evaluate(spark, T.redact_phones, ["(555) 123 4567"]) == ["([PHONE_NUMBER]"]


def test_secret_replacement(spark):
    secrets = [("anna-lena", "<P1>"), ("osnabrück", "<T>"), ("p1", "<again>")]
    said = ["ANNA-LENA left Osnabrück", "anna lena stays", "Anna-LenaAnna-Lena"]
    want = ["<<again>> left <T>", "anna lena stays", "<<again>><<again>>"]
    assert evaluate(spark, lambda c: T.scrub(c, secrets=secrets), said) == want


def test_secrets_are_literal_and_sequential(spark):
    secrets = [("a.b", "$1\\x"), ("$1", "[D]")]
    # '.' is not a wildcard; '$1' and '\\' in tokens are literal; the second
    # entry sees the first entry's output.
    assert evaluate(spark, lambda c: T.replace_secrets(c, secrets), ["aXb a.b A.B"]) == ["aXb [D]\\x [D]\\x"]


def test_secrets_unicode_case(spark):
    assert evaluate(spark, lambda c: T.replace_secrets(c, [("émile", "[N]")]), ["ÉMILE et Émile"]) == ["[N] et [N]"]


def test_long_lists_of_secrets_equal_the_chain(spark, monkeypatch):
    secrets = [(f"{a}{b}{i % 7}", f"[{i}$1\\]") for i, (a, b) in enumerate(itertools.product(("anna ", "an", "ann\\", "é.ü", "\\E|x"), "abcdefgh"))]
    secrets += [("[3", "<again>"), ("anna", "<short>"), ("k", "<kelvin>"), ("😀😀", "<two>")]
    said = ["", None, "nothing to hide", "Anna A0 and ANNA b1, ANA0", "É.ÜB3 x\\e|XA4 ann\\A2", "😀 😀😀😀", "\u212a", "an an\\ anna"] + [
        f"{t.upper()} {u}" for (t, _), (u, _) in zip(secrets, secrets[7:])
    ]
    assert len(secrets) > T.CHAINED_SECRETS
    assert T._any_regex(["b", ""]) == "(?iu)"
    folded = evaluate(spark, lambda c: T.replace_secrets(c, secrets), said)
    monkeypatch.setattr(T, "CHAINED_SECRETS", 1000)
    assert folded == evaluate(spark, lambda c: T.replace_secrets(c, secrets), said)
    assert folded[:3] == ["", None, "nothing to hide"] and folded != said


def test_thousands_of_secrets(spark):
    secrets = [(f"person number {i};", f"<{i}>") for i in range(5000)]
    said = ["Person Number 4999; met person number 17;", "no such person number"] * 20
    assert evaluate(spark, lambda c: T.replace_secrets(c, secrets), said) == ["<4999> met <17>", "no such person number"] * 20
    got = evaluate(spark, lambda c: T.scrub(c, secrets=secrets), ["we saw person number 1234; at the lake"])
    assert got == ["we saw <1234> at the lake"]


def test_secret_with_quote_end_marker(spark):
    assert evaluate(spark, lambda c: T.replace_secrets(c, [("a\\eb", "[X]")]), ["za\\Eb"]) == ["z[X]"]


def test_mojibake_repaired_exactly(spark):
    mangled = "café".encode("utf-8").decode("latin-1")
    out = evaluate(spark, T.repair_mojibake, [mangled, "Hello 🙂 world", "hello world", "éx"])
    assert out == ["café", "Hello 🙂 world", "hello world", "éx"]


def test_mojibake_then_strip_then_length(spark):
    # "Ã©" repairs to one character: dropped by the 2-character minimum.
    assert scrub_one(spark, "Ã©") is None


def test_unicode_strip(spark):
    ws = "　 \x1c\x85\xa0 \t"
    out = evaluate(spark, T.py_strip, [ws + "hi" + ws, "​hi​"])
    assert out == ["hi", "​hi​"]


def test_extra_noise(spark):
    out = evaluate(spark, lambda c: T.scrub(c, extra_noise=["Custom Noise"]), ["some custom noise here", "fine"])
    assert out == [None, "fine"]


def test_sender_normalization(spark):
    out = evaluate(spark, lambda c: T.normalize_sender(c, "Robin"), ["Robin Sharma", "Robin", "Alice", "", None])
    assert out == ["me", "me", "other", "other", "other"]


def test_blank_name_rejected():
    with pytest.raises(ValueError):
        T.normalize_sender("x", "   ")
    with pytest.raises(ValueError):
        T.normalize_sender("x", "")


def test_party_handle(spark):
    out = evaluate(spark, T.party_handle, ["Alice Jones", "Carol", "!!!", None, "JÃ©rÃ´me"])
    assert out == ["alicejones", "carol", "other_user", None, "jrme"]


# -- randomized checks against Python written from the rules -------------------

ALPHABET = list("ab 1234567890-+()") + ["　", "٠", "१", "\x1c", "\xa0", "​", "\n", "\t", "é", "🙂"]
PHONE_PY = re.compile(T.PHONE_PATTERN_PY)


def _random_strings(seed, n=400, max_len=24):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, max_len))) for _ in range(n)]


def test_strip_matches_python(spark):
    values = _random_strings(1)
    assert evaluate(spark, T.py_strip, values) == [v.strip() for v in values]


def test_phone_matches_python(spark):
    values = _random_strings(2)
    expected = [PHONE_PY.sub(T.PHONE_TOKEN, v) for v in values]
    assert evaluate(spark, T.redact_phones, values) == expected


def test_length_matches_python(spark):
    values = _random_strings(3)
    out = evaluate(spark, lambda c: F.length(c), values)
    assert out == [len(v) for v in values]


def _mojibake_py(text):
    try:
        return text.encode("latin1").decode("utf-8")
    except (UnicodeEncodeError, UnicodeDecodeError):
        return text


def test_mojibake_matches_python(spark):
    rnd = random.Random(4)
    pool = ["é", "ü", "🙂", "ñ", "a", "€", "ß"]
    originals = ["".join(rnd.choice(pool) for _ in range(rnd.randint(1, 6))) for _ in range(200)]
    values = [o.encode("utf-8").decode("latin-1") for o in originals]
    values += ["".join(rnd.choice(["\xc3", "\xa9", "\xe2", "a", "\x82", "\xac"]) for _ in range(5)) for _ in range(200)]
    values += originals
    assert evaluate(spark, T.repair_mojibake, values) == [_mojibake_py(v) for v in values]


def test_sender_repair_option(spark):
    mangled = "José".encode("utf-8").decode("latin-1")
    assert evaluate(spark, lambda c: T.normalize_sender(c, "José"), [mangled]) == ["other"]
    assert evaluate(spark, lambda c: T.normalize_sender(c, "José", repair=True), [mangled]) == ["me"]


def test_empty_token_can_empty_a_message(spark):
    out = evaluate(spark, lambda c: T.scrub(c, secrets=[("secret words", "")]), ["  Secret Words ", "keep secret words here"])
    assert out == [None, "keep  here"]


def test_staged_scrub_equals_column_scrub(spark):
    from conftest import SF01

    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    secrets = [("license", "[L]"), ("token", "[T]")]
    plain = docs.select("doc_id", T.scrub("text", secrets, ["###"]).alias("s")).where("s IS NOT NULL")
    staged = T.scrub_staged(docs, "text", "s", secrets, ["###"]).select("doc_id", "s")
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, staged.collect()))
