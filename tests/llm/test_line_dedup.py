"""Line de-duplication against a plain model, on both routes."""

from collections import Counter

from dialogprep.llm.line_dedup import dedup_lines

SPACE = " \t\n\x0b\x0c\r"
ODD = [None, "", "\n", " Same line \nOwn a", "same line\nown B\n\n", "\x0bSAME LINE\x0c\nx", "É\né\nx ", "x" * 100_000 + "\nsame LINE",
       "same line", "same line", "x\nx\nx"]


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def model(texts, min_docs, min_chars=1, classes=None):
    """``classes[i]``: the class text ``i`` counts in (its own by default)."""
    held = {(key(x), classes[i] if classes else i) for i, t in enumerate(texts) for x in (t or "").split("\n")}
    found = Counter(k for k, _ in held)
    bad = {k for k, n in found.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in bad]
        out.append("\n".join(kept))
    return out


def test_both_routes_equal_the_model(spark):
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(ODD)], "doc_id long, text string, n_lines int")
    for min_docs, min_chars in ((3, 1), (2, 1), (2, 2), (100, 1)):
        want = model(ODD, min_docs, min_chars)
        for bound in (2_000_000, 0):
            got = {r.doc_id: r for r in dedup_lines(df, min_docs, min_chars, max_broadcast=bound).collect()}
            assert [got[i].text for i in range(len(ODD))] == want
            assert all(got[i].n_lines == len((t or "").split("\n")) for i, t in enumerate(ODD))
            assert all(got[i].n_dropped >= 0 for i in got)


def test_near_copies_count_once_and_shared_lines_go_everywhere(spark):
    import corpus_pipeline as C

    shared = "a long shared passage of boilerplate words"
    body = "\n".join(f"line {k} of a text that was copied and then changed at its end" for k in range(5))
    texts = [f"{shared}\nown {i} " + " ".join(f"w{i * 40 + k}" for k in range(20)) for i in range(12)]
    texts += ["copied one\nCopied two"] * 15 + [f"{body}\nchanged {i}" for i in range(12)] + [None, "", "copied one\nx"]
    classes = [*range(12), *[12] * 15, *[13] * 12, 14, 15, 16]
    want = model(texts, 10, classes=classes)
    assert want[0].startswith("own 0") and want[12] == texts[12] and want[30] == texts[30]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).checkpoint()
    for bound in (2_000_000, 0):
        got = {r.doc_id: r.text for r in dedup_lines(df, 10, max_broadcast=bound, classes=C._groups).collect()}
        assert [got[i] for i in range(len(texts))] == want
    docs = df.selectExpr("doc_id", "text", "'en' lang", "'s1' source", "1L n_chars")
    left = C.line_dedup(spark, docs, "")
    assert {r.doc_id: r.text for r in left.collect()} == dict(enumerate(want))
    # one whole document of each group of copies is there in the end
    kept = {r.doc_id: r.text for r in C.near_dedup(spark, left.checkpoint(), "").collect()}
    assert kept[12] == texts[12] and kept[27] == texts[27] and not set(kept) & {*range(13, 27), *range(28, 39)}


def test_empty_table_and_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "lang", "n_lines", "n_dropped"] and out.collect() == []
