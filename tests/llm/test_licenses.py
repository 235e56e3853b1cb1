"""License scan against a plain model over all lines, and inheritance."""

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from dialogprep.llm.licenses import TEMPLATES, needed_terms, scan_licenses, template_terms, unit_vectors

ROWS = [
    (1, "a/b/LICENSE", "Some text\nLicensed under the Apache License, Version 2.0."),
    (2, "a/b/x.txt", "nothing here\nat all the under version"),
    (3, "a/b/c/d/y.txt", None),
    (4, "a/b/c/z.txt", "MIT\nReleased under the MIT License\nmore"),
    (5, "a/LICENSE", "licensed under CC BY-NC 4.0"),
    (6, "a/q/w.txt", ""),
    (7, "top.txt", "license " * 500),
    (8, None, "This work is licensed under the GNU General Public License, version 3."),
    (9, "z/LICENSE", "no notice"),
    (10, "z/p.txt", "Licensed under CC BY 4.0\nLicensed under CC BY-SA 4.0"),
    (10, "z/p.txt", "Licensed under CC BY 4.0\nLicensed under CC BY-SA 4.0"),
    (11, "a/b2/k.txt", "é ï LICENSED UNDER cc-by-nc 4.0 ß"),
]


def plain(rows, threshold=0.7):
    words = lambda t: re.findall("[a-z0-9]+", (t or "").lower())
    n = len(rows)
    df = Counter(w for _, _, t in rows for w in set(words(t)))
    templates = template_terms(TEMPLATES)
    vocabulary = set().union(*templates)
    idf = lambda w: math.log((1 + n) / (1 + (df[w] if w in vocabulary else 0))) + 1
    own = []
    for _, _, t in rows:
        best = []
        for line in (t or "").split("\n"):
            x = {w: c * idf(w) for w, c in Counter(words(line)).items()}
            for (name, _), counts in zip(TEMPLATES, templates):
                y = {w: c * idf(w) for w, c in counts.items()}
                norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
                s = sum(v * y.get(w, 0) for w, v in x.items()) / norm if norm else 0
                if round(s, 6) >= threshold:
                    best.append((-round(s, 6), name))
        own.append(min(best, default=None))
    dirs = {}
    for (_, path, _), o in zip(rows, own):
        if o and (path or "").endswith("LICENSE"):
            d = path.rpartition("/")[0]
            dirs[d] = min(dirs.get(d, o), o)
    out = []
    for (i, path, _), o in zip(rows, own):
        license_, where = (o[1], None) if o else (None, None)
        d = (path or "").rpartition("/")[0]
        while not license_:
            if d in dirs:
                license_, where = dirs[d][1], d
            if not d:
                break
            d = d.rpartition("/")[0]
        out.append((i, path or "", o[1] if o else None, -o[0] if o else None, license_, where))
    return sorted(out, key=repr)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, p, t, "x") for i, p, t in rows], "doc_id long, p string, text string, license string").repartition(3)
    out = scan_licenses(df, F.col("p"), F.col("path").endswith("LICENSE"), **more)
    return sorted(map(tuple, out.select("doc_id", "path", "own_license", "own_score", "license", "license_dir").collect()), key=repr)


def test_equals_the_model(spark):
    assert run(spark, ROWS) == plain(ROWS)
    assert run(spark, ROWS, max_broadcast=0) == plain(ROWS)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_lines_without_needed_terms_cannot_reach_the_threshold():
    idf = {t: 1 + (len(t) % 5) for t in set().union(*template_terms(TEMPLATES))}
    vectors = unit_vectors(TEMPLATES, idf)
    needed = set(needed_terms(vectors, idf, 0.7))
    for v in vectors:
        assert math.sqrt(sum(w * w for t, w in v.items() if t not in needed)) < 0.7


def test_common_words_beside_a_notice_and_wrapped_notices(spark):
    common = "then they went home again"
    rows = [(i, f"d{i}/x", f"{common} {i}") for i in range(500)]
    rows += [
        (1000, "p/x", f"{common}. Released under the MIT License"),
        (1001, "q/x", "code\nThis work is licensed\nunder the GNU General\nPublic License,\nversion 3\ncode"),
        (1002, "r/x", "Permission is hereby granted,\nfree of charge, to any\nperson obtaining\na copy of\nthis\nsoftware"),
    ]
    got = {r[0]: r for r in map(tuple, run_plain_rows(spark, rows))}
    assert [got[i][1] for i in (1000, 1001, 1002)] == ["MIT", "GPL-3.0", "MIT"]
    assert got[1000][2] > 0.9 and got[1001][2] == 1.0 and got[1002][2] == 1.0
    assert all(got[i][1] is None for i in range(500))


def run_plain_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, p string, text string").repartition(3)
    return scan_licenses(df, F.col("p"), F.lit(False)).select("doc_id", "own_license", "own_score").collect()


def test_clashing_columns_and_very_long_text(spark):
    names = ("_license", "_license_dir", "_row", "_dir", "_file", "Unit", "term")
    long = "nothing to see in this line\n" * 8000
    rows = [(1, "a/LICENSE", "Released under the MIT License"), (2, "a/b/x", "code"), (3, "c/x", long + "Licensed under CC BY 4.0\n" + long), (4, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, p string, text string").withColumns({c: F.lit(f"own {c}") for c in names})
    out = scan_licenses(df, F.col("p"), F.col("path").endswith("LICENSE"))
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[i][c] == f"own {c}" for i in got for c in names)
    assert [(got[i].own_license, got[i].license, got[i].license_dir) for i in (1, 2, 3, 4)] == [
        ("MIT", "MIT", None), (None, "MIT", "a"), ("CC-BY-4.0", "CC-BY-4.0", None), (None, None, None),
    ]
