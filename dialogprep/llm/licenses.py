"""License scan with directory inheritance (operator 4).

Every line of every whole text is a possible notice, and so is every group
of up to ``GROUP`` lines in a row, the head (the first ``HEAD`` lines) and
the text as a whole, for notices that are wrapped. These units and the
templates are sparse TF-IDF vectors; the document frequencies are counted
over the whole corpus, for all its terms. A unit takes the license of the
template with the largest cosine if that reaches ``threshold``; a document
takes its best unit's.

Few units have to be scored: terms are set aside per template, rarest first,
until what remains of the template's unit vector is shorter than the
threshold. By Cauchy-Schwarz a unit with none of the terms set aside can't
reach it, so one pattern test passes over all other texts, and only groups
around lines with such a term are formed.

Licence files stand for their directory. A document without a notice of its
own inherits from the nearest directory above it that has a licence file:
each directory is joined with its ancestors' paths once, and documents are
joined with their directory, not with paths one by one.

Defined results: null and empty texts have no notice; a null path is the
root's file; equal scores go to the license first by name; several licence
files in a directory: the best score, then the first by name; repeated rows
are judged alike; an empty table gives no rows; other columns are kept,
but for ``text`` and those of the result's names. Whole texts are searched,
very long ones too.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import broadcast_if_small, checkpointed

# Common notices of public licenses.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "Subject to the terms of the Mozilla Public License, version 2.0"),
)

GROUP, HEAD = 5, 30  # lines


def template_terms(templates) -> list[Counter]:
    return [Counter(re.findall("[a-z0-9]+", notice.lower())) for _, notice in templates]


def terms(text: Column) -> Column:
    """Runs of a-z and 0-9 of the lower-cased text."""
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``term, df`` of all terms: distinct per document, then partial sums."""
    found = docs.select(F.explode(F.array_distinct(terms(F.col("text")))).alias("term"))
    return found.groupBy("term").agg(F.count("*").alias("df"))


def unit_vectors(templates, idf: dict[str, float]) -> list[dict[str, float]]:
    out = []
    for counts in template_terms(templates):
        size = math.sqrt(sum((c * idf[t]) ** 2 for t, c in counts.items()))
        out.append({t: c * idf[t] / size for t, c in counts.items()})
    return out


def needed_terms(vectors: list[dict[str, float]], idf: dict[str, float], threshold: float) -> list[str]:
    """Terms of which a unit must have one to reach the threshold."""
    needed: set[str] = set()
    for vector in vectors:
        for term in sorted(vector, key=lambda t: (-idf[t], t)):
            if math.sqrt(sum(w * w for t, w in vector.items() if t not in needed)) < threshold * 0.999:
                break
            needed.add(term)
    return sorted(needed)


def units(text: Column, lines: Column, has_needed: str) -> Column:
    """The lines with a needed term, the groups of up to ``GROUP`` lines with
    such a line, the head and the whole, each text once. ``lines`` has to be
    a plain column: lambdas evaluate what they use for each element."""
    last = F.size(lines) - 1
    hits = F.array_compact(F.transform(lines, lambda x, i: F.when(x.rlike(has_needed), i)))
    spans = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.array(*[
        F.struct(F.greatest(i - before, F.lit(0)).alias("first"), F.least(i - before + size - 1, last).alias("last"))
        for size in range(1, GROUP + 1) for before in range(size)
    ]))))
    groups = F.transform(spans, lambda x: F.array_join(F.slice(lines, x["first"] + 1, x["last"] - x["first"] + 1), "\n"))
    return F.array_distinct(F.concat(groups, F.array(F.array_join(F.slice(lines, 1, HEAD), "\n"), text)))


def own_licenses(docs: DataFrame, key: str, templates, threshold: float, max_broadcast: int) -> DataFrame:
    """``key, own_license, own_score`` of the documents with a notice."""
    n = docs.count()
    df = checkpointed(document_frequencies(docs))
    vocabulary = sorted(set().union(*template_terms(templates)))
    found = {r["term"]: r["df"] for r in df.where(F.col("term").isin(vocabulary)).collect()}  # a row per template term at most
    idf = {t: math.log((1 + n) / (1 + found.get(t, 0))) + 1 for t in vocabulary}
    vectors = unit_vectors(templates, idf)
    # as whole terms: "nc" or "mit" inside a word is none
    has_needed = f"(?iu)(?<![a-z0-9])(?:{'|'.join(needed_terms(vectors, idf, threshold))})(?![a-z0-9])"
    spark = docs.sparkSession
    weights = F.broadcast(  # a row per term of a template
        spark.createDataFrame(
            [(t, i, templates[i][0], w) for i, v in enumerate(vectors) for t, w in v.items()],
            "term string, template int, license string, weight double",
        )
    )
    texts = docs.where(F.col("text").rlike(has_needed)).withColumn("lines", F.split("text", "\n"))
    counts = (
        texts.select(key, F.posexplode(units(F.col("text"), F.col("lines"), has_needed)).alias("unit", "notice"))
        .select(key, "unit", F.explode(terms(F.col("notice"))).alias("term"))
        .groupBy(key, "unit", "term").agg(F.count("*").alias("tf"))
    )
    weighed = (F.col("tf") * (F.log(F.lit(1.0 + n) / (1 + F.col("df"))) + 1)).alias("x")
    entries = checkpointed(counts.join(broadcast_if_small(df, max_broadcast), "term").select(key, "unit", "term", weighed))
    size = entries.groupBy(key, "unit").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("size"))
    dots = entries.join(weights, "term").groupBy(key, "unit", "template", "license").agg(F.sum(F.col("x") * F.col("weight")).alias("dot"))
    scored = dots.join(size, [key, "unit"]).select(key, "license", F.round(F.col("dot") / F.col("size"), 6).alias("score"))
    best = scored.where(F.col("score") >= threshold).groupBy(key).agg(F.min(F.struct(-F.col("score"), "license")).alias("b"))
    return best.select(key, F.col("b.license").alias("own_license"), (-F.col("b.col1")).alias("own_score"))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of ``df`` has them."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name in taken:
            name += "_"
        out.append(name)
    return out


def _above(path: Column) -> Column:
    """The directory of a path, '' at the top."""
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def scan_licenses(
    docs: DataFrame,
    path: Column,
    is_licence_file: Column,
    templates=TEMPLATES,
    threshold: float = 0.7,
    max_broadcast: int = 200_000,
) -> DataFrame:
    """``docs`` (without the text) with ``path, own_license, own_score,
    license, license_dir``.

    ``license`` is the document's own or else the inherited one, which
    ``license_dir`` names the directory of. ``is_licence_file`` may use
    ``own_license`` and ``own_score``.
    """
    made = ["path", "own_license", "own_score", "license", "license_dir", "text"]
    columns = [f"`{c}`" for c in docs.columns if c.lower() not in made]
    row, folder, is_file, above_license, above_dir = unused(docs, "_row", "_dir", "_file", "_license", "_license_dir")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.withColumn("path", F.coalesce(path.cast("string"), F.lit(""))).withColumn("text", text)
    rows = rows.withColumn(row, F.md5("text")).drop("own_license", "own_score")
    own = checkpointed(own_licenses(rows.select(row, "text"), row, templates, threshold, max_broadcast))
    narrow = rows.join(broadcast_if_small(own, max_broadcast), row, "left").withColumn(
        is_file, F.col("own_license").isNotNull() & F.coalesce(is_licence_file, F.lit(False))
    )
    narrow = narrow.withColumn(folder, _above(F.col("path")))
    narrow = checkpointed(narrow.select(*columns, "path", "own_license", "own_score", folder, is_file))

    best = F.min(F.struct(-F.col("own_score"), "own_license")).getField("own_license")
    stated = narrow.where(F.col(is_file)).groupBy(folder).agg(best.alias("license")).withColumnRenamed(folder, "license_dir")
    # every directory with all directories above it, itself included
    parts = F.split(folder, "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(i.alias("depth"), F.array_join(F.slice(parts, 1, i), "/").alias("license_dir")))
    chains = narrow.select(folder).distinct().select(folder, F.inline(above)).dropDuplicates([folder, "license_dir"])
    nearest = (
        chains.join(stated, "license_dir").groupBy(folder)
        .agg(F.max(F.struct("depth", "license_dir", "license")).alias("n"))
        .select(folder, F.col("n.license").alias(above_license), F.col("n.license_dir").alias(above_dir))
    )
    nearest = checkpointed(nearest)
    found = narrow.join(broadcast_if_small(nearest, max_broadcast), folder, "left")
    has_own = F.col("own_license").isNotNull()
    return found.select(
        *columns, "path", "own_license", "own_score",
        F.coalesce("own_license", above_license).alias("license"),
        F.when(~has_own, F.col(above_dir)).alias("license_dir"),
    )
