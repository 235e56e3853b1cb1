"""One checkable query per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dialogprep.llm.common import table
from dialogprep.llm.embed_dedup import near_vectors
from dialogprep.llm.fingerprints import fingerprints
from dialogprep.llm.language_crf import language_ids
from dialogprep.llm.licenses import TEMPLATES, scan_licenses
from dialogprep.llm.line_dedup import dedup_lines
from dialogprep.llm.mixing import Mix, mixed
from dialogprep.llm.packing import pack
from dialogprep.llm.periodic_runs import periodic_runs
from dialogprep.llm.quality import quality
from dialogprep.llm.shingle_join import near_duplicates
from dialogprep.llm.token_align import token_alignment
from dialogprep.llm.token_counts import count_tokens
from dialogprep.llm.url_filter import judge_urls

TOKENIZER = "byte_bpe_50k.json"
OTHER_TOKENIZER = "piece_bpe_32k.model"


DOMAINS = ("web", "books", "code", "forum")
MIX = Mix(
    levels=("domain", "lang", "source"),
    weights={("web",): 50, ("books",): 20, ("code",): 20, ("forum",): 10}
    | {(d, "en"): 6 for d in DOMAINS}
    | {(d, x): 2 for d in DOMAINS for x in ("de", "fr", "es")},
    percent=60,
    max_epochs=2,
    seed=17,
)


def with_domain(docs: DataFrame) -> DataFrame:
    """A domain for each source: its number modulo the domains."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]{1,6})$", 1)
    names = F.array(*[F.lit(d) for d in DOMAINS])
    domain = F.when(number == "", F.lit("other")).otherwise(
        F.element_at(names, (F.expr("try_cast(regexp_extract(coalesce(source, ''), '([0-9]{1,6})$', 1) AS int)") % len(DOMAINS)) + 1)
    )
    return docs.withColumn("domain", domain)


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents"))
    return mixed(docs, MIX).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "take_tokens")


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def tree_path(ids_per_folder: int = 100):
    """A place in a tree for each document: its source, language and, for
    texts of more than three lines, a folder of neighbouring ids."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))
    folder = F.expr(f"doc_id div {ids_per_folder}").cast("string")
    top = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    short = F.size(F.split(F.coalesce("text", F.lit("")), "\n")) <= 3
    return F.concat_ws("/", top, F.when(~short, folder), name)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short documents that state a license stand for their folder."""
    docs = table(spark, sf_dir, "documents")
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    found = scan_licenses(docs, tree_path(), n_lines <= 12)
    return found.select("doc_id", "path", "own_license", "own_score", "license", "license_dir")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# (verdict, host, path)
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=3, num=90, den=100)
    return found.select("doc_id", "n_shingles", "component_id")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(table(spark, sf_dir, "documents"))


def with_tail_repeated(docs: DataFrame) -> DataFrame:
    """The contract's edit: by a checksum of the id, every tenth document's
    words from a place on become repetitions of the words found there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")

    def repeated(w):
        n = F.size(w)
        a = F.pmod(g, n).cast("int")
        rest = n - a
        p = (F.floor(rest / (F.lit(3) + F.pmod(g, F.lit(8)))) + 1).cast("int")
        tail = F.flatten(F.array_repeat(F.slice(w, a + 1, p), F.ceil(rest / p).cast("int")))
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(tail, F.lit(1), rest)), " "))

    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    edited = F.transform(F.array(words), repeated)[0]
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, edited).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_tail_repeated(table(spark, sf_dir, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ended = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.col3")).cast("long").alias("exponent_milli"),
        F.sha2(ended, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    path_a, path_b = public_tokenizers.path(TOKENIZER), public_tokenizers.path(OTHER_TOKENIZER)
    return token_alignment(table(spark, sf_dir, "documents"), path_a, path_b)


QUERIES = {
    "op1_source_mixing": op1_source_mixing,
    "op4_license_scan": op4_license_scan,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_token_counts": op3_token_counts,
    "op5_packing": op5_packing,
    "op6_line_dedup": op6_line_dedup,
    "op7_url_filter": op7_url_filter,
    "op8_quality": op8_quality,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_fingerprints": op10_fingerprints,
    "op11_language_id": op11_language_id,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_alignment": op13_token_alignment,
}

def _share_sql(depth: int) -> str:
    """CTEs that share budgets among the nodes of one level."""
    keys = ["domain", "lang", "source"][:depth]
    by, up = ", ".join(keys), ", ".join(keys[:-1])
    family = f"PARTITION BY {up}" if up else ""
    parent = f"JOIN b{depth - 1} USING ({up})" if up else "CROSS JOIN b0"
    return f"""
, n{depth} AS (
  SELECT {by}, sum(cap) AS cap, any_value(w{depth}) AS w FROM leaf GROUP BY {by}
), o{depth} AS (
  SELECT *, coalesce(sum(cap) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cap_before,
         coalesce(sum(w) OVER (q ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_before,
         sum(w) OVER ({family}) AS w_all
  FROM n{depth} {parent} WINDOW q AS ({family} ORDER BY cap / w, {keys[-1]})
), f{depth} AS (
  SELECT *, CAST(cap AS HUGEINT) * (w_all - w_before) <= CAST(w AS HUGEINT) * (room - cap_before) AS is_full FROM o{depth}
), g{depth} AS (
  SELECT *, room - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ({family}) AS rest,
         sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({family}) AS w_open,
         sum(CASE WHEN is_full THEN 0 ELSE w END) OVER ({family} ORDER BY cap / w, {keys[-1]}
                                                       ROWS UNBOUNDED PRECEDING) AS w_to
  FROM f{depth}
), b{depth} AS (
  SELECT {by}, CAST(CASE WHEN is_full THEN cap
                         ELSE rest * w_to // w_open - rest * (w_to - w) // w_open END AS HUGEINT) AS room
  FROM g{depth}
)"""


_RANK_ROUNDS = "".join(
    f"""
, r{k} AS MATERIALIZED (
  SELECT host, kind, CASE WHEN kind THEN 0.15::DOUBLE * seed + 0.85::DOUBLE * coalesce(flow, 0)
                          ELSE seed + (1 - seed) * 0.85::DOUBLE * coalesce(flow, 0) END AS x
  FROM base LEFT JOIN (
    SELECT t AS host, kind, sum(x * p) AS flow FROM edge JOIN r{k - 1} q USING (kind) WHERE q.host = edge.f GROUP BY t, kind
  ) USING (host, kind)
)"""
    for k in range(1, 21)
)

_URL_SQL = r"""
WITH rules AS (
  SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                        ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(v, h, p)
), cut AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), page AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), judged AS (
  SELECT page_id, html, host, path,
         (SELECT min(struct_pack(n := -length(h || p), r := h || p, v := v)) FROM rules
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS hit
  FROM page
), seeds AS (
  SELECT host, avg(CASE WHEN hit.v = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
         avg(CASE WHEN hit.v = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
  FROM judged WHERE host <> '' GROUP BY host
), link AS (
  SELECT host AS a, unnest(regexp_extract_all(html, '(?i)<a\s[^>]*href\s*=\s*["'']([^"''>]*)', 1)) AS l FROM judged WHERE host <> ''
), pair AS (
  SELECT a, h AS b, count(*) AS w
  FROM (SELECT a, translate(regexp_extract(l, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h FROM link)
  WHERE h <> '' AND h <> a GROUP BY ALL
), known AS (SELECT a AS host FROM pair UNION SELECT b FROM pair UNION SELECT host FROM seeds
), base AS MATERIALIZED (
  SELECT host, true AS kind, coalesce(trust, 0) AS seed FROM known LEFT JOIN seeds USING (host)
  UNION ALL SELECT host, false, coalesce(distrust, 0) FROM known LEFT JOIN seeds USING (host)
), linked AS (
  SELECT a AS f, b AS t, true AS kind, w / sum(w) OVER (PARTITION BY a) AS p FROM pair
  UNION ALL SELECT b, a, false, w / sum(w) OVER (PARTITION BY a) FROM pair
), edge AS MATERIALIZED (
  SELECT * FROM linked
  UNION ALL SELECT host, host, kind, 1.0 FROM base WHERE kind AND host NOT IN (SELECT f FROM linked WHERE kind)
), r0 AS (SELECT host, kind, seed AS x FROM base)
""".rstrip() + _RANK_ROUNDS + r"""
, rank AS (
  SELECT host, round(sum(x) FILTER (WHERE kind), 6) AS trust, round(sum(x) FILTER (WHERE NOT kind), 6) AS distrust FROM r20 GROUP BY host
)
SELECT page_id, judged.host, path, hit.r AS rule,
       coalesce(hit.v, CASE WHEN coalesce(distrust - trust, 0) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict, trust, distrust
FROM judged LEFT JOIN rank ON rank.host = judged.host
"""

_TEMPLATE_ROWS = ", ".join(f"({i}, '{name}', '{notice}')" for i, (name, notice) in enumerate(TEMPLATES))

_LICENSE_SQL = f"""
WITH template AS (SELECT * FROM (VALUES {_TEMPLATE_ROWS}) t(template, license, notice)
), term AS (
  SELECT template, license, term, count(*) AS tf
  FROM (SELECT template, license, unnest(regexp_extract_all(lower(notice), '[a-z0-9]+')) AS term FROM template) GROUP BY ALL
), doc AS (
  SELECT *, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, i AS pos, regexp_extract_all(lower(lines[i]), '[a-z0-9]+') AS words
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM doc)
), word AS (SELECT doc_id, pos, unnest(words) AS term FROM line
), df AS (SELECT term, count(DISTINCT doc_id) AS df FROM word WHERE term IN (SELECT term FROM term) GROUP BY term
), idf AS (
  SELECT DISTINCT term.term, ln((1 + (SELECT count(*) FROM documents)) / (1 + coalesce(df, 0))) + 1 AS idf
  FROM term LEFT JOIN df ON df.term = term.term
), unit AS (
  SELECT template, license, term, tf * idf / sqrt(sum(tf * tf * idf * idf) OVER (PARTITION BY template)) AS weight
  FROM term JOIN idf USING (term)
), entry AS (
  SELECT doc_id, pos, word.term, count(*) * coalesce(any_value(idf), ln(1 + (SELECT count(*) FROM documents)) + 1) AS x
  FROM word LEFT JOIN idf ON idf.term = word.term GROUP BY doc_id, pos, word.term
), size AS (SELECT doc_id, pos, sqrt(sum(x * x)) AS size FROM entry GROUP BY doc_id, pos
), score AS (
  SELECT doc_id, license, round(sum(x * weight) / any_value(size), 6) AS score
  FROM entry JOIN unit USING (term) JOIN size USING (doc_id, pos) GROUP BY doc_id, pos, template, license
), own AS (
  SELECT doc_id, min(struct_pack(s := -score, l := license)) AS b FROM score WHERE score >= 0.7 GROUP BY doc_id
), placed AS (
  SELECT d.doc_id, b.l AS own_license, -b.s AS own_score, len(lines) AS n,
         coalesce(source, 'none') || '/' || coalesce(lang, 'none')
           || CASE WHEN len(lines) > 3 THEN '/' || CAST(d.doc_id // 100 AS VARCHAR) ELSE '' END AS dir
  FROM doc d LEFT JOIN own ON own.doc_id = d.doc_id
), stated AS (
  SELECT dir AS place, min(struct_pack(s := -own_score, l := own_license)).l AS license
  FROM placed WHERE own_license IS NOT NULL AND n <= 12 GROUP BY dir
), nearest AS (
  SELECT p.dir, max(struct_pack(k := length(place), p := place, l := license)) AS b
  FROM (SELECT DISTINCT dir FROM placed) p JOIN stated ON p.dir = place OR starts_with(p.dir, place || '/') GROUP BY p.dir
)
SELECT doc_id, placed.dir || '/' || CAST(doc_id AS VARCHAR) AS path, own_license, own_score,
       coalesce(own_license, b.l) AS license, CASE WHEN own_license IS NULL THEN b.p END AS license_dir
FROM placed LEFT JOIN nearest ON nearest.dir = placed.dir
"""

_MIX_SQL = r"""
WITH doc AS (
  SELECT doc_id, lang, source,
         CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]{1,6})$', 1) = '' THEN 'other'
              ELSE ['web', 'books', 'code', 'forum'][CAST(regexp_extract(source, '([0-9]{1,6})$', 1) AS INT) % 4 + 1] END AS domain,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS row_hash
  FROM documents
), leaf AS (
  SELECT domain, lang, source, sum(n_tokens) AS tokens, 2 * sum(n_tokens) AS cap,
         CASE domain WHEN 'web' THEN 50 WHEN 'books' THEN 20 WHEN 'code' THEN 20 WHEN 'forum' THEN 10 ELSE 1 END AS w1,
         CASE WHEN domain = 'other' THEN 1 WHEN lang = 'en' THEN 6 WHEN lang IN ('de', 'fr', 'es') THEN 2 ELSE 1 END AS w2,
         1 AS w3
  FROM doc WHERE n_tokens > 0 GROUP BY ALL
), b0 AS (SELECT least(sum(tokens) * 60 // 100, sum(cap)) AS room FROM leaf)
""" + "".join(_share_sql(d) for d in (1, 2, 3)) + r"""
, plan AS (
  SELECT domain, lang, source, room // tokens AS epochs, room % tokens AS rest
  FROM leaf JOIN b3 USING (domain, lang, source)
), keyed AS (
  SELECT doc.*, epochs, rest, md5('17:' || CAST(epochs AS VARCHAR) || ':' || row_hash) AS k
  FROM doc JOIN plan USING (domain, lang, source) WHERE n_tokens > 0
), placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY k) AS upto,
         sum(n_tokens) OVER (PARTITION BY domain, lang, source, k) AS tie,
         count(*) OVER (PARTITION BY domain, lang, source, k) AS ties
  FROM keyed
), taken AS (
  SELECT *, CASE WHEN upto <= rest THEN n_tokens
                 WHEN upto - tie <= rest THEN (rest - (upto - tie)) // ties ELSE 0 END AS last_take
  FROM placed
)
SELECT doc_id, domain, lang, source, CAST(e.i AS BIGINT) AS epoch, n_tokens,
       CAST(CASE WHEN e.i < epochs THEN n_tokens ELSE last_take END AS BIGINT) AS take_tokens
FROM taken, unnest(range(0, 3)) AS e(i)
WHERE e.i < epochs OR (e.i = epochs AND last_take > 0)
"""

ORACLE_SQL = {
    "op1_source_mixing": _MIX_SQL,
    "op4_license_scan": _LICENSE_SQL,
    "op2_embedding_dedup": """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), link AS (
  SELECT a.vec_id AS s, b.vec_id AS t FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT vec_id AS s, vec_id AS t FROM v
  UNION
  SELECT r.s, l.t FROM reach r JOIN link l ON l.s = r.t
), low AS (SELECT s, min(t) AS component_id FROM reach GROUP BY s)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.s = v.vec_id) AS n_links, component_id,
       v.vec_id = component_id AS kept
FROM v JOIN low ON low.s = v.vec_id
""",
    "op7_url_filter": _URL_SQL,
    "op9_ngram_jaccard": r"""
WITH RECURSIVE word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM word WHERE len(w) > 0)
), size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
), link AS (
  SELECT x, y FROM pair JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y WHERE 100 * c >= 90 * (p.n + q.n - c)
), both_ways AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
  SELECT doc_id AS s, doc_id AS t FROM documents
  UNION
  SELECT r.s, b.y FROM reach r JOIN both_ways b ON b.x = r.t
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(t) AS component_id
FROM documents d LEFT JOIN size ON size.doc_id = d.doc_id JOIN reach ON reach.s = d.doc_id
GROUP BY d.doc_id
""",
    "op6_line_dedup": """
WITH line AS (
  SELECT doc_id, n.i AS pos, t.l AS line,
         translate(trim(t.l, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       unnest(range(1, len(ls) + 1)) AS n(i), LATERAL (SELECT ls[n.i] AS l) t
), frequent AS (
  SELECT k FROM line WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE f.k IS NOT NULL) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.k IS NULL), '')) AS kept_sha256
FROM line LEFT JOIN frequent f ON line.k = f.k
GROUP BY doc_id
""",
}
