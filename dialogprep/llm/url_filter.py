"""URL filter by rules and link-graph propagation (operator 7).

Rules on host and path decide the urls they fit. Every other url gets the
verdict of its host, from two personalised PageRanks over the host graph of
the pages' links to other hosts: trust flows along links from hosts with pages
that rules allow, distrust against them from hosts with pages that rules block.
A host's seed is the share of its pages that rules allow or block, so a rule for
one path of a host does not condemn the rest. Distrust is what a reader meets
who starts at the host: a blocked page with the seed's chance, else, with the
damping's, that of the hosts it links to, by their share of its links. So it lies between 0 and 1 for
every host, is at least the seed, falls with each step away from blocked hosts,
and one bad link among many counts little. A host whose distrust exceeds its trust by more than
``threshold`` is blocked.

Links are counted per pair of hosts with a partial aggregation; each round is
one equi-join of host ranks with host edges and one aggregation, so hosts
with very many pages or links are combined map-side, and pages meet the host
table once.

Defined results: a null url or one without ``://`` has an empty host and
path, fits no rule and is allowed; links to the own host, relative ones and those
without a host are no edges; hosts without links keep their seed; null html has
no links; repeated rows are judged alike (each counts as a page of its host);
an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialogprep.llm.common import ascii_lower, broadcast_if_small, checkpointed

HREF = r"""(?i)<a\s[^>]*href\s*=\s*["']([^"'>]*)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"^[\s\S]*?://([\s\S]*)$", 1)
    return ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def link_host(link: Column) -> Column:
    """The host a link points at; empty for relative ones."""
    return ascii_lower(F.regexp_extract(link, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def host_links(pages: DataFrame) -> DataFrame:
    """``(a, b, w)``: number of links from host ``a`` to another host ``b``."""
    found = pages.where("host <> ''").select("host", F.explode(F.regexp_extract_all(F.col("html"), F.lit(HREF), F.lit(1))).alias("link"))
    pairs = found.select(F.col("host").alias("a"), link_host(F.col("link")).alias("b"))
    return pairs.groupBy("a", "b").agg(F.count("*").alias("w")).where("b <> '' AND a <> b")


def propagate(links: DataFrame, seeds: DataFrame, damping: float, rounds: int, every: int = 5) -> DataFrame:
    """``(host, trust, distrust)`` of all hosts in ``links`` or ``seeds``.

    ``seeds`` is ``(host, trust, distrust)``. Trust is the fixed point of
    ``(1 - damping) * seed + damping * flow``, distrust that of ``seed + (1 -
    seed) * damping * flow``, after ``rounds`` steps from the seed. Both share a
    link by its share of the linking host's links.
    """
    out = links.groupBy("a").agg(F.sum("w").alias("w_out"))
    edges = links.join(out, "a")
    along = edges.select(F.col("a").alias("from"), F.col("b").alias("to"), F.lit(True).alias("kind"), (F.col("w") / F.col("w_out")).alias("p"))
    against = edges.select(F.col("b").alias("from"), F.col("a").alias("to"), F.lit(False).alias("kind"), (F.col("w") / F.col("w_out")).alias("p"))
    known = links.select(F.col("a").alias("host")).union(links.select(F.col("b").alias("host"))).distinct()
    base = known.join(seeds, "host", "full").select(
        "host", F.inline(F.array(
            F.struct(F.lit(True).alias("kind"), F.coalesce("trust", F.lit(0.0)).alias("seed")),
            F.struct(F.lit(False).alias("kind"), F.coalesce("distrust", F.lit(0.0)).alias("seed")),
        )),
    )
    edges = checkpointed(along.union(against))
    base = checkpointed(base)
    # hosts without links keep their trust
    ends = edges.where("kind").select(F.col("from").alias("host"), "kind").distinct()
    stay = base.where("kind").join(ends, ["host", "kind"], "left_anti").select(F.col("host").alias("from"), F.col("host").alias("to"), "kind", F.lit(1.0).alias("p"))
    edges = checkpointed(edges.union(stay))
    rank = base.select("host", "kind", F.col("seed").alias("x"))
    if not links.limit(1).count():
        rounds = 0  # without a link every rank is its seed
    for k in range(1, rounds + 1):
        flow = (
            edges.join(rank.withColumnRenamed("host", "from"), ["from", "kind"])
            .groupBy(F.col("to").alias("host"), "kind").agg(F.sum(F.col("x") * F.col("p")).alias("flow"))
        )
        flown = F.lit(damping) * F.coalesce("flow", F.lit(0.0))
        x = F.when(F.col("kind"), F.lit(1 - damping) * F.col("seed") + flown).otherwise(F.col("seed") + (1 - F.col("seed")) * flown)
        rank = base.join(flow, ["host", "kind"], "left").select("host", "kind", x.alias("x"))
        if k % every == 0:
            rank = checkpointed(rank)
    of = lambda kind: F.round(F.sum(F.when(F.col("kind") == kind, F.col("x"))), 6)
    return rank.groupBy("host").agg(of(True).alias("trust"), of(False).alias("distrust"))


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    threshold: float = 0.5,
    damping: float = 0.85,
    rounds: int = 20,
    max_broadcast: int = 500_000,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` per page.

    ``rules`` are ``(verdict, host, path)``; a rule fits its host and all
    subdomains where the path begins with the rule's; the longest one wins.
    """
    host, path = host_and_path(F.col("url").cast("string"))
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.col("html").cast("string").alias("html"))
    spark = pages.sparkSession
    table = spark.createDataFrame([(v, h, p, h + p) for v, h, p in rules], "verdict string, at string, start string, rule string")
    table = broadcast_if_small(table, max_broadcast, len(rules))

    # the rules that may fit a host, longest first
    hosts = pages.where("host <> ''").select("host").distinct()
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = hosts.select("host", F.explode(ends).alias("at")).join(table, "at")
    fits = fits.groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct((-F.length("rule")).alias("size"), "rule", "start", "verdict"))).alias("rules")
    )
    hosts = checkpointed(hosts.join(fits, "host", "left"))
    n_hosts = hosts.count()
    first = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["start"])), F.lit(0))
    ruled = pages.drop("html").join(broadcast_if_small(hosts, max_broadcast, n_hosts), "host", "left").withColumn("hit", first)

    seeds = ruled.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("hit.verdict") == "allow", 1.0).otherwise(0.0)).alias("trust"),
        F.avg(F.when(F.col("hit.verdict") == "block", 1.0).otherwise(0.0)).alias("distrust"),
    )
    links = checkpointed(host_links(pages))
    ranks = checkpointed(propagate(links, checkpointed(seeds), damping, rounds))
    # the ranks also hold hosts that are only linked to
    ranks = hosts.select("host", "rules").join(ranks, "host", "left")
    judged = pages.drop("html").join(broadcast_if_small(checkpointed(ranks), max_broadcast, n_hosts), "host", "left")
    method = F.when(F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) > threshold, "block").otherwise("allow")
    return judged.withColumn("hit", first).select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"), F.coalesce("hit.verdict", method).alias("verdict"), "trust", "distrust"
    )
