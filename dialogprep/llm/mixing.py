"""Mixing sources to target weights by hierarchical budgets (operator 1).

The columns ``levels`` make a tree (domain, language, source); its leaves
hold the documents. A token budget is propagated from the root: each node
shares its budget among its children in proportion to their weights, but no
child gets more than its subtree can supply (its tokens times
``max_epochs``). What one child can't take goes to its siblings first, by the
same rule; only what a whole subtree can't take was left to the siblings of
its ancestors, because a node's supply is that of its leaves. Shares are
exact integers that add up.

A leaf then reads seeded epochs of its documents: every epoch has an order of
its own, by a hash of seed, epoch and document. Whole epochs are taken while
the budget lasts, and of the last one the prefix that holds the rest. Only
that epoch needs an order, and of it only the place of the cut: hash prefixes
are summed, two digits at a time, until a few documents around the cut remain
to be ordered, so a leaf with a third of all rows is never sorted in one task
and no text is shuffled.

A token here is a stretch without ASCII white space.

Defined results: null values of a level are a node named ''; documents
without tokens are never taken; the document at the cut gives its first
``take_tokens`` tokens only; rows equal in id and text tie, and at the cut
each gives the same number of tokens; weight 0 closes a subtree; an empty
table gives no rows; columns of the input are kept whatever their names,
but for ``epoch``, ``n_tokens`` and ``take_tokens``, which are replaced. Whole
texts are counted, very long ones too.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dialogprep.llm.common import broadcast_if_small, checkpointed

TOKEN = r"[^\x20\x09-\x0D]+"
_EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """Parameters of a mixture.

    ``weights`` maps a path in the tree, as a tuple of names, to an integer;
    other nodes have ``default_weight``. The budget is ``budget_tokens``, or
    else ``percent`` of the corpus's tokens.
    """

    levels: tuple[str, ...]
    weights: dict[tuple[str, ...], int]
    default_weight: int = 1
    percent: int = 60
    budget_tokens: int | None = None
    max_epochs: int = 2
    seed: int = 17
    max_broadcast: int = 100_000


def _prepared(docs: DataFrame, mix: Mix) -> DataFrame:
    """Node names ``_1 .. _k``, ``n_tokens``, ``_row``, and the columns of
    ``docs`` in a struct ``_input``, where their names clash with none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text))
    names = {f"_{i}": F.coalesce(F.col(c).cast("string"), F.lit("")) for i, c in enumerate(mix.levels, 1)}
    made = names | {"n_tokens": F.regexp_count(text, F.lit(TOKEN)).cast("long"), "_row": row}
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_input"), *[c.alias(n) for n, c in made.items()])


def _order_key(mix: Mix, epoch: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{mix.seed}:"), epoch.cast("string"), F.lit(":"), F.col("_row")))


def _weight(mix: Mix, depth: int) -> Column:
    known = {p: w for p, w in mix.weights.items() if len(p) == depth}
    if not known:
        return F.lit(mix.default_weight).cast("long")
    table = F.create_map(*[F.lit(x) for p, w in known.items() for x in ("\x1f".join(p), w)])
    path = F.concat_ws("\x1f", *[f"_{i}" for i in range(1, depth + 1)])
    return F.coalesce(F.element_at(table, path), F.lit(mix.default_weight)).cast("long")


def _shared(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Budget of each node from its parent's: ``room`` among siblings with
    supplies ``cap`` and weights ``w``."""
    family = Window.partitionBy(*(parents or [F.lit(0)]))
    ordered = family.orderBy("ratio", name)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    x = nodes.withColumn("ratio", F.when(F.col("w") > 0, F.col("cap") / F.col("w")).otherwise(float("inf")))
    x = (
        x.withColumn("w_all", F.sum("w").over(family))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0)))
    )
    # the children with the least supply for their weight are full first
    full = F.col("cap").cast(_EXACT) * (F.col("w_all") - F.col("w_before")) <= F.col("w").cast(_EXACT) * (
        F.col("room") - F.col("cap_before")
    )
    x = x.withColumn("full", full | (F.col("w") == 0))
    left = F.col("room") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(family)
    open_w = F.when(~F.col("full"), F.col("w")).otherwise(0)
    x = (
        x.withColumn("left", left).withColumn("w_open", F.sum(open_w).over(family))
        .withColumn("w_to", F.sum(open_w).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    )

    def share(w: Column) -> Column:
        """Budget of the open children up to one, in whole tokens."""
        return F.call_function("div", F.col("left").cast("decimal(20,0)") * w.cast("decimal(18,0)"), F.col("w_open").cast("decimal(18,0)"))

    return x.withColumn(
        "budget", F.when(F.col("full"), F.col("cap")).otherwise(share(F.col("w_to")) - share(F.col("w_to") - F.col("w")))
    )


def leaf_budgets(totals: DataFrame, mix: Mix) -> DataFrame:
    """``_1 .. _k, tokens, budget`` per leaf from its ``tokens``."""
    keys = [f"_{i}" for i in range(1, len(mix.levels) + 1)]
    leaves = totals.withColumns({f"w{i}": _weight(mix, i) for i in range(1, len(keys) + 1)})
    is_open = F.least(*[F.col(f"w{i}") for i in range(1, len(keys) + 1)], F.lit(1)) > 0
    leaves = leaves.withColumn("cap", F.when(is_open, F.col("tokens") * mix.max_epochs).otherwise(0))
    budget = F.lit(mix.budget_tokens).cast("long") if mix.budget_tokens is not None else F.expr(f"sum(tokens) * {mix.percent} div 100")
    whole = leaves.agg(F.least(budget, F.sum("cap")).cast("long")).first()[0] or 0  # the root's budget
    parent = None
    for i in range(1, len(keys) + 1):
        nodes = leaves.groupBy(*keys[:i]).agg(F.sum("cap").alias("cap"), F.first(f"w{i}").alias("w"))
        if i == 1:
            nodes = nodes.withColumn("room", F.lit(whole).cast("long"))
        else:
            nodes = nodes.join(parent, keys[: i - 1])
        parent = _shared(nodes, keys[: i - 1], keys[i - 1]).select(*keys[:i], F.col("budget").alias("room"))
    return leaves.join(parent.withColumnRenamed("room", "budget"), keys).select(*keys, "tokens", "budget")


def leaf_plan(docs: DataFrame, mix: Mix) -> DataFrame:
    """Per leaf: ``budget``, whole ``epochs``, and of the next epoch the hash
    ``cut_key`` at which it ends and what a document there still gives."""
    keys = [f"_{i}" for i in range(1, len(mix.levels) + 1)]
    rows = checkpointed(_prepared(docs, mix).where("n_tokens > 0").select(*keys, "n_tokens", "_row"))
    totals = checkpointed(rows.groupBy(*keys).agg(F.sum("n_tokens").alias("tokens")))
    plan = leaf_budgets(totals, mix)
    plan = plan.withColumn("epochs", F.expr("budget div tokens")).withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
    plan = checkpointed(plan)
    cut = plan.where("rest > 0").select(*keys, "epochs", F.col("rest").alias("want"), F.lit("").alias("prefix"))
    small = plan.count()
    here = Window.partitionBy(*keys).orderBy("part")
    for digits in (2, 4, 32):
        part = F.substring(_order_key(mix, F.col("epochs")), 1, digits)
        near = rows.join(broadcast_if_small(cut, mix.max_broadcast, small), keys).withColumn("part", part)
        near = near.where(F.col("part").startswith(F.col("prefix")))
        sums = near.groupBy(*keys, "epochs", "want", "part").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("ties"))
        sums = sums.withColumn("to", F.sum("n").over(here.rowsBetween(Window.unboundedPreceding, 0)))
        hit = sums.where((F.col("to") - F.col("n") <= F.col("want")) & (F.col("want") < F.col("to")))
        cut = checkpointed(
            hit.select(*keys, "epochs", (F.col("want") - F.col("to") + F.col("n")).alias("want"), F.col("part").alias("prefix"), "ties")
        )
    ends = cut.select(*keys, F.col("prefix").alias("cut_key"), F.expr("want div ties").alias("cut_tokens"))
    return checkpointed(plan.join(ends, keys, "left").select(*keys, "tokens", "budget", "epochs", "cut_key", "cut_tokens"))


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The taken rows of ``docs``, once per epoch, with ``epoch``,
    ``n_tokens`` and ``take_tokens``."""
    keys = [f"_{i}" for i in range(1, len(mix.levels) + 1)]
    kept = [c for c in docs.columns if c.lower() not in ("epoch", "n_tokens", "take_tokens")]
    plan = leaf_plan(docs, mix)
    rows = _prepared(docs, mix).where("n_tokens > 0").join(broadcast_if_small(plan, mix.max_broadcast), keys)
    key = _order_key(mix, F.col("epochs"))
    last = F.when(key < F.col("cut_key"), F.col("n_tokens")).when(key == F.col("cut_key"), F.col("cut_tokens")).otherwise(0)
    rows = rows.withColumn("_last", last)
    # a row is taken in every whole epoch, and in the next one if _last > 0
    ends = F.when(F.col("_last") > 0, F.col("epochs")).otherwise(F.col("epochs") - 1)
    rows = rows.where(ends >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), ends)))
    take = F.when(F.col("epoch") < F.col("epochs"), F.col("n_tokens")).otherwise(F.col("_last"))
    return rows.select(*[F.col("_input").getField(c).alias(c) for c in kept], "epoch", "n_tokens", take.alias("take_tokens"))


def first_tokens(text: Column, n: Column) -> Column:
    """The text up to the end of its ``n``-th token."""
    parts = F.regexp_extract_all(text, F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")
