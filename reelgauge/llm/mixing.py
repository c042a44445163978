"""Mixing to target weights: budgets down a tree, shortages to siblings first, seeded epochs at the leaves.

The tree is given by columns (domain, language, source). A node's capacity is what its leaves have,
times ``max_epochs``. Going down from the root, a node's budget is dealt to its children in
proportion to their weights; a child that can't use its share keeps its capacity, and what it leaves
goes to its siblings in proportion again. A budget never exceeds the node's capacity, so a shortage
reaches an ancestor only when all siblings are full. One window over the children, ordered by
capacity / weight, finds the children that fill up: no iteration.

A leaf with budget b and t tokens takes b div t whole epochs and, of the next epoch, the longest
prefix of its documents, in that epoch's seeded order, that fits into the rest. Documents are ordered by
md5(seed:epoch:id) and cut into 4096 blocks by the first three digits. Block totals find the block with
the end of the prefix, and only that block is summed document by document, so no leaf is ever in one task.

Cases: null tokens count as words of the text, null names are the empty name; documents without words
follow their place in the order; a row without an id is ordered by the digest of its text; rows with equal ids, or without
ids and with equal texts, are taken or left together; a weight of 0 excludes a node; an empty table gives an empty result; other columns, and names that clash with the tree's,
pass ``mixed`` untouched.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelgauge.llm.tables import place, written
from reelgauge.llm.words import whole, word_array


@dataclass(frozen=True)
class Mix:
    """Integer weights by level and name (``default`` for names that are not listed)."""

    weights: Sequence[Mapping[str, int]] = field(default_factory=tuple)
    default: int = 1
    #: The budget in hundredths of all tokens.
    percent: int = 80
    max_epochs: int = 4
    seed: int = 7


#: Production parameters for ``documents``: levels are domain, lang, source.
DOMAINS = {
    "web": ("src0", "src1", "src2", "src3", "src4", "src5", "src6"),
    "books": ("src7", "src8", "src9", "src10", "src11", "src12"),
    "forum": ("src13", "src14", "src15", "src16"),
}
MIX = Mix(weights=({"web": 4, "books": 3, "forum": 2, "other": 1}, {"en": 5, "de": 2, "fr": 2, "es": 2}, {"src0": 3}))


def domain_of(source: Column, domains: Mapping[str, Sequence[str]] = DOMAINS) -> Column:
    found = F.lit("other")
    for name, members in domains.items():
        found = F.when(source.isin(*members), F.lit(name)).otherwise(found)
    return found


def _weight(level: Mapping[str, int], name: Column, default: int) -> Column:
    found = F.lit(default)
    for key, value in level.items():
        found = F.when(name == key, F.lit(value)).otherwise(found)
    return found.cast("decimal(18,0)")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], mix: Mix) -> DataFrame:
    """levels..., tokens -> levels..., tokens, budget. Tables have one row per node."""
    weights = [*mix.weights, *[{}] * (len(levels) - len(mix.weights))]
    exact = "decimal(20,0)"
    # Capacities from the leaves up; a node of weight 0 has none. ``offered`` is all a node has.
    caps = {len(levels): leaves.withColumns({"cap": F.col("tokens").cast(exact) * mix.max_epochs, "offered": F.col("tokens").cast(exact)})}
    for depth in range(len(levels), 0, -1):
        weight = _weight(weights[depth - 1], F.col(levels[depth - 1]), mix.default)
        table = caps[depth].withColumn("weight", weight)
        caps[depth] = table.withColumn("cap", F.when(F.col("weight") > 0, F.col("cap")).otherwise(F.lit(0)).cast(exact))
        if depth > 1:
            caps[depth - 1] = caps[depth].groupBy(*levels[: depth - 1]).agg(*(F.sum(c).cast(exact).alias(c) for c in ("cap", "offered")))
    # The root's budget is the same sum over the few nodes of the first level, on each of them.
    top = Window.partitionBy(F.lit(0))
    share = (F.sum("offered").over(top).cast(exact) * mix.percent).cast("decimal(24,0)")
    budget = caps[1].withColumn("_share", share).select(
        levels[0], F.least(F.expr("CAST(_share div 100 AS DECIMAL(20,0))"), F.sum("cap").over(top).cast(exact)).cast(exact).alias("budget")
    )
    for depth in range(1, len(levels) + 1):
        parent, own = levels[: depth - 1], levels[:depth]
        children = caps[depth].join(budget, parent or own)
        siblings = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
        order = siblings.orderBy(F.when(F.col("weight") > 0, F.col("cap").cast("double") / F.col("weight").cast("double")).otherwise(0.0), own[-1])
        dealt = (
            children.withColumn("before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast(exact))
            .withColumn("weights", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).cast("decimal(18,0)"))
            .withColumn("full", F.expr("cap * weights <= (budget - before) * weight"))
            .withColumn("rest", F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(siblings), F.lit(0)))
            .withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(siblings).cast("decimal(18,0)"))
            .withColumn("dealt", F.expr("CASE WHEN full THEN cap ELSE CAST((CAST(rest AS DECIMAL(20,0)) * weight) div open AS DECIMAL(20,0)) END"))
        )
        extra = ["tokens"] if depth == len(levels) else []
        budget = dealt.select(*own, *extra, F.col("dealt").cast(exact).alias("budget"))
    return budget.withColumn("budget", F.col("budget").cast("long"))


def _name(doc_id: Column, text: Column) -> Column:
    """What a document is ordered by: its id, or the digest of its text if it has none."""
    return F.coalesce(doc_id.cast("string"), F.md5(whole(text).cast("binary")))


def _key(seed: int, epoch: Column, name: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), name).cast("binary"))


def leaf_cuts(rows: DataFrame, levels: Sequence[str], mix: Mix) -> DataFrame:
    """name, levels..., n_tokens -> levels..., tokens, budget, epochs, cut.

    A document of the leaf is taken ``epochs`` times, and once more if its key in that epoch is <= ``cut``.
    """
    leaves = rows.groupBy(*levels).agg(F.sum("n_tokens").alias("tokens"))
    leaves = written(leaves, "mix-leaves")
    plan = written(
        leaf_budgets(leaves, levels, mix).select(
            *levels, "tokens", "budget",
            F.expr("CASE WHEN tokens > 0 THEN budget div tokens ELSE 0 END").alias("epochs"),
            F.expr("CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END").alias("left"),
        ),
        "mix-plan",
    )
    keyed = rows.join(plan.where("left > 0").select(*levels, "epochs", "left"), levels).withColumn(
        "key", _key(mix.seed, F.col("epochs"), F.col("name"))
    )
    keyed = keyed.withColumn("block", F.substring("key", 1, 3))
    run = Window.partitionBy(*levels).orderBy("block")
    ends = written(
        keyed.groupBy(*levels, "left", "block")
        .agg(F.sum("n_tokens").alias("n"))
        .withColumn("upto", F.sum("n").over(run))
        .where("upto > left AND upto - n <= left")
        .select(*levels, "block", (F.col("left") - (F.col("upto") - F.col("n"))).alias("room")),
        "mix-ends",
    )
    inside = Window.partitionBy(*levels).orderBy("key")
    cut = (
        keyed.join(ends, [*levels, "block"])
        .groupBy(*levels, "block", "room", "key")  # equal keys are one, however many rows have them
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .withColumn("upto", F.sum("n_tokens").over(inside))
        .groupBy(*levels, "block")
        .agg(F.max(F.when(F.col("upto") <= F.col("room"), F.col("key"))).alias("last"))
        # Of three digits, the block's name is below all its keys and above all earlier blocks.
        .select(*levels, F.coalesce("last", "block").alias("cut"))
    )
    return written(plan.join(cut, list(levels), "left").select(*levels, "tokens", "budget", "epochs", "cut"), "mix-cuts")


def _narrow(docs: DataFrame, levels: Mapping[str, Column], text: str, doc_id: str) -> DataFrame:
    name, whole_text = F.col(f"`{doc_id}`"), F.col(f"`{text}`")
    return docs.select(
        name.alias("doc_id"),
        _name(name, whole_text).alias("name"),
        *(F.coalesce(c, F.lit("")).alias(level) for level, c in levels.items()),
        F.size(word_array(whole_text)).cast("long").alias("n_tokens"),
    )


def tree_of_documents() -> dict[str, Column]:
    return {"domain": domain_of(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}


def copies(docs: DataFrame, levels: Mapping[str, Column] | None = None, mix: Mix = MIX, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, levels..., n_tokens, leaf_tokens, leaf_budget, copies: how often each document is taken."""
    levels = levels or tree_of_documents()
    # Texts are read once; counts and keys are made from the narrow table.
    rows = written(_narrow(docs, levels, text, doc_id), "mix-rows")
    cuts = leaf_cuts(rows, list(levels), mix)
    once_more = F.coalesce(_key(mix.seed, F.col("epochs"), F.col("name")) <= F.col("cut"), F.lit(False))
    return rows.join(cuts, list(levels)).select(
        "doc_id", *levels, "n_tokens", F.col("tokens").alias("leaf_tokens"), F.col("budget").alias("leaf_budget"),
        (F.col("epochs") + once_more.cast("long")).alias("copies"),
    )


def mixed(docs: DataFrame, levels: Mapping[str, Column] | None = None, mix: Mix = MIX, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that the mix takes, each as often as it is taken, with their own columns.

    Texts are not shuffled when the leaf table is small: its size is known from its file.
    """
    levels = levels or tree_of_documents()
    rows = written(_narrow(docs, levels, text, doc_id), "mix-rows")
    cuts = leaf_cuts(rows, list(levels), mix)
    # Columns by number: no name of the table's own can clash with a helper's.
    columns = [f"c{i}" for i in range(len(docs.columns))]
    leaf = [f"leaf{i}" for i in range(len(levels))]
    cuts = cuts.select(*(F.col(n).alias(x) for n, x in zip(levels, leaf, strict=True)), "epochs", "cut")
    taken = docs.select(
        *(F.col(f"`{c}`").alias(x) for c, x in zip(docs.columns, columns, strict=True)),
        *(F.coalesce(c, F.lit("")).alias(x) for c, x in zip(levels.values(), leaf, strict=True)),
    ).join(cuts, leaf)
    name = _name(place(docs, doc_id), place(docs, text))
    once_more = F.coalesce(_key(mix.seed, F.col("epochs"), name) <= F.col("cut"), F.lit(False))
    taken = taken.withColumn("copies", F.col("epochs") + once_more.cast("long")).where("copies > 0")
    if mix.max_epochs > 1:
        taken = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return taken.select(*columns).toDF(*docs.columns)
