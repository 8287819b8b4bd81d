"""Mixing sources to target weights (native): hierarchical token budgeting.

The tree is domain > language > source (any list of levels).  Leaf capacity is ``epochs`` times
the leaf's tokens, and capacities add up the tree.  From the root down, each node's budget is
split among its children by weight; a child that can't hold its share takes its capacity and the
rest is shared by its siblings, so a shortage leaves a subtree only when no sibling can take it.
Every leaf then selects its budget as a prefix of its seeded epochs: whole passes first, then the
documents of the next epoch in seeded order as long as they fit.

Tokens are words.  A null level value counts as ''.  Null or blank texts hold no token; they are
selected by whole epochs only with their leaf and cost nothing.  Budgets are integers and exact:
floors first, left-over tokens by largest remainder, then name.  Repeated rows and null ids are
documents like others.  Only the id, the levels and the text are read; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from velorank.llm.common import running_sum, seeded_order, words
from velorank.session import materialize

#: Weights by level and node name; a node that is not listed has weight 1.
WEIGHTS = {
    "domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1},
    "lang": {"en": 5, "fr": 2, "de": 2, "es": 1},
    "source": {},
}
SEED, EPOCHS = 42, 3
BUDGET = (1, 1)                    # share of the table's tokens to select, as numerator and denominator


def source_domain(source: Column) -> Column:
    """The tables name no domain: a source belongs to one of four by its checksum."""
    return F.concat(F.lit("d"), (F.crc32(F.coalesce(source, F.lit(""))) % 4).cast("string"))


def _weight(level: str, weights: dict) -> Column:
    w = F.lit(1).cast("long")
    for name, x in weights.get(level, {}).items():
        w = F.when(F.col(level) == name, F.lit(int(x)).cast("long")).otherwise(w)
    return w


def split_budget(children: DataFrame, parents: list[str], name: str, weight: Column) -> DataFrame:
    """Add ``alloc``: the parent's ``budget`` dealt to its children by weight, none above its ``cap``."""
    wide = lambda c: F.col(c).cast("decimal(38,0)")
    part = W.partitionBy(*parents) if parents else W.partitionBy(F.lit(0))
    asc = part.orderBy(F.col("cap") / F.col("w"), name)
    x = children.withColumn("w", weight).withColumns({
        "_before": F.coalesce(F.sum("cap").over(asc.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
        "_from": F.sum("w").over(asc.rowsBetween(0, W.unboundedFollowing))})
    x = x.withColumn("_full", wide("cap") * wide("_from") <= (wide("budget") - wide("_before")) * wide("w"))
    x = x.withColumns({
        "_rest": F.col("budget") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(part), F.lit(0)),
        "_w": F.sum(F.when(~F.col("_full"), F.col("w"))).over(part)})
    x = x.withColumns({
        "_q": F.when(~F.col("_full"), F.expr("cast(cast(_rest as decimal(20,0)) * w div _w as bigint)")),
        "_rem": F.when(~F.col("_full"), F.expr("cast(_rest as decimal(20,0)) * w % _w"))})
    x = x.withColumn("_left", F.col("_rest") - F.coalesce(F.sum("_q").over(part), F.lit(0)))
    x = x.withColumn("_i", F.row_number().over(part.orderBy(F.col("_full"), F.col("_rem").desc(), name)))
    return x.withColumn("alloc", F.when(F.col("_full"), F.col("cap")).otherwise(
        F.col("_q") + (F.col("_i") <= F.col("_left")).cast("long"))) \
        .drop("w", "_before", "_from", "_full", "_rest", "_w", "_q", "_rem", "_left", "_i")


def leaf_budgets(leaves: DataFrame, levels: list[str], weights: dict, epochs: int, budget: tuple[int, int]) -> DataFrame:
    """``leaves`` (levels, tokens) with ``alloc``; the tables of the tree's inner nodes come from it by sums."""
    cap = leaves.withColumn("cap", F.col("tokens") * epochs)
    top = cap.agg(F.least(F.expr(f"sum(tokens) * {budget[0]} div {budget[1]}"), F.sum("cap")).cast("long").alias("budget"))
    given = top.withColumn("_root", F.lit(0))
    parents = ["_root"]
    for level in levels:
        nodes = cap.withColumn("_root", F.lit(0)).groupBy(*parents, level).agg(F.sum("cap").alias("cap"))
        given = split_budget(nodes.join(given, parents), parents, level, _weight(level, weights)) \
            .select(*parents, level, F.col("alloc").alias("budget"))
        parents = [*parents, level]
    return leaves.join(given.withColumnRenamed("budget", "alloc").drop("_root"), levels)


def mix_sources(docs: DataFrame, levels: dict[str, Column], weights: dict = WEIGHTS, epochs: int = EPOCHS,
                budget: tuple[int, int] = BUDGET, seed: int | str = SEED, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per selected document and epoch: doc_id, the levels, n_tokens, epoch, leaf_budget."""
    names = list(levels)
    rows = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), *[F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in levels.items()],
        F.size(words(F.col(text))).cast("long").alias("n_tokens")), "mixing-rows")
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    plan = leaf_budgets(leaves, names, weights, epochs, budget).select(
        *names, F.col("alloc").alias("leaf_budget"),
        F.when(F.col("tokens") > 0, F.expr("alloc div tokens")).otherwise(0).cast("long").alias("_passes"),
        F.when(F.col("tokens") > 0, F.expr("alloc % tokens")).otherwise(0).cast("long").alias("_part"))
    plan = materialize(plan, "mixing-plan")
    dealt = materialize(rows.join(plan, names).withColumn(
        "_u", seeded_order(seed, F.col("_passes"), F.col("doc_id"))), "mixing-dealt")
    whole = dealt.where("_passes > 0").withColumn("epoch", F.explode(F.expr("sequence(0L, _passes - 1)")))
    partial = running_sum(dealt.where("_part > 0"), names, "_u", ["doc_id"], "n_tokens", "_start") \
        .where("_start + n_tokens <= _part").withColumn("epoch", F.col("_passes"))
    out = ["doc_id", *names, "n_tokens", "epoch", "leaf_budget"]
    return whole.select(*out).unionByName(partial.select(*out))
