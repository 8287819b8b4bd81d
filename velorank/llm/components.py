"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from velorank.session import materialize

MAX_ROUNDS = 60
LEAST_TASKS, LINKS_A_TASK = 8, 200_000


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node that has a link to another; component is the smallest node.

    Every round rewires links towards smaller nodes (first neighbours larger than a node, then
    smaller ones) and is written to the shared folder.  Minima are partial aggregates and are
    written before they are joined, so a node with very many links is split by the skew join.
    The number of tasks follows the number of links."""
    low, high = F.least(a, b), F.greatest(a, b)
    now = materialize(edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "cc-links")
    mark = _mark(now)
    tasks = max(LEAST_TASKS, -(-mark[0] // LINKS_A_TASK))
    keep = lambda df, name: materialize(df.coalesce(tasks), name)
    for _ in range(MAX_ROUNDS):
        if mark[0] == 0:
            break
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = keep(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "cc-least")
        # a node's larger neighbours link to its smallest one
        large = keep(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .distinct(), "cc-large")
        least = keep(large.groupBy("u").agg(F.min("v").alias("m")), "cc-least")
        # so do its smaller neighbours, and the node itself
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = keep(small.union(least).distinct(), "cc-links")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError("connected components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def _mark(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return r["n"], r["h"]
