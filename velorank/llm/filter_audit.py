"""Filter interaction audit over failing-id relations.

One pass over the texts decides the five filters.  Every filter then is a relation of its own: the
written table of the ids that fail it, with their part and labels.  What a filter removes after a
set of earlier filters is its relation left-anti-joined with the relations of that set; what it
fails but finds gone is the left-semi join.  An order's step depends on the set before it only, so
five relations times sixteen sets answer all 120 orders; all sets of a row travel together, so the
relations are dealt out by id once, whatever the number of orders.  Survivors are the part's
documents less what the steps so far removed.

A: under ``MIN_WORDS`` words.  B: under ``MIN_DISTINCT`` % distinct words.  C: over ``MAX_CAPITALS`` %
capitals A-Z.  D: holds a symbol of ``SYMBOLS``.  E: the same text as a smaller id's, anywhere in the table.

Null text is the empty text.  A null id is neither smaller nor larger than any, so it fails no E and
causes none; it has no label.  Repeated rows are documents of their own; the same id is not a smaller
one.  Several label rows of an id count together: one of them at 1 suffices.  A null part is ''.
Other columns are ignored, whatever their names.  An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import DataFrame, Window as W, functions as F

from velorank.llm.common import let, match_keys, words
from velorank.session import materialize, scratch_path

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_CAPITALS = 10
SYMBOLS = "#$%&*|"


def prefix_sets(f: str) -> list[int]:
    """Bit sets of the filters that can come before ``f``."""
    others = [BIT[g] for g in FILTERS if g != f]
    return [sum(c) for k in range(len(others) + 1) for c in combinations(others, k)]


def orders() -> list[tuple[str, int, str, int]]:
    """(order, step, its filter, bit set before it) of all orders."""
    return [("".join(p), i + 1, f, sum(BIT[g] for g in p[:i])) for p in permutations(FILTERS) for i, f in enumerate(p)]


def orders_through(before: int) -> int:
    """Orders that put exactly the filters of ``before`` ahead of a given other one."""
    k = before.bit_count()
    return factorial(k) * factorial(len(FILTERS) - 1 - k)


def measure(docs: DataFrame, doc_id: str, text: str, part: str) -> DataFrame:
    """(_row, _id, _part, A, B, C, D, _text): the filters of one text, and the text's digest."""
    t = F.coalesce(F.col(text), F.lit(""))
    counted = let(words(F.col(text)), lambda w: F.struct(F.size(w).alias("n"), F.size(F.array_distinct(w)).alias("d")))
    capitals = F.length("_t") - F.length(F.regexp_replace("_t", "[A-Z]+", ""))
    told = docs.select(F.col(doc_id).alias("_id"), F.coalesce(F.col(part), F.lit("")).alias("_part"), t.alias("_t"), counted.alias("_w"))
    return told.select(
        F.monotonically_increasing_id().alias("_row"), "_id", "_part",
        (F.col("_w.n") < MIN_WORDS).alias("A"),
        (F.col("_w.d").cast("long") * 100 < F.col("_w.n").cast("long") * MIN_DISTINCT).alias("B"),
        (capitals.cast("long") * 100 > F.length("_t").cast("long") * MAX_CAPITALS).alias("C"),
        F.col("_t").rlike(f"[{SYMBOLS}]").alias("D"),
        F.unhex(F.sha2(F.col("_t").cast("binary"), 256)).alias("_text"))


def with_labels(rows: DataFrame, labels: DataFrame, doc_id: str) -> DataFrame:
    """Add ``_good`` and ``_toxic`` (0 or 1).  A null id gets a key of its own and meets no label."""
    one = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).cast("long").alias("_key")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
    keyed = rows.withColumns({"_key": F.coalesce(F.col("_id").cast("long"), F.col("_row")), "_named": F.col("_id").isNotNull()})
    return (keyed.join(one.withColumn("_named", F.lit(True)), ["_key", "_named"], "left").drop("_key", "_named")
            .withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("_good", "_toxic")}))


def failing_ids(rows: DataFrame) -> dict[str, DataFrame]:
    """One written relation (_row, _part, _good, _toxic) per filter."""
    spark = rows.sparkSession
    named = rows.where(F.col("_id").isNotNull())
    firsts = named.groupBy("_text").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first")).where("_n > 1")
    copies = match_keys(named, materialize(firsts, "audit-texts"), "_text", "_n", named.count())
    copies = copies.where(F.col("_id") > F.col("_first")).withColumn("filter", F.lit("E"))
    own = rows.withColumn("filter", F.explode(F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in "ABCD"]))))
    kept = ["_row", "_part", "_good", "_toxic", "filter"]
    path = scratch_path(spark, "audit-failing-ids")
    own.select(kept).unionByName(copies.select(kept)).write.partitionBy("filter").parquet(path)
    table = spark.read.schema("_row long, _part string, _good int, _toxic int, filter string").parquet(path)
    return {f: table.where(F.col("filter") == f).drop("filter") for f in FILTERS}


def prefix_losses(failing: dict[str, DataFrame]) -> DataFrame:
    """(_part, filter, before, removed, redundant, good_lost, toxic_lost): what each filter removes after
    each set of earlier filters, by joins between the relations."""
    fails = None
    for f, ids in failing.items():
        own = ids.withColumns({"filter": F.lit(f), "_sets": F.array(*[F.lit(s) for s in prefix_sets(f)])})
        fails = own if fails is None else fails.unionByName(own)
    # dealt out by id before the sets multiply the rows: the joins below move nothing again
    cases = fails.repartition("_row").withColumn("before", F.explode("_sets")).drop("_sets")
    removed = cases
    for f, ids in failing.items():
        gone = ids.select(F.col("_row").alias("_gone"))
        removed = removed.join(gone, (F.col("_row") == F.col("_gone")) & (F.col("before").bitwiseAND(BIT[f]) != 0), "left_anti")
    bits = F.create_map(*[F.lit(x) for f in FILTERS for x in (f, BIT[f])])
    earlier = fails.select(F.col("_row").alias("_gone"), bits[F.col("filter")].alias("_bit"))
    redundant = cases.join(earlier, (F.col("_row") == F.col("_gone")) & (F.col("before").bitwiseAND(F.col("_bit")) != 0), "left_semi")
    keys = ["_part", "filter", "before"]
    lost = removed.groupBy(*keys).agg(F.count(F.lit(1)).alias("removed"), F.sum("_good").alias("good_lost"), F.sum("_toxic").alias("toxic_lost"))
    return lost.join(redundant.groupBy(*keys).agg(F.count(F.lit(1)).alias("redundant")), keys, "full_outer")


def audit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """One row per part, order of the filters and step; see the module's text."""
    spark = docs.sparkSession
    rows = materialize(measure(docs, doc_id, text, part), "audit-measures")
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_docs"))
    cases = [F.struct(F.lit(f).alias("filter"), F.lit(s).alias("before")) for f in FILTERS for s in prefix_sets(f)]
    losses = prefix_losses(failing_ids(materialize(with_labels(rows, labels, doc_id), "audit-labelled")))
    counts = ["removed", "redundant", "good_lost", "toxic_lost"]
    full = (parts.withColumn("_case", F.explode(F.array(*cases))).select("_part", "_docs", "_case.*")
            .join(losses, ["_part", "filter", "before"], "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in counts}))
    full = materialize(full, "audit-sets")                    # 80 rows a part
    through = F.lit(0)
    for s in sorted({s for f in FILTERS for s in prefix_sets(f)}):
        through = F.when(F.col("before") == s, orders_through(s)).otherwise(through)
    everything = sum(BIT.values())
    bits = F.create_map(*[F.lit(x) for f in FILTERS for x in (f, BIT[f])])
    alone = F.col("before") == everything - bits[F.col("filter")]
    by_filter = full.groupBy("_part", "filter").agg(
        F.sum(F.col("removed") * through).cast("long").alias("shapley"),
        F.sum(F.when(alone, F.col("removed")).otherwise(0)).cast("long").alias("unique_fails"))
    steps = spark.createDataFrame(orders(), "filter_order string, step int, filter string, before int")     # 600 fixed rows
    so_far = W.partitionBy("_part", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    return (full.join(F.broadcast(steps), ["filter", "before"]).join(by_filter, ["_part", "filter"])
            .select(F.col("_part").alias("part"), "filter_order", "step",
                    (F.col("_docs") - F.sum("removed").over(so_far)).cast("long").alias("kept"),
                    "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"))
