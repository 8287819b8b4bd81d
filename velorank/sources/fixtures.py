"""The ``repos`` entity table derived from the driver's TPC-H-ish tables.

One entity per order (FIXTURES.md F-4).  Everything is integer arithmetic
over orders / lineitem / customer / nation so Spark and DuckDB agree exactly.

Plan shape at scale: lineitem is pre-aggregated per order (partial + final
hash aggregate, map-side combine), the aggregate's hash partitioning on the
order key is reused by the orders join, customer joins by a shuffle on the
customer key, and nation (25 rows in TPC-H, a fixed size) is broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velorank.functions.arith import idiv
from velorank.operators.sizing import broadcast_bounded

from velorank.session import ensure_utc, read_table
from velorank.sources.schema import TS_FORMAT

# Fixed value: the as-of instant used by every day-count query.
AS_OF = "2002-01-01T00:00:00Z"


def _ts(epoch_seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(epoch_seconds), TS_FORMAT)


def repos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``repos`` view: F-1 columns plus ``pos`` (the order key)."""
    ensure_utc(spark)
    orders = read_table(spark, sf_dir, "orders")
    lineitem = read_table(spark, sf_dir, "lineitem")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    li = (lineitem.groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("n_lines"),
               F.max("l_partkey").alias("partkey"),
               F.sum("l_quantity").cast("bigint").alias("qty")))
    base = (orders
            .join(li, orders.o_orderkey == li.l_orderkey, "left")
            .join(customer, orders.o_custkey == customer.c_custkey, "inner")
            .join(broadcast_bounded(nation), F.col("c_nationkey") == F.col("n_nationkey"), "inner")
            .withColumn("band_lo", F.lit(50) * F.pow(F.lit(2), F.col("o_orderkey") % 13).cast("bigint"))
            .withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
            .withColumn("day_s", F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("bigint")))
    s = base.withColumn("stars", F.col("band_lo") + F.col("cents") % F.col("band_lo"))
    stars, cents, okey, ckey = F.col("stars"), F.col("cents"), F.col("o_orderkey"), F.col("o_custkey")
    day_s = F.col("day_s")
    return s.select(
        okey.alias("pos"),
        F.concat(F.lit("user"), ckey.cast("string"), F.lit("/repo"), okey.cast("string")).alias("full_name"),
        stars.alias("stargazers_count"),
        idiv(stars, 3 + ckey % 17).alias("forks_count"),
        idiv(stars, 20 + cents % 31).alias("watchers"),
        idiv(stars, 50).alias("open_issues_count"),
        (idiv(stars, 50) + idiv(stars, 5 + cents % 7)).alias("total_issues_count"),
        (cents % 51).alias("open_pulls_count"),
        F.when(okey % 11 == 0, F.lit(None)).otherwise(cents % 61).alias("release_count"),
        (F.col("qty") % 11).alias("topics_count"),
        (1 + idiv(stars, 2) + F.coalesce(F.col("qty"), F.lit(0))).alias("commit_count"),
        (100 + cents % 500000).alias("disk_usage"),
        F.when(okey % 9 == 0, F.lit(None)).otherwise(F.col("n_name")).alias("language"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("c_mktsegment") == "FURNITURE"), F.lit(None))
         .otherwise(F.lower(F.concat(F.col("c_mktsegment"), F.lit("-"),
                                     F.substring("o_orderpriority", 1, 1), F.col("o_orderstatus"))))
         .alias("license_key"),
        _ts(day_s + cents % 86400).alias("created_at"),
        _ts(day_s + cents % 86400 + 864000).alias("updated_at"),
        F.when(okey % 13 == 5, F.lit(None)).otherwise(_ts(day_s + cents % 8640000)).alias("pushed_at"),
        (okey % 20 == 0).alias("is_archived"),
        F.lit(False).alias("is_fork"),
        F.lit(False).alias("is_disabled"),
        F.lit(False).alias("is_mirror"),
        F.lit(True).alias("has_issues"),
        (okey % 10 < 7).alias("has_wiki"),
        (okey % 2 == 0).alias("has_projects"),
        (okey % 10 < 3).alias("has_discussions"),
        F.repeat(F.lit("x"), (cents % 121).cast("int")).alias("description"),
        F.when(ckey % 3 == 0, F.lit("Organization")).otherwise(F.lit("User")).alias("owner_type"),
    )


def repos_with_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``repos`` plus re-emitted copies of every 10th entity (same name,
    changed counts, ``pos + 10^9``) — the input of first-wins dedupe."""
    r = repos(spark, sf_dir)
    dup = (r.where(F.col("pos") % 10 == 0)
           .withColumn("pos", F.col("pos") + F.lit(1_000_000_000))
           .withColumn("stargazers_count", F.col("stargazers_count") * 2 + 1)
           .withColumn("forks_count", F.col("forks_count") + 1))
    return r.unionByName(dup)
