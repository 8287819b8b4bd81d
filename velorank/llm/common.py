"""Shared pieces of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: Java regex of the white space that separates words; everything else is a word character.
SPACES = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: inside a higher-order
    function Spark would otherwise evaluate it again for every element."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The words of a text; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def private(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as keep it apart from every column of ``df`` (case aside)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; null for a null id."""
    return F.crc32(doc_id.cast("string")) % mod


def seeded_order(seed: int | str, *cols: Column) -> Column:
    """A uniform 60-bit order key, the same in every engine that has md5.  Nulls count as ''."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)), 1, 15), 16, 10).cast("long")


def running_sum(rows: DataFrame, keys: list[str], order: str, ties: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``keys`` that come before in
    (``order``, ``ties``) order.  ``order`` is a uniform 60-bit key (``seeded_order``).

    A group of n rows is cut into about sqrt(n) buckets by its order key; bucket sums give each
    bucket's start and only rows of one bucket are sorted together, so a key that holds a third
    of all rows is spread over many tasks.  Pass rows that are cheap to read again (a written
    table): they are read three times.  Key columns must not be null."""
    sizes = rows.groupBy(*keys).agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("_nb"))
    dealt = rows.join(sizes, keys).withColumn(
        "_b", F.shiftright(F.shiftright(F.col(order), 20) * F.col("_nb"), 40)).drop("_nb")
    # dealt by group and bucket: a join's partitioning by the group alone would satisfy the windows too
    dealt = dealt.repartition(*keys, "_b")
    by_bucket = W.partitionBy(*keys).orderBy("_b")
    starts = (dealt.groupBy(*keys, "_b").agg(F.sum(value).alias("_sum"))
              .withColumn("_start", F.sum("_sum").over(by_bucket.rowsBetween(W.unboundedPreceding, 0)) - F.col("_sum"))
              .drop("_sum"))
    inside = W.partitionBy(*keys, "_b").orderBy(order, *ties).rowsBetween(W.unboundedPreceding, -1)
    return (dealt.join(starts, [*keys, "_b"])
            .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("_b", "_start"))


HOT_KEYS = 1024


def match_keys(rows: DataFrame, table: DataFrame, key: str, count: str, total: int) -> DataFrame:
    """Inner join of ``rows`` (``total`` of them) with a written ``table`` of one row per key, whose
    column ``count`` says how many of the rows hold that key.

    Keys of at least 1 in ``HOT_KEYS`` rows are at most ``HOT_KEYS`` many: those go to all tasks, so that
    no task gets all rows of a hot key; the other keys are joined by a shuffle."""
    is_hot = F.col(count) * HOT_KEYS >= total
    hot = F.broadcast(table.where(is_hot))
    rest = rows.join(F.broadcast(table.where(is_hot).select(key)), key, "left_anti")
    return rows.join(hot, key).unionByName(rest.join(table.where(~is_hot).hint("merge"), key))
