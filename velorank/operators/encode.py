"""Categorical encoding: top-k vocabularies (A1), rare bucketing (E1/F3),
one-hot (E2), missing-cell count (A3), null fill (P14), column alignment (P15).

The vocabularies are the only data brought to the driver (≤ k strings each,
C2); they define output columns, so they must be known at plan time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from velorank.operators.sizing import collect_bounded

# How many categories are kept, and the catch-all bucket.
TOP_LANGS = 20
TOP_LICENSES = 15
OTHER = "other"


def value_counts(df: DataFrame, column: str, order_col: str = "pos") -> DataFrame:
    """Counts per value with the first position it appears at (tie order)."""
    return (df.groupBy(column)
            .agg(F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first_pos")))


def top_values_df(df: DataFrame, column: str, k: int, order_col: str = "pos") -> DataFrame:
    """A1: the k most frequent values, ties by first appearance, with rank.

    Partial/final hash aggregation then ``TakeOrderedAndProject`` — a hot
    value is combined map-side, only one row per value is shuffled."""
    vc = value_counts(df, column, order_col)
    top = vc.orderBy(F.desc("n"), F.asc("first_pos")).limit(k)
    # the window runs over at most k rows (after the limit)
    return top.select(
        F.col(column), F.col("n"),
        F.row_number().over(Window.orderBy(F.desc("n"), F.asc("first_pos"))).alias("rnk"))


def top_values(df: DataFrame, column: str, k: int, order_col: str = "pos") -> list[str]:
    """A1 collected: at most k strings (bounded driver data)."""
    rows = (value_counts(df, column, order_col)
            .orderBy(F.desc("n"), F.asc("first_pos")).limit(k).collect())
    return [r[column] for r in rows]


def rare_bucket(c: Column, keep: Sequence[str]) -> Column:
    """Value if in ``keep`` else 'other' (a literal 'other' merges)."""
    if not keep:
        return F.lit(OTHER)
    return F.when(c.isin(*keep), c).otherwise(F.lit(OTHER))


def present_values(df: DataFrame, column: str, max_values: int = 1000) -> list[str]:
    """Distinct values present (call after bucketing: ≤ k+1), sorted by
    code point like the reference's dummy columns; more than
    ``max_values`` is an error, not a silent cut."""
    rows = collect_bounded(df.select(column).distinct(), max_values, f"vocabulary of {column}")
    vals = [r[0] for r in rows if r[0] is not None]
    return sorted(vals, key=lambda s: s.encode("utf-8"))


def one_hot(df: DataFrame, vocab: dict[str, Sequence[str]], drop_source: bool = True) -> DataFrame:
    """Append ``<col>_<value>`` 0/1 int columns for each vocabulary,
    in the order given (columns first, values ascending)."""
    extra = []
    for column, values in vocab.items():
        for v in values:
            extra.append(F.when(F.col(column) == F.lit(v), 1).otherwise(0).cast("int")
                         .alias(f"{column}_{v}"))
    base = [c for c in df.columns if not (drop_source and c in vocab)]
    return df.select(*[F.col(f"`{c}`") for c in base], *extra)


def missing_cells(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """A3: total null cells over the columns, one global aggregate pass."""
    cols = list(columns or df.columns)
    if not cols:
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("n_missing"))
    total = sum((F.sum(F.col(f"`{c}`").isNull().cast("long")) for c in cols[1:]),
                F.sum(F.col(f"`{cols[0]}`").isNull().cast("long")))
    return df.agg(F.coalesce(total, F.lit(0)).cast("long").alias("n_missing"))


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls in numeric columns -> 0."""
    return df.na.fill(0, subset=list(columns) if columns else None)


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Trained columns in trained order; absent -> 0; extras dropped."""
    present = set(df.columns)
    out = [F.col(f"`{c}`") for c in keep]
    for c in columns:
        out.append(F.col(f"`{c}`") if c in present else F.lit(0).alias(c))
    return df.select(*out)
