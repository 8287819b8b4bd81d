"""Report tables: ranked report with proportional bars (W8), ratio to the
first row (W6), predicted-vs-actual (M14) and predictions ordering (O1).

Global scalars (max name length, top value) are one-row aggregates
collected to the driver and inlined as literals — one value, not data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.functions.features import star_space
from velorank.operators.rank import global_rank

# Bar width, name width cap, bar glyph, ellipsis.
BAR_WIDTH = 18
NAME_WIDTH_MAX = 40
BAR_CHAR = "█"
ELLIPSIS = "…"


def rank_predictions(df: DataFrame, value_col: str, tiebreak: str = "pos", rank_col: str = "rank") -> DataFrame:
    """O1: rank 1..n by value descending, ties keep input order; null and NaN come last."""
    value = F.col(value_col).cast("double")
    known = F.when(value.isNotNull() & ~F.isnan(value), value)
    ranked, _ = global_rank(df.withColumn("_vr_v", known), [F.desc_nulls_last("_vr_v"), F.asc(tiebreak)], rank_col)
    return ranked.drop("_vr_v")


def ranked_report(df: DataFrame, name_col: str, value_col: str, tiebreak: str = "pos",
                  rank_col: str | None = None) -> DataFrame:
    """Rank, name cut to min(max len, 40) with an ellipsis, value as an
    int with thousands separators, bar of max(1, round_half_even(18*v/top))
    (T11: ``bround``, and the value is cast to bigint before formatting).
    ``rank_col`` names a rank the rows already carry.  A null or NaN value
    comes last with neither value nor bar."""
    value = F.col(value_col).cast("double")
    known = F.when(value.isNotNull() & ~F.isnan(value), value)
    stats = df.agg(F.max(F.length(name_col)).alias("w"), F.max(known).alias("top")).first()
    width = min(stats["w"] if stats["w"] is not None else 10, NAME_WIDTH_MAX)
    top = float(stats["top"]) if stats["top"] else 1.0
    ranked = df.withColumnRenamed(rank_col, "rank") if rank_col else rank_predictions(df, value_col, tiebreak)
    name = F.col(name_col)
    cut = F.when(F.length(name) <= width, name) \
        .otherwise(F.concat(F.substring(name, 1, width - 1), F.lit(ELLIPSIS)))
    v = known
    bar_len = F.greatest(F.lit(1), F.bround(F.lit(float(BAR_WIDTH)) * v / F.lit(top), 0).cast("int"))
    return ranked.select(
        F.col("rank"), F.col(tiebreak),
        cut.alias("name"),
        F.format_number(v.cast("long"), 0).alias("value_str"),
        F.repeat(F.lit(BAR_CHAR), bar_len).alias("bar"),
    )


def relative_to_first(df: DataFrame, order_col: str, size_col: str, time_col: str) -> DataFrame:
    """``base = time[first] * size[first]``; ratio = base / time.

    The first row by ``order_col`` comes from a ``min_by`` global aggregate
    (partial per task, one value to the driver) — no un-partitioned window,
    whatever the input size."""
    base = df.agg(F.min_by(F.col(time_col) * F.col(size_col), F.col(order_col)).alias("b")).first()["b"]
    return df.withColumn("ratio", F.lit(base).cast("double") / F.col(time_col))


def pred_vs_actual(df: DataFrame, y_col: str, log_pred_col: str) -> DataFrame:
    """Predictions back to star space clipped at 1 (log axes), actual
    clipped at 1, plus the common axis maximum."""
    pred = star_space(F.col(log_pred_col), 1.0)
    actual = F.greatest(F.col(y_col).cast("double"), F.lit(1.0))
    out = df.select("*", pred.alias("pred_stars"), actual.alias("actual_stars"))
    lim = out.agg(F.greatest(F.max("pred_stars"), F.max(F.col(y_col).cast("double"))).alias("m")).first()["m"]
    return out.withColumn("axis_max", F.lit(lim).cast("double"))
