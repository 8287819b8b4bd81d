"""Size guards: broadcast only under a checked row bound, collect only a
bounded number of values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: rows a broadcast side may hold (checked at run time).
BROADCAST_MAX_ROWS = 100_000


def broadcast_bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` when it has at most ``max_rows`` rows; otherwise
    leave the join strategy to the planner (shuffle join, AQE skew split).
    The check reads at most ``max_rows + 1`` rows."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list:
    """Collect at most ``max_rows`` rows; more is an error, never a cut."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"{what}: more than {max_rows} rows; refusing to collect to the driver")
    return rows
