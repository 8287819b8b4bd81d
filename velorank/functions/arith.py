"""Integer arithmetic helpers missing from the Column API."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column | int) -> Column:
    """SQL ``a div b``: integral division, truncated toward zero, exact
    for any long (no detour through double)."""
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b))
