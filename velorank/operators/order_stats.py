"""Exact order statistics without a sort.

A mergeable quantile sketch brackets every wanted rank, one pass counts exactly what is below and inside
the brackets, one reads the brackets' values: three passes of partial aggregates over a narrow column.  A
bracket that misses its rank is widened; one with too many values is bracketed again.  Only sketches,
counts and at most ``READ`` values a bracket reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRID = 1024                        # quantiles of a sketch
ACCURACY = 10_000                  # its ranks are within 1 / ACCURACY of the rows
READ = 1 << 16                     # rows of a bracket that are read at last


def kth_values(df: DataFrame, value: Column, wanted: Mapping[object, Sequence[int]],
               group: Column | None = None, kind: str = "long") -> dict[tuple, tuple]:
    """{(group, rank): (value, rows of the group with a smaller value)} for
    1-based ranks by group (key None without groups).  Values are of ``kind``, not null."""
    name = lambda g: 0 if g is None else g
    keyed = df.select((group if group is not None else F.lit(0)).alias("g"), value.cast(kind).alias("v")).where(F.col("g").isin([name(g) for g in wanted]))
    grid = [i / GRID for i in range(GRID + 1)]
    found: dict[tuple, tuple] = {}
    # open searches: (group, rank) -> (low, high, rows below low); no limits at first
    search: dict[tuple, tuple] = {(g, r): (None, None, 0) for g, ranks in wanted.items() for r in ranks}

    def inside(g, lo, hi) -> Column:
        here = F.col("g") == name(g)
        return here if lo is None else here & F.col("v").between(F.lit(lo), F.lit(hi))

    while search:
        # brackets of a group may meet but each is sketched from its own rows: one entry per row and bracket
        brackets = sorted({(g, lo, hi) for (g, _), (lo, hi, _) in search.items()}, key=str)
        own = F.array_compact(F.array(*[F.when(inside(*b), F.lit(i)) for i, b in enumerate(brackets)]))
        told = {r["i"]: r for r in keyed.select(F.explode(own).alias("i"), "v").groupBy("i").agg(
            F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.percentile_approx("v", grid, ACCURACY).alias("q")).collect()}
        tries: dict[tuple, list] = {}
        for key, (lo, hi, below) in search.items():
            s = told.get(brackets.index((key[0], lo, hi)))
            if s is None or not 0 < key[1] - below <= s["n"]:
                raise ValueError(f"rank {key[1]} is beyond the rows of group {key[0]}")
            tries[key] = [s, (key[1] - below) / s["n"], 2]
        waiting, search_next, read = dict(tries), {}, {}
        while waiting:
            spans = {}
            for key, (s, p, margin) in waiting.items():
                a, b = int(p * GRID) - margin, int(p * GRID) + 1 + margin
                spans[key] = (s["lo"] if a <= 0 else s["q"][a], s["hi"] if b >= GRID else s["q"][b])
            names = list(spans)
            counts = keyed.agg(*[F.count_if((F.col("g") == name(k[0])) & (F.col("v") < F.lit(spans[k][0]))).alias(f"b{i}") for i, k in enumerate(names)],
                               *[F.count_if(inside(k[0], *spans[k])).alias(f"n{i}") for i, k in enumerate(names)]).first()
            for i, key in enumerate(names):
                below, n = counts[f"b{i}"], counts[f"n{i}"]
                if not below < key[1] <= below + n:
                    waiting[key][2] *= 4
                    continue
                del waiting[key]
                lo, hi = spans[key]
                if lo == hi:
                    found[key] = (lo, below)
                elif n <= READ:
                    read[key] = (lo, hi, below)
                elif (lo, hi) == (search[key][0], search[key][1]):      # both ends are values of many rows: go inside them
                    v = F.col("v")
                    r = keyed.where(inside(key[0], lo, hi)).agg(F.count_if(v == lo).alias("lo"), F.count_if(v == hi).alias("hi"),
                                                                F.min(F.when(v > lo, v)).alias("next"), F.max(F.when(v < hi, v)).alias("last")).first()
                    if key[1] <= below + r["lo"]:
                        found[key] = (lo, below)
                    elif key[1] > below + n - r["hi"]:
                        found[key] = (hi, below + n - r["hi"])
                    else:
                        search_next[key] = (r["next"], r["last"], below + r["lo"])
                else:
                    search_next[key] = (lo, hi, below)
        if read:
            parts = sorted({(k[0], lo, hi) for k, (lo, hi, _) in read.items()}, key=str)
            own = F.array_compact(F.array(*[F.when(inside(*b), F.lit(i)) for i, b in enumerate(parts)]))
            values: dict[int, list] = {}
            for r in keyed.select(F.explode(own).alias("i"), "v").groupBy("i", "v").agg(F.count(F.lit(1)).alias("n")).collect():
                values.setdefault(r["i"], []).append((r["v"], r["n"]))
            for key, (lo, hi, below) in read.items():
                for v, n in sorted(values[parts.index((key[0], lo, hi))]):
                    if below + n >= key[1]:
                        found[key] = (v, below)
                        break
                    below += n
        search = search_next
    return found


def cut_points(df: DataFrame, value: Column, tiebreak: Column, wanted: Mapping[object, Sequence[int]],
               group: Column | None = None) -> dict[tuple, tuple[int, int]]:
    """{(group, rank): (value, tiebreak)} of the row at each rank in (value, tiebreak) order.

    ``tiebreak`` is a unique long: only rows that share a cut's value are searched by it."""
    found = kth_values(df, value, wanted, group)
    ties: dict[str, list[int]] = {}
    rows, marks = [], F.lit(None).cast("string")
    for (g, rank), (v, below) in found.items():
        name = f"{g}/{v}"
        if name not in ties:
            here = value.cast("long") == v
            here = here & (group == g) if group is not None and g is not None else here
            marks = F.when(here, F.lit(name)).otherwise(marks)
        ties.setdefault(name, []).append(rank - below)
        rows.append(((g, rank), v, name, rank - below))
    tied = kth_values(df.select(marks.alias("_tie"), tiebreak.alias("_tb")).where(F.col("_tie").isNotNull()), F.col("_tb"), ties, F.col("_tie"))
    return {key: (v, tied[name, r][0]) for key, v, name, r in rows}


def after(value: Column, tiebreak: Column, cut: tuple[int, int]) -> Column:
    """Whether a row stands after a cut point."""
    v, t = cut
    return (value > F.lit(v)) | ((value == F.lit(v)) & (tiebreak > F.lit(t)))
