"""Distributed global ordering (C1) and the operators built on it.

``global_rank`` gives 1..n over a total order without a single-partition
window (a bare ``row_number() over (order by ...)`` moves every row into
one task):

1. ``repartitionByRange`` on the full, unique sort key.  Spark samples range
   bounds; because the tiebreak columns are part of the key, a value held by
   a third of all rows is still cut into many partitions.
2. ``sortWithinPartitions`` + ``spark_partition_id`` + per-partition row
   index (``monotonically_increasing_id`` minus the partition's base).
3. A table written to the shared checkpoint folder pins partition id and
   row index (sampling happens once; a lost executor re-reads the table).
4. Per-partition counts (one row per partition — bounded by the partition
   count, not by the data) become a small table of offsets that is joined back.

Rank within groups subtracts each group's first global rank, an aggregate
joined back null-safely.  No step depends on the number of groups or on N.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.functions.arith import idiv

from velorank.session import materialize

_PID, _MID = "_vr_pid", "_vr_mid"


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def global_rank(df: DataFrame, order: Sequence[Column | str], rank_col: str = "rank",
                num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """1-based rank over ``order`` (must be a total order: end it with a
    unique column).  Returns the ranked frame and the row count."""
    sort = _sort_cols(order)
    # without an explicit count AQE may coalesce adjacent ranges (order kept)
    ranged = (df.repartitionByRange(num_partitions, *sort) if num_partitions else df.repartitionByRange(*sort))
    ranged = (ranged
              .sortWithinPartitions(*sort)
              .withColumn(_PID, F.spark_partition_id())
              .withColumn(_MID, F.monotonically_increasing_id()))
    ranged = materialize(ranged)
    counts = {r[_PID]: r["n"] for r in
              ranged.groupBy(_PID).agg(F.count(F.lit(1)).alias("n")).collect()}
    top = max(counts) + 1 if counts else 0
    offsets, acc = [], 0
    for pid in range(top):
        offsets.append(acc)
        acc += counts.get(pid, 0)
    total = acc
    if top == 0:
        return ranged.drop(_PID, _MID).withColumn(rank_col, F.lit(None).cast("long")), 0
    table = df.sparkSession.createDataFrame(list(enumerate(offsets)), f"{_PID} int, _vr_off long")
    local_idx = F.col(_MID) - F.shiftleft(F.col(_PID).cast("long"), 33)
    # one offset per range partition: bounded by the partition count
    ranked = ranged.join(F.broadcast(table), _PID).withColumn(rank_col, F.col("_vr_off") + local_idx + F.lit(1))
    return ranked.drop(_PID, _MID, "_vr_off"), total


def null_safe_join(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null equals null; the keys of ``df`` stay."""
    named = side
    for k in keys:
        named = named.withColumnRenamed(k, f"_vr_k_{k}")
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_vr_k_{k}"))
    return df.join(named, on, how).drop(*[f"_vr_k_{k}" for k in keys])


def rank_within(df: DataFrame, group: Sequence[str], order: Sequence[Column | str],
                rank_col: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """1-based rank of ``order`` inside each ``group`` (a distributed
    ``row_number() over (partition by group order by ...)`` that stays
    balanced when one group holds most rows; null is a group of its own).

    Group starts come from one aggregate over the written ranking and are
    joined back null-safely."""
    ranked, _ = global_rank(df, [*group, *_sort_cols(order)], "_vr_g", num_partitions)
    # written, so that the planner knows its size: few groups are broadcast, and no task gets a whole group's rows
    starts = materialize(ranked.groupBy(*group).agg(F.min("_vr_g").alias("_vr_start")), "group-starts")
    out = null_safe_join(ranked, starts, list(group))
    return out.withColumn(rank_col, F.col("_vr_g") - F.col("_vr_start") + F.lit(1)).drop("_vr_g", "_vr_start")


def qcut_bucket(rank: Column, n: int, q: int = 5) -> Column:
    """``pd.qcut(rank, q, labels=False)`` for ranks 1..n — right-closed,
    linearly interpolated edges; not ``ntile``."""
    if n < 2:  # T13: no division by n - 1 = 0
        return F.lit(0).cast("int")
    bucket = idiv((F.lit(q) * (rank - 1) + F.lit(n - 2)).cast("long"), F.lit(n - 1)) - 1
    return F.greatest(bucket, F.lit(0)).cast("int")


# Salt buckets of the first stage of a top-N per group.
TOP_N_SALTS = 64


def top_n_per_group(df: DataFrame, group: str, order: Sequence[Column], n: int | None,
                    rank_col: str = "_vr_n", salts: int = TOP_N_SALTS, keep_rank: bool = False) -> DataFrame:
    """First ``n`` rows per ``group`` in ``order`` (n falsy = all rows); null is a group.

    The top n per (group, salt) are reduced from all salts to an eighth of them and on to one: a group
    holding a third of all rows is spread over the salts, and a task of the later stages gets 8 n rows of a
    group at most, the same for every n."""
    from pyspark.sql.window import Window
    if not n:
        return df
    order = list(order)
    # salt from the row's scalar columns (nested payloads add cost, not spread)
    scalar = [f.name for f in df.schema.fields
              if f.dataType.typeName() not in ("struct", "array", "map")] or df.columns
    out = df.withColumn("_vr_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in scalar]), F.lit(salts)))
    while True:
        window = Window.partitionBy(group, "_vr_salt").orderBy(*order)
        out = out.withColumn(rank_col, F.row_number().over(window)).where(F.col(rank_col) <= n)
        if salts == 1:
            break
        salts = -(-salts // 8)
        out = out.drop(rank_col).withColumn("_vr_salt", F.pmod(F.col("_vr_salt"), F.lit(salts)))
    out = out.drop("_vr_salt")
    return out if keep_rank else out.drop(rank_col)


def qcut_counts(n: int, q: int = 5) -> dict[int, int]:
    """Rows per ``qcut_bucket`` for ranks 1..n, from the closed form
    (bucket is monotone in the rank: binary search each upper edge)."""
    if n < 2:
        return {0: n} if n else {}

    def bucket(r: int) -> int:
        return max((q * (r - 1) + n - 2) // (n - 1) - 1, 0)

    counts, prev = {}, 0
    for b in range(q):
        lo, hi = prev, n  # last rank with bucket <= b
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if bucket(mid) <= b:
                lo = mid
            else:
                hi = mid - 1
        if lo > prev:
            counts[b] = lo - prev
        prev = lo
    return counts


def fold_id(rank0: Column, n: int, k: int = 5) -> Column:
    """Contiguous block k-fold id of a 0-based position (first n%k
    blocks one longer) — the closed form of ``ntile(k) - 1``."""
    q, m = divmod(n, k)
    if q == 0:
        return rank0.cast("int")
    big = m * (q + 1)
    return F.when(rank0 < big, idiv(rank0, q + 1)) \
        .otherwise(F.lit(m) + idiv((rank0 - big), q)).cast("int")


def stride_keep(rank0: Column, n: int, k: int) -> Column:
    """O3 predicate: keep position r0 iff r0 = int(i * (n / k)) for some
    0 <= i < k (float step, truncated, as in a Python list stride)."""
    if not k or k >= n:
        return F.lit(True)
    step = float(n) / float(k)
    r = rank0.cast("double")
    i0 = F.floor(r / F.lit(step))
    hit = F.lit(False)
    for d in (-1, 0, 1):
        i = i0 + F.lit(d)
        hit = hit | ((i >= 0) & (i < k) & (F.floor(i.cast("double") * F.lit(step)) == rank0))
    return hit


def stride_sample(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """O3: k rows evenly spaced over the ordered frame."""
    ranked, n = global_rank(df, order, "_vr_r")
    return ranked.where(stride_keep(F.col("_vr_r") - 1, n, k)).drop("_vr_r")
