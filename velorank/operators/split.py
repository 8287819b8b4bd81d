"""Stratified train/test split (W5) and k-fold ids.

Stratum quotas follow largest-remainder allocation: ``n_test = ceil(0.2 n)``,
the train share of each stratum is ``floor(n_train * c / n)`` plus one for
the largest remainders (ties to the lower stratum); test takes the rest.
Members are chosen by a seeded content hash, ranked within the stratum with
the distributed rank (no per-stratum single task).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.operators.order_stats import after, cut_points
from velorank.operators.rank import null_safe_join, qcut_counts, rank_within
from velorank.session import materialize


def split_hash(key: Column, seed: int) -> Column:
    """Deterministic shuffle key: md5(key || ':' || seed)."""
    return F.md5(F.concat(key, F.lit(f":{seed}")))


def train_quotas(counts: dict[int, int], test_size: float = 0.2) -> dict[int, int]:
    """Train rows per stratum (largest remainder, ties -> lower stratum)."""
    n = sum(counts.values())
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    keys = sorted(counts)
    cont = {k: counts[k] / n * n_train for k in keys}
    floor = {k: math.floor(cont[k]) for k in keys}
    need = n_train - sum(floor.values())
    order = sorted(keys, key=lambda k: (-(cont[k] - floor[k]), k))
    for k in order[:need]:
        floor[k] += 1
    return floor


def quota_table(df: DataFrame, stratum_col: str, test_size: float) -> DataFrame:
    """(stratum, quota): ``train_quotas`` as a query over one row per stratum, so their number is not
    limited.  Remainders compare as integers (``n_train * c mod n``); a null stratum comes first."""
    sizes = df.groupBy(stratum_col).agg(F.count(F.lit(1)).alias("_c"))
    n = sizes.agg(F.sum("_c").alias("n")).first()["n"] or 0
    n_train = n - math.ceil(test_size * n)
    floors = sizes.withColumns({
        "_q": F.expr(f"cast(_c as decimal(38, 0)) * {n_train} div {max(n, 1)}").cast("long"),
        "_r": F.expr(f"cast(_c as decimal(38, 0)) * {n_train} % {max(n, 1)}")})
    need = n_train - (floors.agg(F.sum("_q").alias("q")).first()["q"] or 0)
    more = floors.orderBy(F.col("_r").desc(), F.col(stratum_col).asc_nulls_first()).limit(int(need)) \
        .select(stratum_col, F.lit(1).alias("_vr_more"))
    return null_safe_join(floors, more, [stratum_col], "left").select(
        stratum_col, (F.col("_q") + F.coalesce("_vr_more", F.lit(0))).alias("_vr_quota"))


def stratified_split(df: DataFrame, stratum_col: str, key_col: str = "full_name",
                     test_size: float = 0.2, seed: int = 0, split_col: str = "split") -> DataFrame:
    """Add ``split`` ('train' / 'test') keeping stratum proportions; null is a stratum, null keys count as ''."""
    hashed = df.withColumn("_vr_h", split_hash(F.coalesce(F.col(key_col), F.lit("")), seed))
    ranked = rank_within(hashed, [stratum_col], ["_vr_h", key_col], "_vr_srank")
    quotas = quota_table(df, stratum_col, test_size)
    return (null_safe_join(ranked, quotas, [stratum_col])
            .withColumn(split_col, F.when(F.col("_vr_srank") <= F.col("_vr_quota"), F.lit("train")).otherwise(F.lit("test")))
            .drop("_vr_srank", "_vr_h", "_vr_quota"))


def hash_order(key: Column, seed: int) -> Column:
    """The first 60 bits of ``split_hash`` as a number in the same order."""
    return F.conv(F.substring(split_hash(F.coalesce(key, F.lit("")), seed), 1, 15), 16, 10).cast("long")


def assign_folds(train: DataFrame, key_col: str = "full_name", seed: int = 0, k: int = 5,
                 fold_col: str = "fold", tiebreak: str = "pos") -> DataFrame:
    """Contiguous folds over the train rows in their shuffled (hash)
    order — never ingest order, which would hold out whole star ranges (T14).

    The k - 1 cut points come from exact order statistics; the fold is then
    a comparison with literals: no sort, no join, no row multiplied."""
    u, t = hash_order(F.col(key_col), seed), F.col(tiebreak)
    keys = materialize(train.select(u.alias("_u"), t.alias("_t")), "fold-keys")     # hashed once
    n = keys.count()
    ends = [r for r in _fold_ends(n, k)[:-1] if 0 < r < n]
    cuts = cut_points(keys, F.col("_u"), F.col("_t"), {None: sorted(set(ends))}) if ends else {}
    fold = sum((after(u, t, cuts[None, r]).cast("int") for r in ends), F.lit(0))
    return train.withColumn(fold_col, fold.cast("int"))


def _fold_ends(n: int, k: int) -> list[int]:
    """Last rank of every fold: the first n % k folds are one longer."""
    out, at = [], 0
    for i in range(k):
        at += n // k + (1 if i < n % k else 0)
        out.append(at)
    return out


def stratified_cuts(df: DataFrame, target: str, n: int, q: int, key_col: str, tiebreak: str,
                    test_size: float, seed: int) -> tuple[Column, Column]:
    """W4 + W5 as expressions over the rows of ``df``: (bucket, split).

    Buckets are cut at the last rank of each of the q equal-frequency
    buckets in (target, tiebreak) order, the split at each bucket's quota in
    hash order; both cuts are exact order statistics of narrow columns."""
    y, t, u = F.coalesce(F.col(target).cast("long"), F.lit(-1)), F.col(tiebreak), hash_order(F.col(key_col), seed)
    narrow = materialize(df.select(y.alias("_y"), t.alias("_t"), u.alias("_u")), "split-keys")     # hashed once
    counts = qcut_counts(n, q)
    ends, at = [], 0
    for b in sorted(counts):
        at += counts[b]
        ends.append(at)
    inner = ends[:-1]
    cuts = cut_points(narrow, F.col("_y"), F.col("_t"), {None: inner}) if inner else {}
    order = sorted(counts)

    def bucket_of(y: Column, t: Column) -> Column:
        place = sum((after(y, t, cuts[None, r]).cast("int") for r in inner), F.lit(0))
        return F.element_at(F.array(*[F.lit(b) for b in order or [0]]), place + 1).cast("int")

    bucket = bucket_of(y, t)
    quotas = train_quotas(counts, test_size) if n else {}
    wanted = {b: [m] for b, m in quotas.items() if m}
    last = cut_points(narrow, F.col("_u"), F.col("_t"), wanted, bucket_of(F.col("_y"), F.col("_t"))) if wanted else {}
    train = F.lit(False)
    for b, ranks in wanted.items():
        train = train | ((bucket == b) & ~after(u, t, last[b, ranks[0]]))
    return bucket, F.when(train, F.lit("train")).otherwise(F.lit("test"))
