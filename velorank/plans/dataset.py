"""E3 dataset build: raw entity rows -> one feature table with a split column
(one keyed table — never X and y joined by position, T12).

S1 -> P10 -> A1 -> E1 -> E2 -> A3/P14 -> W3 -> W4 -> W5 -> (S4, S5)

The feature table is written once to the shared checkpoint folder (it
feeds the vocabulary aggregates, the missing-cell count and the rank);
every later step reads only the columns it needs from that copy instead of
recomputing the scan and its joins.
"""

from __future__ import annotations

import math

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.functions.features import NUMERIC_FEATURES, make_features
from velorank.operators.encode import (OTHER, TOP_LANGS, TOP_LICENSES, fill_zero, one_hot, rare_bucket,
                                       value_counts)
from velorank.operators.sizing import collect_bounded
from velorank.operators.split import stratified_cuts
from velorank.session import materialize

TARGET = "stargazers_count"
KEY_COLS = ["pos", "full_name"]


@dataclass
class Dataset:
    df: DataFrame                      # pos, full_name, split, bucket, target, features...
    feature_columns: list[str]
    top_langs: list[str]
    top_licenses: list[str]
    uses_contributors: bool
    n_train: int
    n_test: int
    n_missing: int

    def meta(self) -> dict:
        return {
            "target": TARGET,
            "feature_columns": self.feature_columns,
            "top_langs": self.top_langs + [OTHER],
            "top_licenses": self.top_licenses + [OTHER],
            "uses_contributors": self.uses_contributors,
            "n_train": self.n_train,
            "n_test": self.n_test,
        }


def vocabularies(df: DataFrame, ks: dict[str, int]) -> dict[str, tuple[list[str], list[str]]]:
    """Top-k vocabularies of several columns in ONE aggregate pass.

    Values are tagged with their column, counted with their first position
    (partial/final aggregate), and the k+1 most frequent per column are kept
    (a per-column row_number <= k+1, planned as WindowGroupLimit); a
    (k+1)-th value means 'other' occurs.  At most sum(k+1) rows reach the
    driver."""
    from pyspark.sql.window import Window
    tagged = df.select("pos", F.explode(F.array(*[
        F.struct(F.lit(c).alias("col"), F.col(c).cast("string").alias("v")) for c in ks])).alias("t"))
    vc = (tagged.groupBy(F.col("t.col").alias("col"), F.col("t.v").alias("v"))
          .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first_pos")))
    w = Window.partitionBy("col").orderBy(F.desc("n"), F.asc("first_pos"))
    limit = max(ks.values()) + 1
    ranked = vc.withColumn("r", F.row_number().over(w)).where(F.col("r") <= limit)
    rows = collect_bounded(ranked.select("col", "v", "r"), limit * len(ks), "vocabularies")
    out = {}
    for c, k in ks.items():
        mine = sorted((r["r"], r["v"]) for r in rows if r["col"] == c and r["r"] <= k + 1)
        top = [v for _, v in mine[:k]]
        present = set(top) | ({OTHER} if len(mine) > k else set())
        out[c] = (top, sorted(present, key=lambda s: s.encode("utf-8")))
    return out


def build_dataset(repos: DataFrame, as_of: str, top_langs: int = TOP_LANGS, top_licenses: int = TOP_LICENSES,
                  q: int = 5, test_size: float = 0.2, seed: int = 0, vocab_on: str = "all") -> Dataset:
    """``vocab_on='all'`` computes the top-k vocabularies over every row
    before the split (the reference's behaviour); ``'train'`` uses only the
    train rows (no test information in the encoding)."""
    feats = materialize(make_features(repos, as_of, keep=("pos", "full_name", TARGET)))

    # strata and split: literal cut points on narrow columns, no sort and no join
    n = feats.count()
    bucket, part = stratified_cuts(feats.select("pos", "full_name", TARGET), TARGET, n, q, "full_name", "pos", test_size, seed)
    if vocab_on == "train":
        vocab_rows = feats.where(part == "train")
    elif vocab_on == "all":
        vocab_rows = feats
    else:
        raise ValueError("vocab_on must be 'all' or 'train'")
    vocab = vocabularies(vocab_rows, {"language": top_langs, "license_key": top_licenses})
    top_l, langs = vocab["language"]
    top_lic, lics = vocab["license_key"]
    if vocab_on == "train":
        # values seen only in test still bucket to 'other'
        langs = sorted(set(langs) | {OTHER}, key=lambda s: s.encode("utf-8"))
        lics = sorted(set(lics) | {OTHER}, key=lambda s: s.encode("utf-8"))
    bucketed = feats.select(
        *[c for c in feats.columns if c not in ("language", "license_key")],
        rare_bucket(F.col("language"), top_l).alias("language"),
        rare_bucket(F.col("license_key"), top_lic).alias("license_key"))
    encoded = one_hot(bucketed, {"language": langs, "license_key": lics})
    onehot_cols = [f"language_{v}" for v in langs] + [f"license_key_{v}" for v in lics]
    feature_cols = NUMERIC_FEATURES + onehot_cols

    # A2 + A3 in one aggregate pass
    agg = encoded.agg(
        F.coalesce(F.max((F.col("contributor_count") > 0).cast("int")), F.lit(0)).alias("uses_contrib"),
        *[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"_m{i}") for i, c in enumerate(feature_cols)]).first()
    stats = {"uses_contrib": agg["uses_contrib"]}
    n_missing = sum(agg[f"_m{i}"] or 0 for i in range(len(feature_cols)))
    encoded = fill_zero(encoded, feature_cols) if n_missing else encoded

    n_train = n - math.ceil(test_size * n)
    out = encoded.select(
        *KEY_COLS, part.alias("split"), bucket.alias("bucket"), TARGET, *[F.col(f"`{c}`") for c in feature_cols])
    return Dataset(out, feature_cols, top_l, top_lic, bool(stats["uses_contrib"]),
                   n_train, n - n_train, int(n_missing))

