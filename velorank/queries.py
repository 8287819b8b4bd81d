"""Registered queries: one per operator of the blueprint.

Each callable takes ``(spark, sf_dir)``, reads the driver tables (through
the ``repos`` view or data Spark derives from it) and returns a DataFrame
whose column names match the SQL oracle in ``velorank.oracle_queries``.
Doubles are rounded to 6 places for the value-hash comparison.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from velorank.functions import features as feat
from velorank.sources.fixtures import AS_OF, repos

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def r6(c: Column | str) -> Column:
    """Round to 6 places as ``round(x * 1e6) / 1e6`` on the binary value
    (half away from zero) — the same result as the SQL oracle's round; a
    decimal-string half-up would differ at exact decimal ties."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double") * F.lit(1e6), 0) / F.lit(1e6)


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column to 6 places (oracle comparison)."""
    return df.select(*[r6(F.col(f"`{f.name}`")).alias(f.name) if f.dataType.typeName() == "double"
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def features_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feat.make_features(repos(spark, sf_dir), AS_OF)


@query("feature_table")
def q_feature_table(spark, sf_dir):
    """P10: the full feature projection."""
    return rounded(features_df(spark, sf_dir))


# --------------------------------------------------------------- projections
from velorank.functions.features import (BOOL_FIELDS, DAY_FIELDS, LOG_FIELDS, NUM_FIELDS,  # noqa: E402
                                         RATE_FIELDS)


def _feature_subset(spark, sf_dir, cols):
    return rounded(features_df(spark, sf_dir).select("pos", *cols))


@query("text_lengths")
def q_text_lengths(spark, sf_dir):
    """Code-point lengths of description and name."""
    r = repos(spark, sf_dir)
    return r.select("pos", feat.text_length(F.col("description")).alias("description_length"),
                    feat.text_length(F.col("full_name")).alias("name_length"))


@query("flags")
def q_flags(spark, sf_dir):
    """P3 + P5: presence / equality flags and booleans as 0/1."""
    return _feature_subset(spark, sf_dir, BOOL_FIELDS)


@query("numeric_defaults")
def q_numeric_defaults(spark, sf_dir):
    """Counts with null / absent -> 0 (contributor_count is absent)."""
    return _feature_subset(spark, sf_dir, NUM_FIELDS)


@query("days_since")
def q_days_since(spark, sf_dir):
    """Whole days since created / pushed / updated at a fixed as-of."""
    return _feature_subset(spark, sf_dir, DAY_FIELDS)


@query("rates")
def q_rates(spark, sf_dir):
    """Guarded rates."""
    return _feature_subset(spark, sf_dir, RATE_FIELDS)


@query("log_features")
def q_log_features(spark, sf_dir):
    """log1p of the skewed counts."""
    return _feature_subset(spark, sf_dir, LOG_FIELDS)


@query("target_transform")
def q_target_transform(spark, sf_dir):
    """log1p target and its floored inverse."""
    y = F.col("stargazers_count")
    lt = feat.log_target(y)
    return repos(spark, sf_dir).select("pos", r6(lt).alias("log_target"),
                                       r6(feat.star_space(lt, 0.0)).alias("star_back"))


@query("last_page_number")
def q_last_page_number(spark, sf_dir):
    """Last page number from a link URL, fallback 1."""
    from velorank.session import read_table
    pages = read_table(spark, sf_dir, "pages")
    return pages.select("page_id", feat.last_page_number(F.col("url"), F.lit(1).cast("long")).alias("last_page"))


@query("enrich_counts")
def q_enrich_counts(spark, sf_dir):
    """Per-entity count from another table (line items), missing -> 0."""
    from velorank.operators.ingest import enrich_counts
    from velorank.session import read_table
    counts = (read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pos"))
              .agg(F.count(F.lit(1)).alias("n")))
    return enrich_counts(repos(spark, sf_dir).select("pos", "full_name"), counts, "pos", "n") \
        .select("pos", "contributor_count")


# A trained column list used to exercise alignment.
ALIGN_COLUMNS = ["commit_count", "forks_count", "language_NATION_0", "language_NATION_1",
                 "language_NATION_99", "log_forks_count"]


@query("align_columns")
def q_align_columns(spark, sf_dir):
    """Trained columns in trained order; absent -> 0, extras dropped."""
    from velorank.operators.encode import align_columns, one_hot
    bucketed, vocab = _bucketed(spark, sf_dir, "commit_count", "forks_count", "log_forks_count")
    enc = one_hot(bucketed, {"language": vocab["language"]})
    return rounded(align_columns(enc, ALIGN_COLUMNS, keep=["pos"]))


@query("quarantine")
def q_quarantine(spark, sf_dir):
    """reason per invalid raw row ('ok' when valid)."""
    from velorank.operators.ingest import invalid_reason
    r = repos(spark, sf_dir)
    broken = r.select(
        "pos",
        F.when(F.col("pos") % 19 == 0, F.lit(None)).otherwise(F.col("full_name")).alias("full_name"),
        "stargazers_count",
        F.when(F.col("pos") % 17 == 0, F.regexp_replace("created_at", "T", " "))
         .otherwise(F.col("created_at")).alias("created_at"),
        "updated_at",
        F.when(F.col("pos") % 29 == 0, F.lit("not-a-date")).otherwise(F.col("pushed_at")).alias("pushed_at"))
    return broken.select("pos", F.coalesce(invalid_reason(broken), F.lit("ok")).alias("reason"))


@query("missing_cells")
def q_missing_cells(spark, sf_dir):
    """A3: null cells over all raw entity columns."""
    from velorank.operators.encode import missing_cells
    return missing_cells(repos(spark, sf_dir))


# ------------------------------------------------------------------ encoding
@query("top_languages")
def q_top_languages(spark, sf_dir):
    """A1: 20 most frequent languages, ties by first appearance."""
    from velorank.operators.encode import TOP_LANGS, top_values_df
    return top_values_df(features_df(spark, sf_dir), "language", TOP_LANGS) \
        .withColumn("rnk", F.col("rnk").cast("long"))


@query("top_licenses")
def q_top_licenses(spark, sf_dir):
    """A1: 15 most frequent licenses."""
    from velorank.operators.encode import TOP_LICENSES, top_values_df
    return top_values_df(features_df(spark, sf_dir), "license_key", TOP_LICENSES) \
        .withColumn("rnk", F.col("rnk").cast("long"))


def _bucketed(spark, sf_dir, *keep):
    """(pos, ``keep``, bucketed categories) and the present values, from one vocabulary pass."""
    from velorank.operators.encode import TOP_LANGS, TOP_LICENSES, rare_bucket
    from velorank.plans.dataset import vocabularies
    f = features_df(spark, sf_dir)
    vocab = vocabularies(f, {"language": TOP_LANGS, "license_key": TOP_LICENSES})
    bucketed = f.select("pos", *keep, *[rare_bucket(F.col(c), top).alias(c) for c, (top, _) in vocab.items()])
    return bucketed, {c: present for c, (_, present) in vocab.items()}


@query("rare_bucket")
def q_rare_bucket(spark, sf_dir):
    """Values outside the top-k become 'other'."""
    return _bucketed(spark, sf_dir)[0]


@query("one_hot")
def q_one_hot(spark, sf_dir):
    """One-hot block, unpivoted to (pos, feature, value) for comparison."""
    from velorank.operators.encode import one_hot
    wide = one_hot(*_bucketed(spark, sf_dir))
    cols = [c for c in wide.columns if c != "pos"]
    return wide.unpivot(["pos"], cols, "feature", "value")


# --------------------------------------------------------- bands and ingest
@query("band_join")
def q_band_join(spark, sf_dir):
    """J1 + W9: band of every entity."""
    from velorank.operators.bands import assign_band
    return assign_band(repos(spark, sf_dir).select("pos", "stargazers_count")).where(F.col("band").isNotNull())


@query("band_intervals")
def q_band_intervals(spark, sf_dir):
    """J1 for bands held as a table: one uneven band per customer, overlapping, some open, some of one
    value; entities and stars in each, empty bands kept."""
    from velorank.operators.interval import interval_totals
    from velorank.session import read_table
    key = F.col("c_custkey")
    lo = F.floor(F.abs(F.col("c_acctbal")) * 7).cast("long")
    bands = read_table(spark, sf_dir, "customer").select(
        key.alias("band"), lo.alias("lo"),
        F.when(key % 500 != 0, lo + (key % 20) * (key % 20)).cast("long").alias("hi"))
    hits = interval_totals(repos(spark, sf_dir).select("stargazers_count", F.col("stargazers_count").alias("stars")), bands, "stargazers_count", ["stars"])
    inside = hits.groupBy("band").agg(F.sum("n").alias("n"), F.sum("stars").alias("stars"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return bands.join(inside, "band", "left").select("band", "lo", "hi", zero("n"), zero("stars"))


@query("band_filter")
def q_band_filter(spark, sf_dir):
    """entities of one band (1600..3199), predicate pushed to the scan."""
    from velorank.operators.bands import DEFAULT_EDGES, band_predicate
    lo, hi = DEFAULT_EDGES[5], DEFAULT_EDGES[6] - 1
    return repos(spark, sf_dir).select("pos", "stargazers_count") \
        .where(band_predicate(F.col("stargazers_count"), lo, hi))


@query("band_quota")
def q_band_quota(spark, sf_dir):
    """Top max(5000 // 12, 1) entities by stars in every band."""
    from velorank.operators.bands import DEFAULT_EDGES, assign_band, band_quota, per_band_quota
    n = per_band_quota(5000, len(DEFAULT_EDGES))
    b = assign_band(repos(spark, sf_dir).select("pos", "stargazers_count")).select("pos", "stargazers_count", "band")
    return band_quota(b, n).withColumn("rank_in_band", F.col("rank_in_band").cast("long"))


@query("band_counts")
def q_band_counts(spark, sf_dir):
    """Entities per band, empty bands kept."""
    from velorank.operators.bands import band_counts
    return band_counts(repos(spark, sf_dir), spark)


def _shard_label(df: DataFrame) -> DataFrame:
    from velorank.operators.bands import assign_band
    return assign_band(df).withColumn("shard", F.concat(F.lit("repos_"), F.col("label"), F.lit(".jsonl"))) \
        .drop("band", "lo", "hi", "label")


def _write_dup_shards(spark, sf_dir, name: str) -> str:
    from velorank.session import scratch_path
    from velorank.sources.files import write_shards
    from velorank.sources.fixtures import repos_with_duplicates
    path = scratch_path(spark, name)
    write_shards(_shard_label(repos_with_duplicates(spark, sf_dir)), path, "shard", "pos", compression="snappy")
    return path


def _shard_schema():
    from pyspark.sql import types as T

    from velorank.sources.schema import REPO_SCHEMA_FULL
    return T.StructType([T.StructField("pos", T.LongType())] + REPO_SCHEMA_FULL.fields)


@query("dedupe_first")
def q_dedupe_first(spark, sf_dir):
    """W1 + S2: shards written per band, read back in (path, line) order,
    first record per name wins (not the freshest)."""
    from velorank.operators.dedupe import keep_first_line
    from velorank.sources.files import scan_shards
    path = _write_dup_shards(spark, sf_dir, "dedupe-shards")
    df = scan_shards(spark, path, _shard_schema())
    first = keep_first_line(df.select("full_name", "pos", "stargazers_count", "forks_count",
                                 "_src_path", "_src_block", "_src_row"), "full_name")
    return first.select("pos", "full_name", "stargazers_count", "forks_count")


@query("scan_shards")
def q_scan_shards(spark, sf_dir):
    """S2 + T1: position of every shard line in (path, line) order."""
    from velorank.operators.rank import global_rank
    from velorank.sources.files import scan_shards
    path = _write_dup_shards(spark, sf_dir, "scan-shards")
    df = scan_shards(spark, path, _shard_schema()).select("pos", "full_name", "shard", "_src_path",
                                                          "_src_block", "_src_row")
    ranked, _ = global_rank(df, ["_src_path", "_src_block", "_src_row"], "line_no")
    return ranked.select("pos", "full_name", "shard", "line_no")


@query("merge_shards")
def q_merge_shards(spark, sf_dir):
    """§2.8: union-all of two shard sets with different optional keys
    (one carries contributor_count), then first-wins dedupe."""
    from velorank.operators.dedupe import keep_first_line, union_shards
    from velorank.session import read_table, scratch_path
    from velorank.sources.files import scan_shards, write_shards
    from velorank.sources.fixtures import repos_with_duplicates
    base = scratch_path(spark, "merge")
    r = repos(spark, sf_dir)
    n_lines = (read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("pos"))
               .agg(F.count(F.lit(1)).alias("contributor_count")))
    a = _shard_label(r.where(F.col("pos") % 3 == 0).join(n_lines, "pos", "left"))
    write_shards(a, f"{base}/a", "shard", "pos", compression="snappy")
    write_shards(_shard_label(repos_with_duplicates(spark, sf_dir)), f"{base}/b", "shard", "pos", compression="snappy")
    from pyspark.sql import types as T

    from velorank.sources.schema import REPO_SCHEMA
    schema_b = T.StructType([T.StructField("pos", T.LongType())] + REPO_SCHEMA.fields)
    sa = scan_shards(spark, f"{base}/a", _shard_schema())
    sb = scan_shards(spark, f"{base}/b", schema_b)
    merged = union_shards([sb.drop("_synthetic"), sa.drop("_synthetic")])
    first = keep_first_line(merged.select("full_name", "pos", "stargazers_count", "contributor_count",
                                     "_src_path", "_src_block", "_src_row"), "full_name")
    return first.select("pos", "full_name", "stargazers_count", "contributor_count")


@query("scan_jsonl")
def q_scan_jsonl(spark, sf_dir):
    """JSON lines written and read back with an explicit schema (FAILFAST)."""
    from velorank.session import scratch_path
    from velorank.sources.files import scan_jsonl
    from velorank.sources.schema import REPO_COLUMNS
    path = scratch_path(spark, "scan-jsonl")
    repos(spark, sf_dir).write.mode("errorifexists").json(path)
    df = scan_jsonl(spark, path, _shard_schema())
    return df.select("pos", *REPO_COLUMNS)


@query("flatten_nodes")
def q_flatten_nodes(spark, sf_dir):
    """Nested API node JSON -> 26 flat fields."""
    from velorank.operators.ingest import flatten_nodes
    from velorank.sources.derived import node_json
    from velorank.sources.schema import NODE_SCHEMA
    nodes = node_json(repos(spark, sf_dir)).select("pos", F.from_json("node_json", NODE_SCHEMA).alias("node"))
    return flatten_nodes(nodes, "node", keep=["pos"])


@query("pages_to_rows")
def q_pages_to_rows(spark, sf_dir):
    """S3 + F1 + O2: search pages per band -> rows, null nodes skipped,
    first max(5000 // 12, 1) per band query."""
    from velorank.operators.bands import DEFAULT_EDGES, per_band_quota
    from velorank.operators.ingest import pages_to_rows
    from velorank.sources.derived import search_pages
    pages = search_pages(repos(spark, sf_dir))
    rows = pages_to_rows(pages, per_band_quota(5000, len(DEFAULT_EDGES)))
    return rows.drop("page_no", "node_idx")


@query("page_chain")
def q_page_chain(spark, sf_dir):
    """S3: captured pages with some left out, captured twice, cut off or stuck at a cursor: every fault of the chain."""
    from velorank.operators.ingest import page_chain
    from velorank.sources.derived import search_pages
    page = F.col("page_no")
    pages = search_pages(repos(spark, sf_dir)).where(page % 9 != 4)
    stuck = F.regexp_replace("body", "cursor:[0-9]+", "cursor:stuck")
    pages = pages.withColumn("body", F.when(page % 11 == 7, F.regexp_replace("body", '"hasNextPage":true', '"hasNextPage":false'))
                             .when(page % 8 >= 6, stuck).otherwise(F.col("body")))
    return page_chain(pages.unionByName(pages.where(page % 10 == 2)))


@query("pages_quarantine")
def q_pages_quarantine(spark, sf_dir):
    """F4 for S3: truncated, failed and empty pages are listed with their reason."""
    from velorank.operators.ingest import pages_quarantine
    from velorank.sources.derived import search_pages
    page = F.col("page_no")
    pages = search_pages(repos(spark, sf_dir)).withColumn("body", F.when(page % 7 == 3, F.substring("body", 1, 200))
        .when(page % 11 == 5, F.lit('{"errors": [{"message": "timeout"}]}')).when(page % 13 == 6, F.lit(""))
        .otherwise(F.col("body")))
    return pages_quarantine(pages).select("query", "page_no", "reason")


@query("trials_latest")
def q_trials_latest(spark, sf_dir):
    """Half of the configs are scored anew; the new record of a config replaces the old one."""
    from velorank.session import scratch_path
    from velorank.sources.files import scan_trials, write_trials
    path = scratch_path(spark, "trials-latest")
    trials = _trials(spark, sf_dir)
    again = F.substring("config_id", -1, 1).isin(*"01234567")
    write_trials(trials.withColumn("cv_r2", F.when(again, F.lit(10.0)).otherwise(F.col("cv_r2"))), path)
    write_trials(trials.where(again), path)
    return rounded(scan_trials(spark, path).select("model_name", "config_id", "cv_r2"))


@query("null_fill")
def q_null_fill(spark, sf_dir):
    """Nulls in numeric columns become 0."""
    from velorank.operators.encode import fill_zero
    r = repos(spark, sf_dir).select(
        "pos", F.when(F.col("pos") % 3 != 0, F.col("forks_count")).alias("forks_count"),
        F.when(F.col("pos") % 5 != 0, F.col("watchers")).alias("watchers"), "release_count")
    return fill_zero(r, ["forks_count", "watchers", "release_count"])


@query("timing_ratio")
def q_timing_ratio(spark, sf_dir):
    """S7 + W6: yearly totals written as a timing CSV, read back and related to the first row."""
    from velorank.operators.report import relative_to_first
    from velorank.session import ensure_utc, read_table, scratch_path
    from velorank.sources.files import scan_timing_csv
    ensure_utc(spark)
    path = scratch_path(spark, "timing")
    read_table(spark, sf_dir, "lineitem").where(F.col("l_shipdate").isNotNull()) \
        .groupBy(F.year("l_shipdate").alias("workers")).agg(F.sum("l_quantity").alias("seconds")) \
        .write.option("header", True).csv(path)
    return rounded(relative_to_first(scan_timing_csv(spark, path), "workers", "workers", "seconds"))


@query("guarded_write")
def q_guarded_write(spark, sf_dir):
    """A table of generated records may be overwritten, one of real records is refused."""
    from velorank.session import scratch_path
    from velorank.sources.files import guarded_write_jsonl, holds_real_records
    r = repos(spark, sf_dir)
    marked, plain = scratch_path(spark, "marked"), scratch_path(spark, "plain")
    guarded_write_jsonl(r.where("pos % 2 = 0"), marked)
    r.where("pos % 2 = 1").write.json(plain)
    rows = [spark.read.text(path).agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n_lines")).withColumn(
        "refused", F.lit(holds_real_records(spark, path))) for kind, path in (("marked", marked), ("plain", plain))]
    return rows[0].unionByName(rows[1])


# ----------------------------------------------------- ranking and splitting
SEED = 0


@query("top_n_by_language")
def q_top_n_by_language(spark, sf_dir):
    """Top 1500 by stars in every language; no language is a group of its own."""
    from velorank.operators.rank import top_n_per_group
    r = repos(spark, sf_dir).select("pos", "language", "stargazers_count")
    return top_n_per_group(r, "language", [F.desc("stargazers_count"), F.asc("pos")], 1500, "rank_in_language", keep_rank=True)


@query("rank_in_group")
def q_rank_in_group(spark, sf_dir):
    """Rank within more than a thousand owners, one group being null."""
    from velorank.operators.rank import rank_within
    r = repos(spark, sf_dir).select("pos", "stargazers_count", F.when(
        F.col("pos") % 10 != 0, F.substring_index("full_name", "/", 1)).alias("owner"))
    return rank_within(r, ["owner"], [F.desc("stargazers_count"), F.asc("pos")], "rank").select("pos", "owner", "rank")


@query("global_rank")
def q_global_rank(spark, sf_dir):
    """W3 + C1: rank 1..n by (stars, position), no single-partition window."""
    from velorank.operators.rank import global_rank
    ranked, _ = global_rank(repos(spark, sf_dir).select("pos", "stargazers_count"),
                            ["stargazers_count", "pos"], "rank")
    return ranked


def _split(spark, sf_dir):
    """Strata and split by the cut points that the dataset build uses."""
    from velorank.operators.split import stratified_cuts
    from velorank.session import materialize
    r = materialize(repos(spark, sf_dir).select("pos", "full_name", "stargazers_count"), "split-rows")
    bucket, part = stratified_cuts(r, "stargazers_count", r.count(), 5, "full_name", "pos", 0.2, SEED)
    return r.select("*", bucket.alias("bucket"), part.alias("split"))


@query("rank_buckets")
def q_rank_buckets(spark, sf_dir):
    """Equal-frequency strata of the rank (qcut, not ntile)."""
    return _split(spark, sf_dir).select("pos", "bucket")


@query("stratified_split")
def q_stratified_split(spark, sf_dir):
    """80/20 split with per-stratum largest-remainder quotas."""
    return _split(spark, sf_dir).select("pos", "bucket", "split")


@query("fold_ids")
def q_fold_ids(spark, sf_dir):
    """5 contiguous folds over the train rows in split-hash order."""
    from velorank.operators.split import assign_folds
    train = _split(spark, sf_dir).where(F.col("split") == "train")
    return assign_folds(train, "full_name", SEED, 5).select("pos", "fold")


@query("stride_sample")
def q_stride_sample(spark, sf_dir):
    """O3: 1000 entities evenly spaced over position order."""
    from velorank.operators.rank import stride_sample
    return stride_sample(repos(spark, sf_dir).select("pos", "full_name"), ["pos"], 1000)


# ---------------------------------------------------------------- dataset E3
def _dataset(spark, sf_dir):
    from velorank.plans.dataset import build_dataset
    return build_dataset(repos(spark, sf_dir), AS_OF)


def _hot_column(df: DataFrame, prefix: str) -> Column:
    cols = [c for c in df.columns if c.startswith(prefix)]
    return F.coalesce(*[F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in cols]) if cols else F.lit(None)


@query("build_dataset")
def q_build_dataset(spark, sf_dir):
    """E3 (flagship): feature table, top-k + one-hot, strata, split.
    The one-hot block is reported as the name of its hot column."""
    from velorank.functions.features import NUMERIC_FEATURES
    ds = _dataset(spark, sf_dir)
    df = ds.df
    return rounded(df.select("pos", "full_name", "split", "bucket", "stargazers_count", *NUMERIC_FEATURES,
                             _hot_column(df, "language_").alias("language_col"),
                             _hot_column(df, "license_key_").alias("license_col")))


@query("dataset_roundtrip")
def q_dataset_roundtrip(spark, sf_dir):
    """Dataset written partitioned by split, test split read back
    (partition pruning)."""
    from velorank.session import scratch_path
    from velorank.sources.files import read_dataset, write_dataset
    ds = _dataset(spark, sf_dir)
    path = scratch_path(spark, "dataset")
    write_dataset(ds.df, path)
    return read_dataset(spark, path, "test").select("pos", "full_name", "split", "bucket", "stargazers_count")


@query("feature_schema")
def q_feature_schema(spark, sf_dir):
    """S5 + A2 + A8: feature-schema artifact written and read back."""
    from velorank.session import scratch_path
    from velorank.sources.files import read_feature_schema, write_feature_schema
    ds = _dataset(spark, sf_dir)
    path = scratch_path(spark, "feature-schema")
    write_feature_schema(spark, ds.meta(), path)
    m = read_feature_schema(spark, path)
    row = (m["target"], len(m["feature_columns"]), ",".join(m["feature_columns"]), ",".join(m["top_langs"]),
           ",".join(m["top_licenses"]), m["uses_contributors"], m["n_train"], m["n_test"])
    return spark.createDataFrame([row], "target string, n_columns long, feature_columns string, top_langs string, "
                                        "top_licenses string, uses_contributors boolean, n_train long, n_test long")


# ---------------------------------------------------- metrics and selection
def _det_log_pred() -> Column:
    """Deterministic prediction used where a model would stand."""
    return F.log1p(F.col("forks_count").cast("double") * 10)


@query("metrics")
def q_metrics(spark, sf_dir):
    """A4: r2 (log, star), MAE, RMSE, exact median APE."""
    from velorank.operators.metrics import regression_metrics
    df = repos(spark, sf_dir).select("pos", "stargazers_count", _det_log_pred().alias("log_pred"))
    return rounded(regression_metrics(df, "stargazers_count", "log_pred", "pos"))


def _trials(spark, sf_dir):
    from velorank.sources.derived import trials_from_repos
    return trials_from_repos(repos(spark, sf_dir))


@query("best_per_model")
def q_best_per_model(spark, sf_dir):
    """A5: best config per model, NaN last, first (config id order) wins."""
    from velorank.operators.metrics import best_per_group
    t = _trials(spark, sf_dir).select("model_name", "config_id", "cv_r2")
    return rounded(best_per_group(t, "model_name", "cv_r2", "config_id"))


@query("best_overall")
def q_best_overall(spark, sf_dir):
    """The single best trial."""
    from velorank.operators.metrics import best_overall
    t = _trials(spark, sf_dir).select("model_name", "config_id", "cv_r2")
    return rounded(best_overall(t, "cv_r2", "config_id"))


@query("cv_mean")
def q_cv_mean(spark, sf_dir):
    """Unweighted mean fold score per config."""
    from velorank.operators.metrics import cv_mean
    from velorank.sources.derived import fold_scores_from_repos
    return rounded(cv_mean(fold_scores_from_repos(repos(spark, sf_dir))))


@query("relative_to_first")
def q_relative_to_first(spark, sf_dir):
    """Yearly shipped quantity relative to the first year
    (base = first quantity x first line count)."""
    from velorank.operators.report import relative_to_first
    from velorank.session import ensure_utc, read_table
    ensure_utc(spark)
    li = read_table(spark, sf_dir, "lineitem")
    yearly = (li.groupBy(F.year("l_shipdate").cast("long").alias("ship_year"))
              .agg(F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("quantity")))
    return rounded(relative_to_first(yearly, "ship_year", "n_lines", "quantity"))


def _report_input(spark, sf_dir):
    r = repos(spark, sf_dir)
    name = F.concat_ws("-", F.col("full_name"), F.coalesce(F.col("language"), F.lit("unknown")),
                       F.coalesce(F.col("license_key"), F.lit("none")))
    return r.select("pos", name.alias("name"), (F.col("forks_count") * F.lit(10.5)).alias("pred_stars"))


@query("ranked_report")
def q_ranked_report(spark, sf_dir):
    """W8 + O1: ranked table with cut names, thousands separators, bars."""
    from velorank.operators.report import ranked_report
    return ranked_report(_report_input(spark, sf_dir), "name", "pred_stars", "pos")


@query("pred_vs_actual")
def q_pred_vs_actual(spark, sf_dir):
    """Predicted vs actual, clipped at 1, common axis max."""
    from velorank.operators.report import pred_vs_actual
    df = repos(spark, sf_dir).select("pos", "stargazers_count", _det_log_pred().alias("log_pred"))
    return rounded(pred_vs_actual(df, "stargazers_count", "log_pred").drop("log_pred"))


@query("content_key")
def q_content_key(spark, sf_dir):
    """M2: stable short id = name + '_' + sha1(sorted-key JSON)[:12]."""
    from velorank.plans.training import content_key
    r = repos(spark, sf_dir)
    key = content_key("repo", strings={"full_name": F.col("full_name")},
                      numbers={"stargazers_count": F.col("stargazers_count")})
    return r.select("pos", key.alias("content_key"))


@query("standardize")
def q_standardize(spark, sf_dir):
    """M3: z-score with population sigma (sigma 0 -> 1)."""
    from velorank.plans.training import standardize
    f = features_df(spark, sf_dir).select("pos", "forks_count", "commit_count", "disk_usage", "is_fork")
    return rounded(standardize(f, ["forks_count", "commit_count", "disk_usage", "is_fork"], keep=["pos"]))


# ---------------------------------------------------------------- streaming
def _ingested(spark, sf_dir, max_files):
    from velorank.session import scratch_path
    from velorank.streaming.incremental import incremental_ingest, read_ingested
    src = _write_dup_shards(spark, sf_dir, "stream-src")
    target = scratch_path(spark, "stream-target")
    ckpt = scratch_path(spark, "stream-ckpt")
    n1 = incremental_ingest(spark, src, target, ckpt, _shard_schema(), max_files_per_trigger=max_files)
    n2 = incremental_ingest(spark, src, target, ckpt, _shard_schema())
    if n1 != n2:
        raise RuntimeError(f"rerun changed the target: {n1} -> {n2}")
    return read_ingested(spark, target, columns=["pos", "full_name", "stargazers_count", "forks_count"])


@query("incremental_ingest")
def q_incremental_ingest(spark, sf_dir):
    """S11 + J3: shard folder ingested by an availableNow stream twice; the
    rerun adds nothing; first record per name wins."""
    return _ingested(spark, sf_dir, None)


@query("incremental_ingest_batches")
def q_incremental_ingest_batches(spark, sf_dir):
    """The same with three files per batch: the batches don't change which record wins."""
    return _ingested(spark, sf_dir, 3)


# ------------------------------------------------------------------ models
# One grid point per family used by the single-fit queries.
RIDGE_CFG = {"model_name": "Ridge", "alpha": 1.0}
FOREST_CFG = {"model_name": "RandomForest", "max_depth": 10, "min_samples_leaf": 4, "n_estimators": 100}
BOOSTING_CFG = {"model_name": "GradientBoosting", "learning_rate": 0.1, "max_depth": 3, "n_estimators": 100}
HIST_CFG = {"model_name": "HistGradientBoosting", "learning_rate": 0.1, "max_depth": None, "max_iter": 50}


def _train_test(spark, sf_dir, folds: bool = True):
    from velorank.operators.split import assign_folds
    from velorank.session import materialize
    ds = _dataset(spark, sf_dir)
    df = materialize(ds.df)
    train = df.where(F.col("split") == "train")
    if folds:
        train = assign_folds(train, "full_name", SEED, 5)
    test = df.where(F.col("split") == "test")
    return ds, train, test


# Test R^2 (log) that every fit must reach, and how far (log) a prediction may leave the labels' range.
R2_FLOOR, RANGE_SLACK = 0.8, 1.0


def _fit(train, feature_columns, cfg):
    from velorank.plans.training import fit_config
    return fit_config(train, feature_columns, cfg)


def _label_range(df) -> tuple[float, float]:
    r = df.agg(F.min("stargazers_count").alias("lo"), F.max("stargazers_count").alias("hi")).first()
    return math.log1p(r["lo"]) - RANGE_SLACK, math.log1p(r["hi"]) + RANGE_SLACK


def _fit_predict(spark, sf_dir, cfg):
    """Test rows with the properties a fit must have: predictions in the
    labels' range and an R^2 above the floor."""
    from velorank.operators.metrics import regression_metrics
    from velorank.plans.training import PREDICTION
    from velorank.session import materialize
    ds, train, test = _train_test(spark, sf_dir, folds=False)
    lo, hi = _label_range(train)
    pred = _fit(train, ds.feature_columns, cfg).transform(test) \
        .select("pos", "stargazers_count", F.col(PREDICTION).alias("log_pred"))
    pred = materialize(pred, "predictions")
    r2 = regression_metrics(pred, "stargazers_count", "log_pred", "pos").first()["r2_log"]
    return pred.select("pos", F.col("log_pred").between(lo, hi).alias("in_range"), F.lit(r2 >= R2_FLOOR).alias("r2_floor"))


@query("ridge_fit_predict")
def q_ridge_fit_predict(spark, sf_dir):
    """M3 + M5: ridge (alpha 1) on all standardised features, log target."""
    return _fit_predict(spark, sf_dir, RIDGE_CFG)


@query("forest_fit_predict")
def q_forest_fit_predict(spark, sf_dir):
    """M6: random forest, all features per split, bootstrap, seed 68."""
    return _fit_predict(spark, sf_dir, FOREST_CFG)


@query("extra_trees_fit_predict")
def q_extra_trees_fit_predict(spark, sf_dir):
    """M7: extremely randomised trees, one random threshold per (node, feature), no bootstrap."""
    return _fit_predict(spark, sf_dir, {**FOREST_CFG, "model_name": "ExtraTrees"})


@query("boosting_fit_predict")
def q_boosting_fit_predict(spark, sf_dir):
    """M8: gradient boosting, squared loss."""
    return _fit_predict(spark, sf_dir, BOOSTING_CFG)


@query("hist_boosting_fit_predict")
def q_hist_boosting_fit_predict(spark, sf_dir):
    """M9: leaf-wise histogram boosting, at most 31 leaves of 20 rows or more."""
    return _fit_predict(spark, sf_dir, HIST_CFG)


# Four features of few values, whose bins are their values, and small configs of the tree families.
SMALL_FEATURES = ["open_pulls_count", "release_count", "topics_count", "has_wiki"]
SMALL_TREES = {
    "RandomForest": {"n_estimators": 2, "max_depth": 2, "min_samples_leaf": 5},
    "ExtraTrees": {"n_estimators": 2, "max_depth": 2, "min_samples_leaf": 5},
    "GradientBoosting": {"n_estimators": 3, "max_depth": 2, "learning_rate": 0.1},
    "HistGradientBoosting": {"max_iter": 2, "max_depth": None, "learning_rate": 0.1},
}


def _small_tree_scores(spark, sf_dir, family):
    """Every row scored by a small model of the family."""
    _, train, test = _train_test(spark, sf_dir, folds=False)
    model = _fit(train, SMALL_FEATURES, {"model_name": family, **SMALL_TREES[family]})
    return model.transform(train.unionByName(test).select("pos", *SMALL_FEATURES)).select("pos", r6("prediction").alias("log_pred"))


@query("forest_scores")
def q_forest_scores(spark, sf_dir):
    """M6: two bootstrapped trees of depth 2, equal to SQL's."""
    return _small_tree_scores(spark, sf_dir, "RandomForest")


@query("extra_trees_scores")
def q_extra_trees_scores(spark, sf_dir):
    """M7: two trees with random thresholds, equal to SQL's."""
    return _small_tree_scores(spark, sf_dir, "ExtraTrees")


@query("boosting_scores")
def q_boosting_scores(spark, sf_dir):
    """M8: mean start and three shrunk trees on residuals, equal to SQL's."""
    return _small_tree_scores(spark, sf_dir, "GradientBoosting")


@query("hist_boosting_scores")
def q_hist_boosting_scores(spark, sf_dir):
    """M9: two leaf-wise trees of at most 31 leaves, equal to SQL's."""
    return _small_tree_scores(spark, sf_dir, "HistGradientBoosting")


def _one_feature(spark, sf_dir, folds: bool = False):
    """Train and test rows with the single feature log(1 + forks)."""
    ds, train, test = _train_test(spark, sf_dir, folds)
    return train, test, ["log_forks_count"]


def _one_feature_fit(spark, sf_dir, cfg):
    train, test, cols = _one_feature(spark, sf_dir)
    scored = _fit(train, cols, cfg).transform(train.unionByName(test))
    return scored.select("pos", r6("prediction").alias("log_pred"), F.round(feat.star_space(F.col("prediction"), 0.0), 2).alias("predicted_stars"))


@query("linear_one_feature")
def q_linear_one_feature(spark, sf_dir):
    """M4: least squares on one feature, every row scored."""
    return _one_feature_fit(spark, sf_dir, {"model_name": "LinearRegression"})


@query("ridge_one_feature")
def q_ridge_one_feature(spark, sf_dir):
    """M5: ridge (alpha 1) on one standardised feature, every row scored."""
    return _one_feature_fit(spark, sf_dir, RIDGE_CFG)


@query("linear_cv_scores")
def q_linear_cv_scores(spark, sf_dir):
    """M1 + M2 + M10: 5-fold R^2 of the linear families' grid on one feature."""
    from velorank.plans.training import LINEAR, grid_configs, grid_search
    train, _, cols = _one_feature(spark, sf_dir, folds=True)
    return rounded(grid_search(train, cols, grid_configs(LINEAR), "fold", 5).select("model_name", "config_id", "cv_r2"))


@query("accuracy_table")
def q_accuracy_table(spark, sf_dir):
    """M11 + M13: best config per family by CV, refit, test R^2."""
    from velorank.plans.training import LINEAR, grid_configs, grid_search, select_best
    train, test, cols = _one_feature(spark, sf_dir, folds=True)
    trials = grid_search(train, cols, grid_configs(LINEAR), "fold", 5)
    results, _, _ = select_best(trials, train, test, cols)
    return rounded(results.select("model_name", "cv_r2", "r2_log"))


@query("ranked_scores")
def q_ranked_scores(spark, sf_dir):
    """M12 + O1: the whole table scored by a saved and reloaded model, and ranked."""
    from velorank.plans.training import load_model, save_model, score_table
    from velorank.session import scratch_path
    train, _, cols = _one_feature(spark, sf_dir)
    path = scratch_path(spark, "one-feature-model")
    save_model(_fit(train, cols, {"model_name": "LinearRegression"}), path)
    ranked = score_table(load_model(spark, path, "LinearRegression"), features_df(spark, sf_dir), cols, [], [])
    return ranked.select("rank", "pos", "full_name", F.round("predicted_stars", 2).alias("predicted_stars"))


def _grid_trials(spark, sf_dir, jobs):
    from velorank.plans.training import grid_search
    ds, train, test = _train_test(spark, sf_dir)
    return ds, train, test, grid_search(train, ds.feature_columns, jobs, "fold", 5)


@query("grid_search")
def q_grid_search(spark, sf_dir):
    """M1 + M2 + M10: 5-fold CV mean R^2 of the linear families' grid
    (the reference's per-family run), one trial record per config."""
    from velorank.plans.training import LINEAR, grid_configs
    _, _, _, trials = _grid_trials(spark, sf_dir, grid_configs(LINEAR))
    return _checked_trials(trials)


def _checked_trials(trials):
    return trials.select("model_name", "config_id", (F.col("cv_r2") >= R2_FLOOR).alias("r2_floor"))


@query("grid_search_families")
def q_grid_search_families(spark, sf_dir):
    """One config of each of the six families through the same search."""
    from velorank.plans.training import CHECKED_CONFIGS
    return _checked_trials(_grid_trials(spark, sf_dir, CHECKED_CONFIGS)[3])


@query("results_table")
def q_results_table(spark, sf_dir):
    """M11 + S6 + S8 + S9: trial records of all six families appended and scanned
    back, winners refit on train and scored on test, the overall winner saved and
    loaded back, results and metadata written."""
    from velorank.plans.training import CHECKED_CONFIGS, LINEAR, grid_configs, load_model, save_model, select_best
    from velorank.session import scratch_path
    from velorank.sources.files import read_metadata, scan_trials, write_metadata, write_results, write_trials
    jobs = grid_configs(LINEAR) + [c for c in CHECKED_CONFIGS if c["model_name"] not in LINEAR]
    ds, train, test, trials = _grid_trials(spark, sf_dir, jobs)
    trials_path = scratch_path(spark, "trials")
    write_trials(trials, trials_path)
    results, winner, model = select_best(scan_trials(spark, trials_path), train, test, ds.feature_columns)
    path, results_path, metadata_path = (scratch_path(spark, n) for n in ("model", "results", "metadata"))
    save_model(model, path)
    write_results(results, results_path)
    best = results.where(F.col("model_name") == winner).first().asDict()
    write_metadata(spark, {"model_name": winner, "log_target": True, "deployment_time": DEPLOYMENT_TIME,
                           "metrics": {k: v for k, v in best.items() if k != "best_hyperparameters"}}, metadata_path)
    # the saved model scores like the fitted one, and the metadata names it
    metadata = read_metadata(spark, metadata_path)
    loaded = load_model(spark, path, metadata["model_name"])
    both = model.transform(test).select("pos", "prediction").join(
        loaded.transform(test).select("pos", F.col("prediction").alias("again")), "pos")
    worst = both.agg(F.max(F.abs(F.col("prediction") - F.col("again"))).alias("d")).first()["d"]
    stored = spark.read.schema("model_name string, r2_log double, cv_r2 double").json(results_path)
    top = stored.orderBy(F.desc("cv_r2"), "model_name").first()["model_name"]
    return stored.select("model_name", (F.col("r2_log") >= R2_FLOOR).alias("r2_floor"),
                         F.lit(worst == 0).alias("same_after_reload"), F.lit(metadata["model_name"] == top).alias("winner_in_metadata"))


# Fixed value: deployment time recorded in the metadata (passed in, not read from the clock).
DEPLOYMENT_TIME = "2002-01-01T00:00:00+00:00"


@query("ranked_predictions")
def q_ranked_predictions(spark, sf_dir):
    """M12 + O1: the whole table scored by the selected model and ranked."""
    from velorank.plans.training import CHECKED_CONFIGS, score_table, select_best
    ds, train, test, trials = _grid_trials(spark, sf_dir, CHECKED_CONFIGS)
    _, _, model = select_best(trials, train, test, ds.feature_columns)
    feats = features_df(spark, sf_dir)
    meta = ds.meta()
    ranked = score_table(model, feats, ds.feature_columns, meta["top_langs"], meta["top_licenses"])
    n = ds.n_train + ds.n_test
    hi = math.exp(_label_range(train.unionByName(test, allowMissingColumns=True))[1])
    return ranked.select("pos", "full_name", F.col("predicted_stars").between(0, hi).alias("in_range"),
                         F.col("rank").between(1, n).alias("rank_in_range"))
