"""The end-to-end flow as Spark jobs that talk through shared storage:

    ingest(pages)  -> band shards from captured search pages, problems set aside
    merge(shards)  -> raw entity table (first record per name wins)
    build(raw)     -> dataset table partitioned by split + feature schema
    train(dataset) -> trial records, the newest per config (k-fold CV score per config)
    select(...)    -> results, winner model, metadata
    predict(...)   -> quarantined rows + ranked predictions (+ report)

Every step reads and writes paths under one base folder (on a cluster: a
shared file system), so the steps can run as separate applications.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velorank.functions.features import make_features
from velorank.operators.dedupe import keep_first
from velorank.operators.bands import DEFAULT_EDGES, assign_band, per_band_quota
from velorank.operators.ingest import enrich_counts, pages_quarantine, pages_to_rows, quarantine, require_rows
from velorank.operators.rank import global_rank
from velorank.operators.report import ranked_report
from velorank.operators.split import assign_folds
from velorank.plans.dataset import build_dataset
from velorank.plans.training import (grid_configs, grid_search, load_model, save_model, score_table, select_best)
from velorank.sources.files import (read_dataset, read_feature_schema, read_metadata, scan_shards, scan_trials,
                                    write_dataset, write_feature_schema, write_metadata, write_results,
                                    write_shards, write_trials)
from velorank.sources.schema import REPO_SCHEMA_FULL


def _paths(base: str) -> dict[str, str]:
    b = base.rstrip("/")
    return {"raw": f"{b}/raw", "dataset": f"{b}/processed/dataset", "schema": f"{b}/processed/feature_schema",
            "trials": f"{b}/models/trials", "results": f"{b}/models/results", "model": f"{b}/models/production/model",
            "metadata": f"{b}/models/production/metadata", "shards": f"{b}/shards",
            "page_problems": f"{b}/page_problems", "ranked": f"{b}/predictions/ranked",
            "skipped": f"{b}/predictions/skipped", "report": f"{b}/predictions/report"}


def ingest(spark: SparkSession, pages: DataFrame, base: str, total: int = 0) -> tuple[int, int]:
    """Captured search pages (query, page_no, body) -> one shard per band; ``total`` entities in all are
    spread evenly over the bands (0 = all).  Pages and nodes that can't be read are written with their
    reason.  Returns (rows, problems)."""
    p = _paths(base)
    per_band = per_band_quota(total, len(DEFAULT_EDGES)) if total else None
    rows = pages_to_rows(pages, per_band, strict=False)
    banded = assign_band(rows).withColumn("shard", F.concat(F.lit("repos_"), F.coalesce("label", F.lit("none")), F.lit(".jsonl")))
    # place of a row in its shard: query, page, node
    ranked, n = global_rank(banded.drop("band", "lo", "hi", "label"), ["shard", "query", "page_no", "node_idx"], "pos")
    write_shards(ranked.drop("query", "page_no", "node_idx"), p["shards"], "shard", "pos")
    pages_quarantine(pages).write.mode("overwrite").json(p["page_problems"])
    return n, spark.read.text(p["page_problems"]).count()


def merge(spark: SparkSession, shards_dir: str, base: str) -> int:
    """Union every shard file and keep the first record per name, in
    (path, line) order; write the raw entity table."""
    df = scan_shards(spark, shards_dir, REPO_SCHEMA_FULL)
    first = keep_first(df.drop(*[c for c in df.columns if c == "shard"]), "full_name")
    # pos = line number in the merged output (first appearances in path/line order)
    ranked, _ = global_rank(first, ["_src_path", "_src_block", "_src_row"], "pos")
    raw = ranked.drop("_src_path", "_src_block", "_src_row")
    raw.write.mode("overwrite").parquet(_paths(base)["raw"])
    return spark.read.parquet(_paths(base)["raw"]).count()


def build(spark: SparkSession, base: str, as_of: str, raw: DataFrame | None = None,
          vocab_on: str = "all") -> dict:
    """Feature table, vocabularies, strata and split -> dataset + schema."""
    p = _paths(base)
    src = raw if raw is not None else spark.read.parquet(p["raw"])
    if "pos" not in src.columns:
        src = src.withColumn("pos", F.monotonically_increasing_id())
    ds = build_dataset(src, as_of, vocab_on=vocab_on)
    write_dataset(ds.df, p["dataset"])
    write_feature_schema(spark, ds.meta(), p["schema"])
    return ds.meta()


def train(spark: SparkSession, base: str, models: Sequence[str] | None = None, max_jobs: int = 0,
          k: int = 5, seed: int = 0, parallelism: int = 4) -> DataFrame:
    """k-fold CV of the (optionally strided) grid; trials replace those of the same config."""
    p = _paths(base)
    meta = read_feature_schema(spark, p["schema"])
    train_rows = assign_folds(read_dataset(spark, p["dataset"], "train"), "full_name", seed, k)
    jobs = grid_configs(list(models) if models else None, max_jobs)
    trials = grid_search(train_rows, meta["feature_columns"], jobs, "fold", k, parallelism)
    write_trials(trials, p["trials"])
    return trials


def select(spark: SparkSession, base: str, deployment_time: str) -> DataFrame:
    """Best config per family, refit on all train rows, scored on test;
    the winner by CV score is saved with its metadata."""
    p = _paths(base)
    meta = read_feature_schema(spark, p["schema"])
    train_rows = read_dataset(spark, p["dataset"], "train")
    test_rows = read_dataset(spark, p["dataset"], "test")
    results, winner, model = select_best(scan_trials(spark, p["trials"]), train_rows, test_rows,
                                         meta["feature_columns"])
    write_results(results, p["results"])
    save_model(model, p["model"])
    best = results.where(F.col("model_name") == winner).first().asDict()
    write_metadata(spark, {"model_name": winner, "log_target": True, "deployment_time": deployment_time,
                           "metrics": {kk: v for kk, v in best.items() if kk != "best_hyperparameters"}},
                   p["metadata"])
    return results


def load_artifacts(spark: SparkSession, base: str) -> tuple[object, dict, dict]:
    """(model, feature schema, metadata) of the saved winner; a missing one raises."""
    p = _paths(base)
    meta = read_feature_schema(spark, p["schema"])
    metadata = read_metadata(spark, p["metadata"])
    return load_model(spark, p["model"], metadata["model_name"]), meta, metadata


def predict(spark: SparkSession, base: str, entities: DataFrame, as_of: str, names: DataFrame | None = None,
            contributors: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Entities that can't be featurised, and wanted ``names`` that are unknown, are set aside with a
    reason (none valid -> error); the rest is featurised, encoded with the trained vocabularies, scored
    and ranked.  The label is not needed.  A model trained with contributor counts gets them from
    ``contributors`` (full_name, contributor_count), 0 where missing.  Returns the written tables
    (ranked, skipped, report)."""
    p = _paths(base)
    model, meta, _ = load_artifacts(spark, base)
    bad_names = None
    if names is not None:
        names = names.select("full_name").distinct()
        bad_names = names.join(entities.select("full_name").distinct(), "full_name", "left_anti") \
            .withColumn("reason", F.lit("not found"))
        entities = entities.join(names, "full_name", "left_semi")
    if meta["uses_contributors"] and contributors is not None:
        entities = enrich_counts(entities.drop("contributor_count"), contributors, "full_name", "contributor_count")
    valid, bad = quarantine(entities, target=None)
    skipped = bad.select("full_name", "reason")
    skipped = skipped.unionByName(bad_names) if bad_names is not None else skipped
    skipped.write.mode("overwrite").parquet(p["skipped"])
    require_rows(valid, "no valid entities")
    if "pos" not in valid.columns:
        valid = valid.withColumn("pos", F.monotonically_increasing_id())
    feats = make_features(valid, as_of)
    score_table(model, feats, meta["feature_columns"], meta["top_langs"], meta["top_licenses"]) \
        .write.mode("overwrite").parquet(p["ranked"])
    ranked = spark.read.parquet(p["ranked"])
    ranked_report(ranked.select("rank", "pos", "full_name", "predicted_stars"), "full_name", "predicted_stars", rank_col="rank") \
        .write.mode("overwrite").parquet(p["report"])
    return ranked, spark.read.parquet(p["skipped"]), spark.read.parquet(p["report"])
