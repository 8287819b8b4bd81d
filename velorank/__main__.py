"""Command line: one Spark job per step of the flow.

    python -m velorank ingest  --pages PATH --base DIR [--total 5000]
    python -m velorank merge   --base DIR [--shards DIR]
    python -m velorank build   --base DIR --as-of 2002-01-01T00:00:00Z [--vocab-on train]
    python -m velorank train   --base DIR [--model Ridge] [--max-jobs 30]
    python -m velorank select  --base DIR --deployment-time ISO
    python -m velorank predict --base DIR --entities PATH --as-of ISO [--contributors PATH] [names ...]

The session is the active one or what the submit configuration makes: master, memory and partitions are
never set here.  ``--base`` should be shared storage.  Every result is written whole under it; scratch
tables are removed when a step ends.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.getActiveSession() or SparkSession.builder.appName("velorank").getOrCreate()


def main(argv: list[str] | None = None) -> int:
    from velorank.plans import pipeline
    from velorank.session import ensure_utc, scratch_tables
    from velorank.sources.schema import MODELS
    p = argparse.ArgumentParser(prog="velorank")
    sub = p.add_subparsers(dest="cmd", required=True)
    steps = {name: sub.add_parser(name) for name in ("ingest", "merge", "build", "train", "select", "predict")}
    for step in steps.values():
        step.add_argument("--base", required=True)
    steps["ingest"].add_argument("--pages", required=True, help="parquet table (query, page_no, body)")
    steps["ingest"].add_argument("--total", type=int, default=0, help="entities over all bands (0 = all)")
    steps["merge"].add_argument("--shards", help="folder of shard files (default: BASE/shards)")
    steps["build"].add_argument("--as-of", required=True)
    steps["build"].add_argument("--vocab-on", choices=["all", "train"], default="all")
    steps["train"].add_argument("--model", choices=MODELS, action="append")
    steps["train"].add_argument("--max-jobs", type=int, default=0, help="configs at even distances (0 = all)")
    steps["train"].add_argument("--parallelism", type=int, default=4)
    steps["select"].add_argument("--deployment-time", required=True)
    steps["predict"].add_argument("--entities", required=True, help="parquet table of raw entity rows")
    steps["predict"].add_argument("--as-of", required=True)
    steps["predict"].add_argument("--contributors", help="parquet table (full_name, contributor_count)")
    steps["predict"].add_argument("names", nargs="*")
    a = p.parse_args(argv)

    spark = _session()
    ensure_utc(spark)
    with scratch_tables(spark):
        if a.cmd == "ingest":
            rows, bad = pipeline.ingest(spark, spark.read.parquet(a.pages), a.base, a.total)
            print(f"{rows} rows, {bad} problems")
        elif a.cmd == "merge":
            print(f"{pipeline.merge(spark, a.shards or a.base.rstrip('/') + '/shards', a.base)} unique entities")
        elif a.cmd == "build":
            meta = pipeline.build(spark, a.base, a.as_of, vocab_on=a.vocab_on)
            print(f"train={meta['n_train']} test={meta['n_test']} columns={len(meta['feature_columns'])}")
        elif a.cmd == "train":
            trials = pipeline.train(spark, a.base, a.model, a.max_jobs, parallelism=a.parallelism)
            for r in trials.select("model_name", "config_id", "cv_r2").toLocalIterator():
                print(r["model_name"], r["config_id"], r["cv_r2"])
        elif a.cmd == "select":
            pipeline.select(spark, a.base, a.deployment_time).drop("best_hyperparameters").show(len(MODELS), truncate=False)
        elif a.cmd == "predict":
            names = spark.createDataFrame([(n,) for n in a.names], "full_name string") if a.names else None
            contributors = spark.read.parquet(a.contributors) if a.contributors else None
            _, skipped, report = pipeline.predict(spark, a.base, spark.read.parquet(a.entities), a.as_of, names, contributors)
            for row in skipped.toLocalIterator():
                print(f"  [skip] {row['full_name']}: {row['reason']}")
            for row in report.orderBy("rank").toLocalIterator():
                print(f"{row['rank']:>6}  {row['name']}  {row['value_str']}  {row['bar']}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
