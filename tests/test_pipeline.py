"""The whole flow through shared storage: merge -> build -> train ->
select -> predict, on the smoke data."""

from pyspark.sql import functions as F

from velorank.plans import pipeline
from velorank.session import scratch_path
from velorank.sources.files import write_shards
from velorank.sources.fixtures import AS_OF, repos, repos_with_duplicates

SMOKE = "/root/testdata/sf0.001"


def test_end_to_end(spark):
    from velorank.operators.bands import assign_band
    base = scratch_path(spark, "pipeline")
    shards = f"{base}/shards"
    dups = assign_band(repos_with_duplicates(spark, SMOKE))
    write_shards(dups.withColumn("shard", F.concat(F.lit("repos_"), F.col("label"), F.lit(".jsonl")))
                 .drop("band", "lo", "hi", "label"), shards, "shard", "pos")
    n = pipeline.merge(spark, shards, base)
    assert n == repos(spark, SMOKE).count()

    meta = pipeline.build(spark, base, AS_OF)
    assert meta["n_train"] + meta["n_test"] == n

    trials = pipeline.train(spark, base, models=["LinearRegression", "Ridge"])
    assert trials.count() == 6

    results = pipeline.select(spark, base, "2002-01-01T00:00:00+00:00")
    rows = {r["model_name"]: r for r in results.collect()}
    assert set(rows) == {"LinearRegression", "Ridge"}
    winner = max(rows, key=lambda m: rows[m]["cv_r2"])
    assert pipeline.load_artifacts(spark, base)[2]["model_name"] == winner

    entities = repos(spark, SMOKE).withColumn(
        "created_at", F.when(F.col("pos") % 17 == 0, F.lit("garbage")).otherwise(F.col("created_at")))
    ranked, bad, report = pipeline.predict(spark, base, entities, AS_OF)
    n_bad = bad.count()
    assert n_bad > 0 and ranked.count() == n - n_bad
    assert set(bad.select("reason").distinct().toPandas()["reason"]) == {"bad created_at"}
    top = report.orderBy("rank").first()
    assert top["rank"] == 1 and len(top["bar"]) == 18


def test_cli_build_train_select(spark, capsys):
    from velorank.__main__ import main
    from velorank.session import scratch_path
    base = scratch_path(spark, "cli")
    raw = repos(spark, SMOKE)
    raw.write.parquet(f"{base}/raw")
    assert main(["build", "--base", base, "--as-of", AS_OF]) == 0
    assert main(["train", "--base", base, "--model", "Ridge", "--max-jobs", "2"]) == 0
    assert main(["select", "--base", base, "--deployment-time", "2002-01-01T00:00:00+00:00"]) == 0
    names = [r["full_name"] for r in raw.orderBy("pos").limit(3).collect()]
    assert main(["predict", "--base", base, "--entities", f"{base}/raw", "--as-of", AS_OF,
                 *names, "no/such"]) == 0
    out = capsys.readouterr().out
    assert "[skip] no/such: not found" in out and "train=" in out and "Ridge" in out and "█" in out
