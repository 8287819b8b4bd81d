"""Unit tests of the operators on hand-written rows: the traps where the
obvious Spark mapping gives a different answer, and scale-relevant shapes
(hot keys, multi-file position order)."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from velorank.functions import features as feat
from velorank.operators import bands, dedupe, encode, metrics, rank, split
from velorank.session import scratch_path

AS_OF = "2002-01-01T00:00:00Z"


# ------------------------------------------------------------- W4 / T2 qcut
@pytest.mark.parametrize("n", list(range(1, 41)) + [97, 100, 1234])
def test_qcut_bucket_matches_pandas(spark, n):
    df = spark.range(1, n + 1).withColumnRenamed("id", "r")
    got = [r[0] for r in df.orderBy("r").select(rank.qcut_bucket(F.col("r"), n, 5).alias("b")).collect()]
    if n < 2:
        assert got == [0] * n
        return
    want = pd.qcut(pd.Series(np.arange(1, n + 1), dtype=float), q=5, labels=False).tolist()
    assert got == want


def test_qcut_differs_from_ntile_somewhere(spark):
    n = 7
    want = pd.qcut(pd.Series(np.arange(1, n + 1), dtype=float), q=5, labels=False).tolist()
    ntile = [min(i * 5 // n, 4) for i in range(n)]
    assert want != ntile  # the trap exists


# ---------------------------------------------------------- C1 global rank
def test_global_rank_equals_sort_with_hot_value(spark):
    # a third of the rows share one value: the tiebreak must split it
    rows = [(i, 7 if i % 3 == 0 else i % 50) for i in range(3000)]
    df = spark.createDataFrame(rows, "pos long, y long")
    ranked, n = rank.global_rank(df, ["y", "pos"], "rank", num_partitions=16)
    got = {r["pos"]: r["rank"] for r in ranked.collect()}
    want = {p: i + 1 for i, (p, _) in enumerate(sorted(rows, key=lambda t: (t[1], t[0])))}
    assert n == 3000 and got == want


def test_global_rank_plan_has_no_single_partition(spark):
    df = spark.range(1000).withColumn("y", F.col("id") % 7)
    ranked, _ = rank.global_rank(df, ["y", "id"], "rank")
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_rank_within_groups(spark):
    rows = [(i, i % 3, (i * 37) % 101) for i in range(600)]
    df = spark.createDataFrame(rows, "pos long, g long, v long")
    out = {r["pos"]: r["rk"] for r in rank.rank_within(df, ["g"], ["v", "pos"], "rk").collect()}
    for g in range(3):
        members = sorted([t for t in rows if t[1] == g], key=lambda t: (t[2], t[0]))
        for i, t in enumerate(members):
            assert out[t[0]] == i + 1


# --------------------------------------------------------- W7 / O3 / W5
@pytest.mark.parametrize("n", [5, 7, 12, 13, 101])
def test_fold_id_is_contiguous_blocks(spark, n):
    df = spark.range(n).withColumnRenamed("id", "r0")
    got = [r[0] for r in df.orderBy("r0").select(rank.fold_id(F.col("r0"), n, 5)).collect()]
    want = np.concatenate([np.full(len(b), i) for i, b in enumerate(np.array_split(np.arange(n), 5))]).tolist()
    assert got == want


@pytest.mark.parametrize("n,k", [(114, 30), (100, 7), (15, 15), (15, 0), (1000, 999), (37, 5)])
def test_stride_sample_matches_list_stride(spark, n, k):
    df = spark.range(n).withColumnRenamed("id", "pos")
    got = sorted(r[0] for r in rank.stride_sample(df, ["pos"], k).collect())
    if not k or k >= n:
        want = list(range(n))
    else:
        step = n / k
        want = sorted({int(i * step) for i in range(k)})
    assert got == want


def test_train_quotas_largest_remainder():
    q = split.train_quotas({0: 3, 1: 3, 2: 3, 3: 3, 4: 3}, 0.2)
    assert sum(q.values()) == 15 - math.ceil(0.2 * 15)
    assert q == {0: 3, 1: 3, 2: 2, 3: 2, 4: 2}


def test_stratified_split_sizes(spark):
    df = spark.createDataFrame([(i, f"n{i}", i % 5) for i in range(103)], "pos long, full_name string, b int")
    out = split.stratified_split(df, "b", "full_name", 0.2, 0)
    counts = {r[0]: r[1] for r in out.groupBy("split").count().collect()}
    assert counts["test"] == math.ceil(0.2 * 103) and counts["train"] == 103 - counts["test"]


# ------------------------------------------------------------ P6 / T4 days
def test_whole_days_floor_not_datediff(spark):
    df = spark.createDataFrame([("2001-12-31T23:00:00Z",), ("2002-01-01T00:00:01Z",), ("2001-12-30T00:00:00Z",)],
                               "t string")
    got = [r[0] for r in df.select(feat.whole_days_since(F.col("t"), AS_OF)).collect()]
    assert got == [0, -1, 2]


def test_strict_timestamp_raises_and_try_gives_null(spark):
    df = spark.createDataFrame([("2001-12-31 23:00:00",)], "t string")
    assert df.select(feat.epoch_seconds(F.col("t"), strict=False)).first()[0] is None
    with pytest.raises(Exception):
        df.select(feat.epoch_seconds(F.col("t"), strict=True)).collect()


# -------------------------------------------------------------- P2 / P3 / P12
def test_code_point_length_and_presence(spark):
    df = spark.createDataFrame([("né😀", ""), (None, None), ("abc", "mit")], "d string, lic string")
    rows = df.select(feat.text_length(F.col("d")), feat.is_present(F.col("lic"))).collect()
    assert [tuple(r) for r in rows] == [(3, 0), (0, 0), (3, 1)]


def test_last_page_number(spark):
    urls = ["https://x/c?per_page=1&page=34", "https://x/c?page=7&per_page=1", "https://x/c", "https://x?page=3#top"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    got = [r[0] for r in df.select(feat.last_page_number(F.col("u"), F.lit(1).cast("long"))).collect()]
    assert got == [34, 1, 1, 3]


# ------------------------------------------------------------- A1 / T7 / E2
def test_top_values_ties_by_first_position(spark):
    rows = [(0, "b"), (1, "a"), (2, "a"), (3, "b"), (4, "c")]
    df = spark.createDataFrame(rows, "pos long, v string")
    assert encode.top_values(df, "v", 2) == ["b", "a"]


def test_one_hot_columns_sorted_and_other_merges(spark):
    df = spark.createDataFrame([(0, "other"), (1, "x"), (2, "y")], "pos long, language string")
    b = df.select("pos", encode.rare_bucket(F.col("language"), ["other", "x"]).alias("language"))
    vocab = encode.present_values(b, "language")
    assert vocab == ["other", "x"]
    wide = encode.one_hot(b, {"language": vocab})
    assert wide.columns == ["pos", "language_other", "language_x"]
    assert [tuple(r) for r in wide.orderBy("pos").collect()] == [(0, 1, 0), (1, 0, 1), (2, 1, 0)]


def test_align_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, extra int")
    out = encode.align_columns(df, ["b", "zz", "a"])
    assert out.columns == ["b", "zz", "a"] and tuple(out.first()) == (2, 0, 1)


# -------------------------------------------------------- A5 / T5 argmax
def test_best_per_group_nan_last_first_wins(spark):
    rows = [("m", "c1", float("nan")), ("m", "c2", 0.5), ("m", "c0", 0.5), ("n", "c3", float("nan"))]
    df = spark.createDataFrame(rows, "model_name string, config_id string, cv_r2 double")
    got = {r["model_name"]: r["config_id"] for r in metrics.best_per_group(df, "model_name", "cv_r2",
                                                                            "config_id").collect()}
    assert got == {"m": "c0", "n": "c3"}


def test_exact_median_even_and_odd(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([5, 1, 3, 2])], "pos long, x double")
    assert metrics.exact_median(df, "x", "pos") == 2.5
    assert metrics.exact_median(df.where("pos < 3"), "x", "pos") == 3.0


def test_regression_metrics_perfect(spark):
    df = spark.createDataFrame([(i, y, math.log1p(y)) for i, y in enumerate([10, 100, 1000])],
                               "pos long, y long, lp double")
    m = metrics.regression_metrics(df, "y", "lp", "pos").first()
    assert m["r2_log"] == pytest.approx(1.0) and m["mae_star"] == pytest.approx(0.0, abs=1e-9)


# ----------------------------------------------------------- W9 / J1 / A9
def test_band_edges_and_labels(spark):
    b = bands.bands_df(spark).orderBy("band").collect()
    assert tuple(b[0]) == (0, 50, 99, "50_99") and tuple(b[-1]) == (11, 102400, None, "102400_max") and len(b) == 12


def test_assign_band_exact_edges(spark):
    vals = [49, 50, 99, 100, 102399, 102400, 10**9]
    df = spark.createDataFrame([(v,) for v in vals], "stargazers_count long")
    got = [r["band"] for r in bands.assign_band(df).collect()]
    assert got == [None, 0, 0, 1, 10, 11, 11]


# ------------------------------------------------------------ W1 / T1
def test_keep_first_follows_path_then_line_order(spark, tmp_path):
    d = str(tmp_path / "shards")
    rows = [("repos_100_199.jsonl", 1, "a", 1), ("repos_50_99.jsonl", 2, "a", 2),
            ("repos_100_199.jsonl", 3, "b", 3), ("repos_100_199.jsonl", 4, "b", 4)]
    df = spark.createDataFrame(rows, "shard string, pos long, full_name string, stargazers_count long")
    from velorank.sources.files import scan_shards, write_shards
    write_shards(df, d, "shard", "pos", num_partitions=2)
    scanned = scan_shards(spark, d, spark.createDataFrame([], "pos long, full_name string, "
                                                            "stargazers_count long").schema)
    first = dedupe.keep_first(scanned.drop("shard"), "full_name")
    got = {r["full_name"]: r["pos"] for r in first.collect()}
    # '100_199' sorts before '50_99' lexicographically
    assert got == {"a": 1, "b": 3}


def test_scan_shards_empty_dir_raises(spark, tmp_path):
    from velorank.sources.files import scan_shards
    with pytest.raises(Exception):
        scan_shards(spark, str(tmp_path / "nothing"))


# ----------------------------------------------------------- S5 / S7 / S10
def test_feature_schema_roundtrip(spark):
    from velorank.sources.files import read_feature_schema, write_feature_schema
    meta = {"target": "stargazers_count", "feature_columns": ["a", "b"], "top_langs": ["x", "other"],
            "top_licenses": ["mit", "other"], "uses_contributors": False, "n_train": 8, "n_test": 2}
    p = scratch_path(spark, "schema-test")
    write_feature_schema(spark, meta, p)
    assert read_feature_schema(spark, p) == meta


def test_timing_csv_all_doubles(spark, tmp_path):
    from velorank.operators.report import relative_to_first
    from velorank.sources.files import scan_timing_csv
    p = tmp_path / "h.csv"
    p.write_text("workers,seconds\n1,100\n2,55\n4,30\n")
    df = scan_timing_csv(spark, str(p))
    out = relative_to_first(df, "workers", "workers", "seconds").orderBy("workers").collect()
    assert [round(r["ratio"], 6) for r in out] == [1.0, round(100 / 55, 6), round(100 / 30, 6)]


def test_guarded_overwrite(spark, tmp_path):
    from velorank.sources.files import guarded_write_jsonl, holds_real_records
    target = str(tmp_path / "real")
    spark.createDataFrame([("x",)], "full_name string").write.json(target)
    assert holds_real_records(spark, target)
    with pytest.raises(RuntimeError):
        guarded_write_jsonl(spark.createDataFrame([("y",)], "full_name string"), target)
    fresh = str(tmp_path / "fresh")
    guarded_write_jsonl(spark.createDataFrame([("y",)], "full_name string"), fresh)
    assert not holds_real_records(spark, fresh)


def test_require_rows_raises_on_empty(spark):
    from velorank.operators.ingest import require_rows
    with pytest.raises(RuntimeError):
        require_rows(spark.range(0))


# ------------------------------------------------------------------ M1 / M2
def test_grid_size_and_config_id():
    from velorank.plans.training import config_id, grid_configs
    jobs = grid_configs()
    assert len(jobs) == 114
    assert len(grid_configs(limit=30)) == 30
    cid = config_id({"model_name": "Ridge", "alpha": 1.0})
    assert cid.startswith("Ridge_") and len(cid) == len("Ridge_") + 12


# ----------------------------------------------------------------- S1 / T9
def test_scan_jsonl_failfast_and_permissive(spark, tmp_path):
    from velorank.sources.files import scan_jsonl
    p = tmp_path / "raw.jsonl"
    p.write_text('{"full_name": "a/b", "stargazers_count": 5}\n{"full_name": "c/d", "stargazers_count": "many"}\n')
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("full_name", T.StringType()), T.StructField("stargazers_count", T.LongType())])
    with pytest.raises(Exception):
        scan_jsonl(spark, str(p), schema, strict=True).collect()
    rows = scan_jsonl(spark, str(p), schema, strict=False).orderBy("_src_row").collect()
    assert rows[0]["_corrupt_record"] is None and rows[1]["_corrupt_record"] is not None
    assert rows[1]["stargazers_count"] is None


def test_blank_json_lines_are_skipped(spark, tmp_path):
    # T8 (declared deviation): the reference raises on a blank line, Spark skips it
    from pyspark.sql import types as T

    from velorank.sources.files import scan_jsonl
    p = tmp_path / "blank.jsonl"
    p.write_text('{"full_name": "a/b"}\n\n{"full_name": "c/d"}\n')
    schema = T.StructType([T.StructField("full_name", T.StringType())])
    assert scan_jsonl(spark, str(p), schema, strict=True).count() == 2


def test_guard_empty_and_unparsable_targets(spark, tmp_path):
    from velorank.sources.files import holds_real_records
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "part-0.json").write_text("")
    assert not holds_real_records(spark, str(empty))
    junk = tmp_path / "junk"
    junk.mkdir()
    (junk / "part-0.json").write_text("not json at all\n")
    assert holds_real_records(spark, str(junk))
