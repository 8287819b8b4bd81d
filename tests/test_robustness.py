"""Inputs the fixture never holds: null groups and strata, repeated names, broken pages and lines, real
shard names, repeated trials, a submitted session."""

import json

import pytest
from pyspark.sql import functions as F

from velorank.operators import bands, ingest, rank, split
from velorank.session import scratch_path, scratch_tables
from velorank.sources import files


def test_rank_within_many_groups_and_null(spark):
    rows = [(i, None if i % 2 else i // 3, i % 7) for i in range(6600)]
    got = {r["pos"]: r["rk"] for r in rank.rank_within(spark.createDataFrame(rows, "pos long, g long, v long"), ["g"], ["v", "pos"], "rk").collect()}
    assert len(got) == len(rows)
    by = {}
    for t in sorted(rows, key=lambda t: (t[2], t[0])):
        by.setdefault(t[1], []).append(t[0])
    assert all(got[p] == k for members in by.values() for k, p in enumerate(members, 1))


def test_split_takes_null_strata_and_names(spark):
    df = spark.createDataFrame([(i, None if i % 4 == 0 else i % 4, None if i < 3 else f"n{i // 2}") for i in range(80)], "pos long, b int, full_name string")
    got = split.stratified_split(df, "b").groupBy("b", "split").count().collect()
    assert {(r["b"], r["split"]): r["count"] for r in got} == {(b, s): n for b in (None, 1, 2, 3) for s, n in (("train", 16), ("test", 4))}


def test_quota_table_matches_the_list(spark):
    sizes = {0: 7, 1: 11, 2: 3, 3: 29}
    df = spark.createDataFrame([(b,) for b, n in sizes.items() for _ in range(n)], "b int")
    assert {r["b"]: r["_vr_quota"] for r in split.quota_table(df, "b", 0.2).collect()} == split.train_quotas(sizes, 0.2)


def test_folds_do_not_multiply_rows(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("c", 4)], "full_name string, pos long")
    assert sorted(r["pos"] for r in split.assign_folds(df, k=2).collect()) == [1, 2, 3, 4]


def test_quota_leaves_out_entities_without_a_band(spark):
    df = bands.assign_band(spark.createDataFrame([(1, 10), (2, 60), (3, 70)], "pos long, stargazers_count long"))
    assert [r["pos"] for r in bands.band_quota(df, 1).collect()] == [3]


def test_rank_predictions_put_nan_last(spark):
    from velorank.operators.report import ranked_report
    df = spark.createDataFrame([(1, "a", float("nan")), (2, "b", 5.0), (3, "c", None)], "pos long, name string, v double")
    got = ranked_report(df, "name", "v").orderBy("rank").collect()
    assert [r["name"] for r in got] == ["b", "a", "c"] and got[0]["value_str"] == "5" and got[1]["value_str"] is None


def page(nodes, **more):
    return json.dumps({"data": {"search": {"repositoryCount": len(nodes), "nodes": nodes}}, **more})


def node(name, **more):
    n = {"totalCount": 1}
    return {"nameWithOwner": name, "stargazerCount": 5, "createdAt": "2001-01-01T00:00:00Z", "watchers": n, "issues": n, "allIssues": n,
            "pullRequests": n, "releases": n, "repositoryTopics": n, "owner": {"__typename": "User"}, **more}


def test_bad_pages_are_reported_and_fail_a_strict_read(spark):
    good = page([node("a/1"), None, node("a/2")])
    rows = [("q", 0, good), ("q", 1, good[:60]), ("q", 2, '{"errors": [{"message": "slow"}]}'), ("q", 3, None),
            ("q", 4, page([node("a/3", watchers=None), node("a/4")])), (None, 0, page([node("b/1")]))]
    pages = spark.createDataFrame(rows, "query string, page_no int, body string")
    got = {(r["page_no"], r["node_idx"]): r["reason"] for r in ingest.pages_quarantine(pages).collect()}
    assert got == {(1, None): "unreadable page", (2, None): "errors: slow", (3, None): "empty page", (4, 0): "missing watchers"}
    names = lambda **k: sorted(r["full_name"] for r in ingest.pages_to_rows(pages, strict=False, **k).collect())
    assert names() == ["a/1", "a/2", "a/4", "b/1"] and names(max_repos=1) == ["a/1", "b/1"]
    with pytest.raises(Exception, match="page 1: unreadable page"):
        ingest.pages_to_rows(pages.where("page_no = 1")).collect()
    with pytest.raises(Exception, match="missing watchers"):
        ingest.pages_to_rows(pages.where("page_no = 4")).collect()


def test_shard_names_and_corrupt_lines(spark, tmp_path):
    (tmp_path / "repos_50_99.jsonl").write_text('{"full_name": "a", "stargazers_count": 1}\n')
    assert [r["full_name"] for r in files.scan_shards(spark, str(tmp_path)).collect()] == ["a"]
    with pytest.raises(FileNotFoundError):
        files.scan_shards(spark, str(tmp_path / "none"))
    (tmp_path / "repos_100_199.jsonl").write_text("{broken\n")
    with pytest.raises(Exception):
        files.scan_shards(spark, str(tmp_path)).collect()
    loose = files.scan_jsonl(spark, str(tmp_path), strict=False)
    _, bad = ingest.quarantine(loose.drop("_src_path", "_src_block", "_src_row"), target=None)
    assert {r["reason"] for r in bad.collect()} == {"unreadable line", "missing created_at"}


def test_stray_files_are_no_shards(spark, tmp_path):
    (tmp_path / "notes.json").write_text("{broken\n")
    (tmp_path / "repos.jsonl").write_text('{"full_name": "merged", "stargazers_count": 1}\n')
    with pytest.raises(FileNotFoundError):
        files.scan_shards(spark, str(tmp_path))
    (tmp_path / "repos_50_99.jsonl").write_text('{"full_name": "a", "stargazers_count": 1}\n')
    assert [r["full_name"] for r in files.scan_shards(spark, str(tmp_path)).collect()] == ["a"]


def test_first_record_wins_for_any_batch_size(spark, tmp_path):
    import os

    from velorank.streaming.incremental import incremental_ingest, read_ingested
    src = tmp_path / "src"
    src.mkdir()
    for k, (name, stars) in enumerate([("c", 3), ("b", 2), ("a", 1)]):   # older files have later paths
        f = src / f"repos_{name}.jsonl"
        f.write_text(json.dumps({"full_name": "x", "stargazers_count": stars}) + "\n")
        os.utime(f, (1000 + k, 1000 + k))
    schema = spark.createDataFrame([], "full_name string, stargazers_count long").schema
    for files_a_batch in (None, 1):
        target, ckpt = scratch_path(spark, "t"), scratch_path(spark, "c")
        assert incremental_ingest(spark, str(src), target, ckpt, schema, max_files_per_trigger=files_a_batch) == 1
        assert [r["stargazers_count"] for r in read_ingested(spark, target).collect()] == [1]
    with pytest.raises(FileNotFoundError):
        incremental_ingest(spark, str(tmp_path / "empty"), scratch_path(spark, "t"), scratch_path(spark, "c"), schema)


def test_trials_are_replaced_by_config_id(spark):
    path = scratch_path(spark, "trials")
    trial = lambda c, s: spark.createDataFrame([("m", c, {}, s)], "model_name string, config_id string, config map<string,string>, cv_r2 double")
    for c, s in (("c1", 0.9), ("c2", 0.7), ("c1", 0.5)):
        files.write_trials(trial(c, s), path)
    assert {r["config_id"]: r["cv_r2"] for r in files.scan_trials(spark, path).collect()} == {"c1": 0.5, "c2": 0.7}


def test_grid_configs_are_named_apart():
    from velorank.plans.training import config_id, grid_configs
    assert len({config_id(c) for c in grid_configs()}) == 114


def test_scratch_tables_are_removed(spark):
    from velorank.session import materialize, path_exists
    for fail in (False, True):
        kept = None
        try:
            with scratch_tables(spark):
                df = materialize(spark.range(3).toDF("x"))
                kept = df.inputFiles()[0].rsplit("/", 1)[0]
                assert path_exists(spark, kept)
                if fail:
                    raise KeyError
        except KeyError:
            pass
        assert not path_exists(spark, kept)


def test_command_line_leaves_the_session_as_it_is(spark):
    from velorank.__main__ import _session
    before = (spark.sparkContext.master, spark.conf.get("spark.sql.shuffle.partitions"))
    s = _session()
    assert s is spark and (s.sparkContext.master, s.conf.get("spark.sql.shuffle.partitions")) == before


def test_ingest_step(spark):
    from velorank.plans import pipeline
    base = scratch_path(spark, "ingest-step")
    pages = spark.createDataFrame([("q", 0, page([node("a/1", stargazerCount=60), node("a/2", stargazerCount=70)])), ("q", 1, "{"),
                                   ("q", 2, page([node("a/1", stargazerCount=61)]))], "query string, page_no int, body string")
    assert pipeline.ingest(spark, pages, base) == (3, 1)
    assert pipeline.merge(spark, f"{base}/shards", base) == 2
    first = spark.read.parquet(f"{base}/raw").where(F.col("full_name") == "a/1").first()
    assert first["stargazers_count"] == 60
