"""Keyed streaming target, narrow dedupe, interval join and page chain."""

import json
import random

from pyspark.sql import functions as F

from velorank.operators.dedupe import keep_first, keep_first_line
from velorank.operators.ingest import page_chain
from velorank.operators.interval import interval_join
from velorank.session import scratch_path
from velorank.sources.files import scan_jsonl
from velorank.streaming import incremental as inc

SCHEMA = "full_name string, stargazers_count long"


def _shard(folder, name, rows):
    (folder / name).write_text("".join(json.dumps({"full_name": k, "stargazers_count": v}) + "\n" for k, v in rows))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_files_read_by_a_batch_do_not_grow_with_the_target(spark, tmp_path):
    read = {}
    asked = spark.createDataFrame([("k1",), ("k2",), (None,)], "full_name string").select(F.xxhash64("full_name").alias(inc.HASH))
    for n in (200, 2000):
        src = tmp_path / f"s{n}"
        src.mkdir()
        _shard(src, "repos_1.jsonl", [(f"k{i}", i) for i in range(n)])
        target = scratch_path(spark, "keyed")
        schema = spark.createDataFrame([], SCHEMA).schema
        assert inc.incremental_ingest(spark, str(src), target, scratch_path(spark, "ck"), schema, rows_per_file=20) == n
        files = inc.live_files(spark, target).count()
        assert files >= n // 40
        read[n] = len(inc.touched_files(spark, target, asked))
        assert read[n] <= 3 < files


def test_merged_runs_keep_the_first_and_retries_add_nothing(spark, tmp_path):
    src, target, ckpt = tmp_path / "s", scratch_path(spark, "keyed"), scratch_path(spark, "ck")
    src.mkdir()
    schema = spark.createDataFrame([], SCHEMA).schema
    want = {}
    # later batches hold earlier paths: their rows come before what the target holds
    for i in range(9, 0, -1):
        rows = [("hot", i), (f"own{i}", i), (None, i)]
        _shard(src, f"repos_{i}.jsonl", rows)
        want |= {k: v for k, v in rows}
        assert inc.incremental_ingest(spark, str(src), target, ckpt, schema) == len(want)
    got = {r["full_name"]: r["stargazers_count"] for r in inc.read_ingested(spark, target).collect()}
    assert got == want and got["hot"] == 1
    assert len(inc._live_runs(spark, target)) < 2 * inc.FAN
    before = inc.manifest(spark, target).count()
    # a retry of a committed batch finds its manifest
    again = spark.createDataFrame([("late", 1, "file:/repos_0.jsonl", 0)], SCHEMA + ", _src_path string, _src_block long")
    inc._append_new(target, "full_name", ckpt, inc.ROWS_PER_FILE)(again, 0)
    assert inc.manifest(spark, target).count() == before
    assert inc.vacuum(spark, target) >= inc.FAN and inc.vacuum(spark, target) == 0
    assert {r["full_name"]: r["stargazers_count"] for r in inc.read_ingested(spark, target).collect()} == want
    # a new checkpoint reads all files again and changes nothing
    assert inc.incremental_ingest(spark, str(src), target, scratch_path(spark, "ck"), schema) == len(want)
    assert {r["full_name"]: r["stargazers_count"] for r in inc.read_ingested(spark, target).collect()} == want


def test_keep_first_line_equals_keep_first_without_sort_aggregate(spark, tmp_path):
    rng = random.Random(3)
    for name in ("repos_b.jsonl", "repos_a.jsonl", "repos c%20.jsonl"):
        _shard(tmp_path, name, [(rng.choice(["hot", "hot", None, f"k{rng.randrange(40)}"]), rng.randrange(1000)) for _ in range(300)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")   # several splits a file
    try:
        df = scan_jsonl(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema)
        assert df.rdd.getNumPartitions() > 3
        first = keep_first_line(df, "full_name")
        assert "SortAggregate" not in _plan(first)
        cols = ["full_name", "stargazers_count"]
        assert sorted(map(str, first.select(cols).collect())) == sorted(map(str, keep_first(df, "full_name").select(cols).collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_interval_join_over_overlapping_uneven_and_open_bands(spark):
    rng = random.Random(5)
    big = 2 ** 63 - 1
    values = [rng.randrange(-5000, 5000) for _ in range(400)] + [None, 0, 0, -big - 1, big]
    bands = []
    for i in range(10_000):
        lo = rng.randrange(-6000, 6000)
        bands.append((i, lo, lo + rng.choice([0, 0, 1, 7, 30, -3])))
    bands += [(10_000, -big - 1, None), (10_001, None, 5), (10_002, 4000, None), (10_003, -big - 1, big), (10_003, 0, 0)]
    points = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, value long")
    table = spark.createDataFrame(bands, "band int, lo long, hi long")
    out = interval_join(points, table, "value")
    assert out.columns == ["id", "value", "band", "lo", "hi"]
    assert "NestedLoop" not in _plan(out) and "CartesianProduct" not in _plan(out)
    want = sorted((i, b) for i, v in enumerate(values) for b, lo, hi in bands
                  if v is not None and lo is not None and lo <= v <= (big if hi is None else hi))
    assert sorted((r["id"], r["band"]) for r in out.collect()) == want
    assert interval_join(points, table.limit(0), "value").count() == 0
    assert interval_join(points.limit(0), table, "value").count() == 0


def test_page_chain_reports_each_fault(spark):
    def body(has_next, cursor):
        return json.dumps({"data": {"search": {"pageInfo": {"hasNextPage": has_next, "endCursor": cursor}}}})
    pages = [("whole", 0, body(True, "a")), ("whole", 1, body(False, "b")),
             ("gap", 0, body(True, "a")), ("gap", 2, body(False, "c")),
             ("cut", 0, body(True, "a")), ("cut", 1, body(True, "b")),
             ("twice", 0, body(True, "a")), ("twice", 0, body(True, "a")), ("twice", 1, body(False, None)),
             ("over", 0, body(False, "a")), ("over", 1, body(False, "b")),
             ("loop", 0, body(True, "a")), ("loop", 1, body(True, "a")), ("loop", 2, body(False, "a")),
             ("mute", 0, body(True, None)), ("mute", 1, body(False, None)),
             ("bad", 0, "{"), (None, 1, None), ("none", None, body(True, "a"))]
    got = page_chain(spark.createDataFrame(pages, "query string, page_no int, body string")).collect()
    assert sorted((str(r["query"]), r["page_no"], r["fault"]) for r in got) == sorted([
        ("gap", 0, "no successor"), ("gap", 2, "no predecessor"), ("cut", 1, "no successor"), ("twice", 0, "repeated"),
        ("over", 1, "after the end"), ("loop", 1, "same cursor"), ("mute", 0, "no cursor"), ("None", 1, "no predecessor")])


def test_interval_totals_equal_the_grouped_join_with_few_pairs(spark, monkeypatch):
    from velorank.operators import interval
    rng = random.Random(6)
    big = 2 ** 63 - 1
    values = [rng.randrange(-500, 500) for _ in range(300)] + [None, 0, 0, -big - 1, big]
    bands = [(i, lo, lo + rng.choice([0, 1, 70, 300, -3])) for i, lo in enumerate(rng.randrange(-600, 600) for _ in range(200))]
    bands += [(i, rng.randrange(-600, 0), None) for i in range(200, 400)] + [(400, None, 5), (401, -big - 1, big), (401, 0, 0), (None, 3, 9), (402, big, None)]
    points = spark.createDataFrame([(v, 1 + i % 7) for i, v in enumerate(values)], "value long, weight long")
    table = spark.createDataFrame(bands, "band int, lo long, hi long")
    pairs = []
    joined = interval.interval_join
    monkeypatch.setattr(interval, "interval_join", lambda *a: pairs.append(joined(*a).count()) or joined(*a))
    out = interval.interval_totals(points, table, "value", ["weight"])
    assert out.columns == ["band", "lo", "hi", "n", "weight"]
    inside = lambda lo, hi: [1 + i % 7 for i, v in enumerate(values) if v is not None and lo <= v <= (big if hi is None else hi)]
    want = sorted(str((b, lo, hi, len(inside(lo, hi)), sum(inside(lo, hi)))) for b, lo, hi in bands if lo is not None and (hi is None or lo <= hi))
    assert sorted(str(tuple(r)) for r in out.collect()) == want
    # every value meets one piece, not every band that holds it
    assert pairs == [len({v for v in values if v is not None})]
    for p, b in ((points.limit(0), table), (points, table.limit(0))):
        got = interval.interval_totals(p, b, "value", ["weight"]).collect()
        assert [r["n"] for r in got] == [0] * len(want if b is table else [])


def test_compressed_shards_are_ingested_and_few_columns_read(spark):
    from velorank.sources.files import scan_shards, write_shards
    df = spark.createDataFrame([(i, f"k{i % 7}", i, f"repos_{i % 2}.jsonl") for i in range(40)], "pos long, full_name string, stargazers_count long, shard string")
    path, target = scratch_path(spark, "packed"), scratch_path(spark, "keyed")
    write_shards(df, path, "shard", "pos", num_partitions=2, compression="snappy")
    schema = df.drop("shard").schema
    scanned = scan_shards(spark, path, schema)
    assert scanned.count() == 40 and all(f.endswith(".snappy") for f in scanned.inputFiles())
    assert inc.incremental_ingest(spark, path, target, scratch_path(spark, "ck"), schema) == 7
    got = inc.read_ingested(spark, target, columns=["full_name", "pos"])
    assert sorted(map(tuple, got.collect())) == [(f"k{k}", k if k % 2 == 0 else k + 7) for k in range(7)] and "Exchange" not in _plan(got)


def test_few_groups_start_without_a_shuffle_of_the_ranked_rows(spark):
    from velorank.operators.rank import rank_within
    df = spark.range(500).selectExpr("id", "id % 3 as g")
    assert "SortMergeJoin" not in _plan(rank_within(df, ["g"], ["id"])) and "hashpartitioning" not in _plan(rank_within(df, ["g"], ["id"]))
