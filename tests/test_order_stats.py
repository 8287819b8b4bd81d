"""Order statistics by bracketing, against sorted lists."""

import random

import pytest
from pyspark.sql import functions as F

from velorank.operators.order_stats import cut_points, kth_values


@pytest.mark.parametrize("span", [3, 10**4, 2**60])
def test_kth_values(spark, span):
    rnd = random.Random(span)
    rows = [(i % 3, rnd.randrange(-span, span), i) for i in range(900)]
    df = spark.createDataFrame(rows, "g int, v long, pos long")
    by = {g: sorted((v, p) for h, v, p in rows if h == g) for g in range(3)}
    wanted = {g: [1, 7, 150, 300] for g in range(3)}
    got = kth_values(df, F.col("v"), wanted, F.col("g"))
    for (g, r), (v, below) in got.items():
        assert v == by[g][r - 1][0] and below == sum(x < v for x, _ in by[g])
    cuts = cut_points(df, F.col("v"), F.col("pos"), wanted, F.col("g"))
    assert cuts == {(g, r): by[g][r - 1] for g in range(3) for r in wanted[g]}
    every = sorted((v, p) for _, v, p in rows)
    assert cut_points(df, F.col("v"), F.col("pos"), {None: [450]}) == {(None, 450): every[449]}


def test_rank_beyond_the_rows_raises(spark):
    with pytest.raises(ValueError):
        kth_values(spark.createDataFrame([(1,), (2,)], "v long"), F.col("v"), {None: [3]})


def test_many_rows_of_few_values(spark, monkeypatch):
    from velorank.operators import order_stats
    monkeypatch.setattr(order_stats, "READ", 3)
    values = [5] * 4000 + [9] * 4000 + [6, 7, 7, 8] + list(range(100, 2100))
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(7)
    ranks = [1, 3999, 4000, 4001, 4002, 4004, 4005, 8004, 8005, 9000, len(values)]
    got = kth_values(df, F.col("v"), {None: ranks})
    values.sort()
    assert {r: v for (_, r), (v, _) in got.items()} == {r: values[r - 1] for r in ranks}
    assert all(below == sum(x < v for x in values) for v, below in got.values())
