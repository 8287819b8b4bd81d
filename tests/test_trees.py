"""Distributed trees against one-task trees and a one-by-one best-first order."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from velorank.trees import ensembles as E
from velorank.trees import growth as G
from velorank.trees import splits as S
from velorank.trees.binning import bin_rows

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    n = 400
    x = np.column_stack([rng.integers(0, 30, n), rng.integers(0, 2, n), rng.integers(0, 200, n)]).astype(float)
    y = np.round(x[:, 0] * 2 + 30 * x[:, 1] * (x[:, 2] > 90) + rng.integers(0, 9, n))
    df = spark.createDataFrame([(i, float(y[i]), i % 3, *map(float, x[i])) for i in range(n)], "pos long, y double, fold int, a double, b double, c double")
    return df, bin_rows(df, NAMES, F.col("y"), "pos", F.col("fold")), x, y


def best_first(x, y, rules):
    """Leaves of the tree that splits the best leaf again and again: arrays of row numbers."""
    def best(rows):
        top = (0.0, None)
        for f in range(x.shape[1]):
            for c in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= c]
                right = np.setdiff1d(rows, left)
                if min(len(left), len(right)) >= rules.min_leaf:
                    g = y[left].sum() ** 2 / len(left) + y[right].sum() ** 2 / len(right) - y[rows].sum() ** 2 / len(rows)
                    if g > top[0] * (1 + 1e-9) + 1e-9:
                        top = (g, (left, right))
        return top
    leaves = [(np.arange(len(y)), 0)]
    found = [best(leaves[0][0])]
    while rules.max_leaves is None or len(leaves) < rules.max_leaves:
        able = [i for i, (_, d) in enumerate(leaves) if found[i][1] and (rules.max_depth is None or d < rules.max_depth)]
        if not able:
            break
        i = max(able, key=lambda k: found[k][0])
        (left, right), d = found[i][1], leaves[i][1]
        leaves[i:i + 1] = [(left, d + 1), (right, d + 1)]
        found[i:i + 1] = [best(left), best(right)]
    return leaves


@pytest.mark.parametrize("rules", [S.Rules(20, None, 7), S.Rules(5, 3), S.Rules(1, 2, 3)])
def test_best_first_leaves(data, rules):
    _, design, x, y = data
    tree = G.Tree(rules)
    G.grow(design, [tree])
    a = G.pack_nodes(G.node_table(design, [tree], {}).toPandas())[0]
    a["cut"] = np.array([design.cuts[f][int(c)] if f >= 0 else 0.0 for f, c in zip(a["feature"], a["cut"])])
    leaf = G.route(a, x)
    got = sorted(tuple(np.flatnonzero(leaf == k)) for k in np.unique(leaf))
    assert got == sorted(tuple(rows) for rows, _ in best_first(x, y, rules))


@pytest.mark.parametrize("sample, random", [(70, -1), (-1, 70)])
def test_local_subtrees_equal_passes(data, sample, random):
    _, design, x, y = data
    w = S.copies(sample, np.arange(len(y))).astype(float) if sample >= 0 else np.ones(len(y))
    bins = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(design.cuts)]).astype(np.uint8)
    values, keep = (x if random >= 0 else bins), w > 0
    one = S.small_tree(values[keep], y[keep], w[keep], S.Rules(5, 4), 0, 1, None if random >= 0 else S.Layout(design.sizes), random)
    want = (one["s"] / one["n"])[G.route(one, values)]
    for local in (0, 120, 10_000):
        tree = G.Tree(S.Rules(5, 4), sample=sample, random=random)
        nodes = G.node_table(design, [tree], G.grow(design, [tree], local_rows=local)).toPandas()
        a = G.pack_nodes(nodes)[0]
        assert np.abs((a["s"] / a["n"])[G.route(a, values)] - want).max() < 1e-9


def test_boosting_by_hand(spark):
    rows = [(i, y, x) for i, (x, y) in enumerate([(0.0, 1.0), (0.0, 3.0), (1.0, 5.0), (1.0, 7.0)])]
    df = spark.createDataFrame(rows, "pos long, y double, a double")
    cfg = {"model_name": "GradientBoosting", "n_estimators": 3, "learning_rate": 0.5, "max_depth": 1}
    got = {r["pos"]: r["prediction"] for r in E.fit(df, ["a"], "y", cfg).transform(df).collect()}
    # mean 4; residual means -2 and 2, halved every round: 4 -+ (1 + 0.5 + 0.25)
    assert got == pytest.approx({0: 2.25, 1: 2.25, 2: 5.75, 3: 5.75})


def test_cv_shares_trees_and_saved_models_agree(spark, data, tmp_path):
    df, design, _, _ = data
    configs = [{"model_name": "RandomForest", "n_estimators": k, "max_depth": d, "min_samples_leaf": 5} for k in (1, 3) for d in (2, None)]
    both = E.forest_cv(design, configs)
    assert both == pytest.approx([E.forest_cv(design, [c])[0] for c in configs], abs=1e-9)
    boost = [{"model_name": "GradientBoosting", "n_estimators": k, "learning_rate": 0.5, "max_depth": 2} for k in (1, 4)]
    got = E.boosted_cv(design, boost)
    assert got[0] < got[1] <= 1 and got[0] == pytest.approx(E.boosted_cv(design, boost[:1])[0])
    model = E.fit(df, NAMES, "y", configs[1])
    model.save(str(tmp_path / "m"))
    again = E.TreeEnsemble.load(spark, str(tmp_path / "m"))
    told = lambda m: {r["pos"]: r["prediction"] for r in m.transform(df.select("pos", *NAMES)).collect()}
    assert told(model) == told(again)


def test_one_row_and_constant_features(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0, None)], "pos long, y double, a double, b double")
    for name in ("RandomForest", "ExtraTrees", "GradientBoosting", "HistGradientBoosting"):
        cfg = {"model_name": name, "n_estimators": 2, "max_iter": 2}
        assert E.fit(df, ["a", "b"], "y", cfg).transform(df).first()["prediction"] == pytest.approx(2.0)


def test_packed_histograms_and_column_routing_equal_plain_counting():
    rng = np.random.default_rng(8)
    n, sizes = 500, np.array([2, 7, 2, 1, *[2] * 9, 256])
    bins = np.column_stack([rng.integers(0, s, n) for s in sizes]).astype(np.uint8)
    layout, columns = S.Layout(sizes), np.ascontiguousarray(bins.T)
    assert len(layout.packed) == 4 < len(sizes)          # eleven features of two bins are two columns
    assert (layout.unpack(layout.pack(columns)) == columns).all()
    slot, w, g = rng.integers(0, 3, n), rng.integers(1, 4, n).astype(float), rng.normal(size=n)
    for weight in (w, np.ones(n)):
        got = S.histograms(layout.pack(columns), slot, weight, g, 3, layout)
        for f, size in enumerate(sizes):
            for s, b in np.ndindex(3, int(size)):
                at = (slot == s) & (bins[:, f] == b)
                assert got[s, layout.start[f] + b] == pytest.approx([weight[at].sum(), (weight * g)[at].sum()])
    tree = {"feature": np.array([13, 1, -1, -1, 0, -1, -1]), "cut": np.array([100.0, 3, 0, 0, 0, 0, 0]),
            "left": np.array([1, 2, -1, -1, 5, -1, -1]), "right": np.array([4, 3, -1, -1, 6, -1, -1])}
    told = np.array([0.0, 0, 1.5, 2.5, 0, 2.5, 2.5])
    assert (S.settle(tree, columns, told) == told[G.route(tree, bins)]).all()
    assert (S.draw(5, np.arange(9)) < 1).all() and (S._modulo(np.array([0, S.PRIME, 2 * S.PRIME, 2 ** 62])) == np.array([0, 0, 0, 2 ** 62 % S.PRIME])).all()


def test_held_out_scores_read_few_nodes_at_once(data, monkeypatch):
    _, design, _, _ = data
    configs = [{"model_name": "RandomForest", "n_estimators": 3, "max_depth": d, "min_samples_leaf": 2} for d in (2, None)]
    want = E.forest_cv(design, configs)
    seen = []
    monkeypatch.setattr(E, "NODES_AT_ONCE", 300)
    pack = G.pack_nodes
    monkeypatch.setattr(G, "pack_nodes", lambda rows: seen.append((len(rows), rows["tree"].nunique())) or pack(rows))
    assert E.forest_cv(design, configs) == pytest.approx(want, abs=1e-12)
    assert len(seen) > 1 and all(n <= 300 or trees == 1 for n, trees in seen)


def test_small_nodes_by_rows_equal_histograms(monkeypatch):
    rng = np.random.default_rng(5)
    sizes, n = np.array([1, 2, 2, 40, 255]), 900
    bins = np.array([rng.integers(0, s, n) for s in sizes], np.uint8)
    layout, w = S.Layout(sizes), rng.integers(1, 4, n).astype(float)
    packed, y = layout.pack(bins), np.round(bins[3] * 0.3 + 5 * bins[1] + rng.normal(size=n))
    slot, rows = rng.integers(0, 60, n), np.arange(n)
    want = S.best_splits(S.histograms(packed, slot, w, y, 60, layout), layout, 3)
    got = S.best_of_few(packed, rows, slot, w, y, 60, layout, 3)
    for k in ("feature", "cut"):
        assert (got[k] == want[k])[want["gain"] > 0].all()
    assert got["gain"] == pytest.approx(want["gain"])
    trees = []
    for few in (0, 1 << 30):
        monkeypatch.setattr(S, "FEW_ROWS", few)
        trees.append(S.small_tree(None, y, w, S.Rules(3), 0, 1, layout, -1, packed))
    assert all((trees[0][k] == trees[1][k]).all() for k in ("feature", "cut", "left", "right", "key", "depth"))


def test_random_trees_on_bins_and_raw_values_equal_raw_values_alone():
    rng = np.random.default_rng(6)
    x = np.array([rng.integers(0, 3, 500) * 7.0, rng.normal(size=500), rng.integers(0, 2, 500) - 1.0])
    y, values = np.round(x[0] + 3 * x[1] + x[2]), [np.array([0.0, 7.0, 14.0]), None, np.array([-1.0, 0.0])]
    mixed = S.Mixed(values)
    codes = mixed.layout.pack(np.array([np.searchsorted(values[j], x[j]) for j in mixed.exact], np.uint8))
    one = S.small_tree(None, y, np.ones(500), S.Rules(2), 0, 1, None, 9, codes, x[mixed.wide], mixed)
    raw = S.small_tree(x.T, y, np.ones(500), S.Rules(2), 0, 1, None, 9)
    assert all((one[k] == raw[k]).all() for k in ("feature", "cut", "left", "right", "n"))
    places, wide = S.mixed_places(mixed)
    told = S.leaves({**one, "cut": mixed.code_cuts(one["feature"], one["cut"])}, 500, codes, places, x[mixed.wide], wide)
    assert (told == G.route(raw, x.T)).all()


def test_a_pass_reads_blocks_in_as_many_tasks_as_cores(data, monkeypatch):
    from velorank.trees import binning as B
    df, _, x, y = data
    monkeypatch.setattr(B, "BLOCK", 7)                 # many blocks a part
    design = bin_rows(df, NAMES, F.col("y"), "pos", F.col("fold"))
    rows = design.rows.select("n").collect()
    assert sum(r["n"] for r in rows) == len(y) and max(r["n"] for r in rows) <= 7
    cores = df.sparkSession.sparkContext.defaultParallelism
    assert G._columns(design, G.NO_STATE, [G.Tree(S.Rules())], False).rdd.getNumPartitions() <= cores
    told = E.fold_sums(design)
    for f in range(3):
        own = y[np.arange(len(y)) % 3 == f]
        assert told[f] == pytest.approx((len(own), own.sum(), ((own - own.mean()) ** 2).sum()))


def test_a_row_without_label_is_an_error(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0), (2, None, 4.0)], "pos long, y double, a double")
    with pytest.raises(Exception, match="without key, label or fold"):
        E.fit(df, ["a"], "y", {"model_name": "GradientBoosting", "n_estimators": 1})
