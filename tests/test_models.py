"""Model plumbing: CV floor and determinism (not equality with another
library), selection and scoring end to end on the smoke data."""

import pytest
from pyspark.sql import functions as F

from velorank.operators.split import assign_folds
from velorank.plans.dataset import build_dataset
from velorank.plans.training import (grid_configs, grid_search, score_table, select_best)
from velorank.sources.fixtures import AS_OF, repos

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def data(spark):
    ds = build_dataset(repos(spark, SMOKE), AS_OF)
    df = ds.df.cache()
    train = assign_folds(df.where(F.col("split") == "train"), "full_name", 0, 5).cache()
    test = df.where(F.col("split") == "test").cache()
    return ds, train, test


def test_dataset_sizes(data):
    ds, train, test = data
    assert train.count() == ds.n_train and test.count() == ds.n_test
    assert ds.n_test == -(-2 * (ds.n_train + ds.n_test) // 10)


def test_linear_cv_floor_and_determinism(data):
    ds, train, _ = data
    jobs = grid_configs(["LinearRegression"]) + [{"model_name": "Ridge", "alpha": 1.0}]
    a = {r["config_id"]: r["cv_r2"] for r in grid_search(train, ds.feature_columns, jobs).collect()}
    b = {r["config_id"]: r["cv_r2"] for r in grid_search(train, ds.feature_columns, jobs).collect()}
    assert a == b
    assert min(a.values()) >= 0.95


def test_forest_and_boosting_fit(data):
    ds, train, _ = data
    jobs = [{"model_name": "RandomForest", "n_estimators": 20, "max_depth": 6, "min_samples_leaf": 1},
            {"model_name": "GradientBoosting", "n_estimators": 20, "max_depth": 3, "learning_rate": 0.1}]
    scores = [r["cv_r2"] for r in grid_search(train, ds.feature_columns, jobs).collect()]
    assert min(scores) >= 0.95


def test_select_and_score(spark, data):
    ds, train, test = data
    trials = grid_search(train, ds.feature_columns, grid_configs(["Ridge"])[:2])
    results, winner, model = select_best(trials, train, test, ds.feature_columns)
    assert winner == "Ridge" and results.count() == 1
    from velorank.functions.features import make_features
    raw = repos(spark, SMOKE).join(test.select("pos"), "pos", "left_semi")  # scoring reads fresh features
    ranked = score_table(model, make_features(raw, AS_OF), ds.feature_columns,
                         ds.meta()["top_langs"], ds.meta()["top_licenses"])
    rows = ranked.orderBy("rank").collect()
    assert len(rows) == test.count()
    preds = [r["predicted_stars"] for r in rows]
    assert preds == sorted(preds, reverse=True) and min(preds) >= 0


def test_extra_trees_and_hist_boosting_fit(data):
    ds, train, _ = data
    jobs = [{"model_name": "ExtraTrees", "n_estimators": 20, "max_depth": 6, "min_samples_leaf": 1},
            {"model_name": "HistGradientBoosting", "max_iter": 20, "learning_rate": 0.1, "max_depth": 4}]
    scores = [r["cv_r2"] for r in grid_search(train, ds.feature_columns, jobs).collect()]
    assert min(scores) >= 0.9


def test_vocab_on_train(spark):
    ds = build_dataset(repos(spark, SMOKE), AS_OF, vocab_on="train")
    assert "language_other" in ds.feature_columns and "license_key_other" in ds.feature_columns
    assert ds.df.count() == ds.n_train + ds.n_test
