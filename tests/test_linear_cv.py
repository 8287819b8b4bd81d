"""Exact linear CV from fold moments equals a brute-force scaled ridge /
least-squares CV computed with numpy on the collected rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from velorank.plans.linear_cv import linear_cv


def _brute(X, y, folds, alpha, k=5):
    scores = []
    for f in range(k):
        tr, va = folds != f, folds == f
        mu, sd = X[tr].mean(axis=0), X[tr].std(axis=0)
        sd = np.where(sd == 0, 1.0, sd)
        Z = (X[tr] - mu) / sd
        yc = y[tr] - y[tr].mean()
        if alpha > 0:
            w = np.linalg.solve(Z.T @ Z + alpha * np.eye(X.shape[1]), Z.T @ yc)
        else:
            w = np.linalg.lstsq(Z, yc, rcond=None)[0]
        pred = ((X[va] - mu) / sd) @ w + y[tr].mean()
        ss_res = ((y[va] - pred) ** 2).sum()
        ss_tot = ((y[va] - y[va].mean()) ** 2).sum()
        scores.append(1 - ss_res / ss_tot)
    return float(np.mean(scores))


@pytest.mark.parametrize("alpha", [0.0, 0.01, 1.0, 100.0])
def test_linear_cv_matches_brute_force(spark, alpha):
    rng = np.random.default_rng(3)
    n, d = 400, 6
    X = rng.normal(size=(n, d)) * np.array([1, 10, 1000, 0.1, 5, 1])
    X[:, 3] = 0.0  # a constant column (scale 1, coefficient 0)
    X[:, 5] = 2 * X[:, 0]  # collinear
    y = X @ rng.normal(size=d) + rng.normal(size=n)
    folds = np.arange(n) % 5
    rows = [tuple(map(float, X[i])) + (float(y[i]), int(folds[i])) for i in range(n)]
    cols = [f"x{j}" for j in range(d)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", label double, fold int")
    cfg = {"model_name": "Ridge", "alpha": alpha} if alpha else {"model_name": "LinearRegression"}
    got = linear_cv(df.repartition(7), cols, "label", "fold", [cfg], 5)[0]
    assert got == pytest.approx(_brute(X, y, folds, alpha), abs=1e-6)


def test_fit_linear_predictions_and_roundtrip(spark):
    from velorank.plans.linear_cv import LinearMomentModel, fit_linear
    from velorank.session import scratch_path
    rng = np.random.default_rng(5)
    n = 300
    X = rng.normal(size=(n, 3)) * np.array([1.0, 50.0, 0.2])
    y = X @ np.array([0.5, -0.02, 3.0]) + 1.0 + rng.normal(size=n) * 0.1
    df = spark.createDataFrame([tuple(map(float, X[i])) + (float(y[i]),) for i in range(n)],
                               "a double, b double, c double, label double")
    model = fit_linear(df, ["a", "b", "c"], "label", {"model_name": "Ridge", "alpha": 1.0})
    mu, sd = X.mean(axis=0), X.std(axis=0)
    Z = (X - mu) / sd
    w = np.linalg.solve(Z.T @ Z + np.eye(3), Z.T @ (y - y.mean()))
    want = Z @ w + y.mean()
    got = np.array([r["prediction"] for r in model.transform(df).collect()])
    assert np.allclose(got, want, atol=1e-8)
    path = scratch_path(spark, "lin-model")
    model.save(spark, path)
    again = LinearMomentModel.load(spark, path)
    got2 = np.array([r["prediction"] for r in again.transform(df).collect()])
    assert np.allclose(got2, got, atol=0)


def test_more_partitions_than_rows(spark):
    rows = [(float(i), float(2 * i + 1), i % 2) for i in range(8)]
    df = spark.createDataFrame(rows, "x double, label double, fold int")
    cfg = [{"model_name": "LinearRegression"}]
    spread = df.repartition(32)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert linear_cv(spread, ["x"], "label", "fold", cfg, k=2) == pytest.approx([1.0])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
