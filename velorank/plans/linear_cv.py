"""Exact k-fold CV for the linear families from per-fold sufficient statistics.

``CrossValidator`` runs a fit and an evaluation job per (config, fold): 60
passes over the data for the linear grid.  Least squares only needs the
moments of each fold — count, sums of x and y, sum of y², XᵀX and Xᵀy — so:

1. one aggregate pass for per-column means (a shift that keeps the moments
   well conditioned);
2. one pass where every task reduces its Arrow batches with numpy to one
   partial moment vector per fold (``mapInPandas``), and the vectors are
   summed per fold in two levels;
3. the driver holds k vectors of d² + 2d + 3 numbers and solves every
   (config, fold): train moments = total − fold moments, validation R²
   from the fold's own moments.

Semantics are those of a standard scaler (population σ, σ = 0 -> 1)
followed by ridge with penalty α‖w‖² and a free intercept; α = 0 is the
minimum-norm least-squares solution.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.operators.sizing import collect_bounded

_EPS = np.finfo(np.float64).eps
# Groups of the first sum of partial moments.
GROUPS = 256


def _layout(d: int) -> dict[str, slice]:
    o = 0
    out = {}
    for name, size in (("n", 1), ("sx", d), ("sy", 1), ("syy", 1), ("xtx", d * d), ("xty", d)):
        out[name] = slice(o, o + size)
        o += size
    out["len"] = o
    return out


def fold_moments(df: DataFrame, feature_cols: Sequence[str], label: str, fold_col: str,
                 k: int) -> tuple[dict[int, np.ndarray], np.ndarray, float]:
    """Per-fold moment vectors of the shifted features/label (see module doc)."""
    d = len(feature_cols)
    lay = _layout(d)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(feature_cols)],
                   F.avg(F.col(label).cast("double")).alias("my")).first()
    shift = np.array([means[f"m{i}"] or 0.0 for i in range(d)], dtype=np.float64)
    yshift = float(means["my"] or 0.0)
    cols = list(feature_cols)

    def partials(batches):
        from pyspark import TaskContext
        acc: dict[int, np.ndarray] = {}
        for pdf in batches:
            X = pdf[cols].to_numpy(dtype=np.float64) - shift
            y = pdf[label].to_numpy(dtype=np.float64) - yshift
            folds = pdf[fold_col].to_numpy()
            for f in np.unique(folds):
                m = folds == f
                Xf, yf = X[m], y[m]
                vec = acc.setdefault(int(f), np.zeros(lay["len"]))
                vec[lay["n"]] += Xf.shape[0]
                vec[lay["sx"]] += Xf.sum(axis=0)
                vec[lay["sy"]] += yf.sum()
                vec[lay["syy"]] += yf @ yf
                vec[lay["xtx"]] += (Xf.T @ Xf).ravel()
                vec[lay["xty"]] += Xf.T @ yf
        if not acc:        # a task without a row: an empty frame has no array type
            return
        part = TaskContext.get().partitionId() % GROUPS
        yield pd.DataFrame({"fold": list(acc), "part": [part] * len(acc), "v": [v.tolist() for v in acc.values()]})

    def added(pdf):
        return pd.DataFrame({"fold": [pdf["fold"].iloc[0]], "v": [np.sum(np.stack(pdf["v"].to_numpy()), axis=0).tolist()]})

    renamed = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols],
                        F.col(label).cast("double").alias(label), F.col(fold_col).cast("int").alias(fold_col))
    # one partial vector per input split and fold, summed in GROUPS groups and then once more:
    # no task ever adds up the partials of all splits
    parts = renamed.mapInPandas(partials, "fold int, part int, v array<double>")
    sums = parts.groupBy("fold", "part").applyInPandas(added, "fold int, v array<double>") \
        .groupBy("fold").applyInPandas(added, "fold int, v array<double>")
    out = {f: np.zeros(lay["len"]) for f in range(k)}
    for r in collect_bounded(sums, k, "fold moments"):  # k arrays of d^2 + 2d + 3 numbers
        out[r["fold"]] = np.array(r["v"])
    return out, shift, yshift


def _unpack(vec: np.ndarray, d: int):
    lay = _layout(d)
    return (vec[lay["n"]][0], vec[lay["sx"]], vec[lay["sy"]][0], vec[lay["syy"]][0],
            vec[lay["xtx"]].reshape(d, d), vec[lay["xty"]])


def solve(vec: np.ndarray, d: int, alpha: float) -> tuple[np.ndarray, float]:
    """Coefficients (per unscaled, shifted feature) and intercept of the
    scaled ridge / least-squares fit from one moment vector."""
    n, sx, sy, _, xtx, xty = _unpack(vec, d)
    mu, ybar = sx / n, sy / n
    cov = xtx / n - np.outer(mu, mu)
    var = np.clip(np.diag(cov), 0.0, None)
    # zero-variance columns keep scale 1 (their centred values are all 0)
    scale = np.where(var <= 10 * _EPS * np.maximum(np.abs(mu) ** 2, 1.0), 1.0, np.sqrt(var))
    zz = n * cov / np.outer(scale, scale)
    zy = n * (xty / n - mu * ybar) / scale
    if alpha > 0:
        w = np.linalg.solve(zz + alpha * np.eye(d), zy)
    else:
        w = np.linalg.lstsq(zz, zy, rcond=None)[0]
    beta = w / scale
    return beta, ybar - mu @ beta


def r2_from_moments(vec: np.ndarray, d: int, beta: np.ndarray, c0: float) -> float:
    """R² of ``c0 + x·beta`` on the rows summarised by ``vec``."""
    n, sx, sy, syy, xtx, xty = _unpack(vec, d)
    ss_res = syy - 2 * c0 * sy - 2 * beta @ xty + n * c0 * c0 + 2 * c0 * beta @ sx + beta @ xtx @ beta
    ss_tot = syy - sy * sy / n
    if ss_tot <= 0:
        return 1.0 if ss_res <= 0 else 0.0
    return float(1.0 - ss_res / ss_tot)


def linear_cv(df: DataFrame, feature_cols: Sequence[str], label: str, fold_col: str,
              configs: Sequence[Mapping], k: int = 5) -> list[float]:
    """Mean k-fold R² for each linear config (LinearRegression / Ridge)."""
    moments, _, _ = fold_moments(df, feature_cols, label, fold_col, k)
    d = len(feature_cols)
    total = sum(moments.values())
    scores = []
    for cfg in configs:
        alpha = float(cfg.get("alpha", 1.0)) if cfg["model_name"] == "Ridge" else 0.0
        fold_r2 = []
        for f in range(k):
            beta, c0 = solve(total - moments[f], d, alpha)
            fold_r2.append(r2_from_moments(moments[f], d, beta, c0))
        scores.append(float(np.mean(fold_r2)))
    return scores


class LinearMomentModel:
    """A fitted scaled least-squares model: prediction is one column
    expression ``y0 + sum(beta_j * (x_j - s_j))`` (whole-stage codegen,
    no Python at scoring time)."""

    def __init__(self, feature_cols: Sequence[str], beta: np.ndarray, intercept: float, shift: np.ndarray,
                 prediction_col: str = "prediction"):
        self.feature_cols = list(feature_cols)
        self.beta = np.asarray(beta, dtype=np.float64)
        self.intercept = float(intercept)
        self.shift = np.asarray(shift, dtype=np.float64)
        self.prediction_col = prediction_col

    def prediction(self):
        terms = [F.lit(float(b)) * (F.col(f"`{c}`").cast("double") - F.lit(float(s)))
                 for c, b, s in zip(self.feature_cols, self.beta, self.shift) if b != 0.0]
        expr = F.lit(self.intercept)
        for t in terms:
            expr = expr + t
        return expr

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.prediction_col, self.prediction())

    def to_json(self) -> str:
        import json
        return json.dumps({"feature_columns": self.feature_cols, "beta": self.beta.tolist(),
                           "intercept": self.intercept, "shift": self.shift.tolist()})

    def save(self, spark, path: str) -> None:
        spark.createDataFrame([(self.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> "LinearMomentModel":
        import json
        rows = spark.read.text(path).take(2)
        if len(rows) != 1:
            raise FileNotFoundError(f"model missing at {path}")
        m = json.loads(rows[0][0])
        return cls(m["feature_columns"], np.array(m["beta"]), m["intercept"], np.array(m["shift"]))


def fit_linear(df: DataFrame, feature_cols: Sequence[str], label: str, cfg: Mapping) -> LinearMomentModel:
    """Refit one linear config on all rows of ``df`` (two passes)."""
    one = df.withColumn("_vr_fold0", F.lit(0))
    moments, shift, yshift = fold_moments(one, feature_cols, label, "_vr_fold0", 1)
    alpha = float(cfg.get("alpha", 1.0)) if cfg["model_name"] == "Ridge" else 0.0
    beta, c0 = solve(moments[0], len(feature_cols), alpha)
    return LinearMomentModel(feature_cols, beta, yshift + c0, shift)
