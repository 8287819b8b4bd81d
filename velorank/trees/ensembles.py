"""Forests and boosted trees on shared histogram passes, their cross-validation and vectorised scoring.

* RandomForest: bootstrap by seeded Poisson copies of every row, all features at every split.
* ExtraTrees: every row, one seeded random threshold per (node, feature) between the node's least and
  largest value, the best of them splits.
* GradientBoosting: starts from the mean, every tree is fitted to the residuals and shrunk.
* HistGradientBoosting: the same with leaf-wise trees: best gain first, at most 31 leaves of at least 20
  rows, no depth limit unless the config sets one.

A forest of 300 trees begins with the one of 100, a tree cut at depth 10 is the top of the deeper one, and
400 rounds pass through the 200th; cross-validation grows each once and reads all configs off it.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from velorank.session import materialize, remove_path
from velorank.trees import growth as G
from velorank.trees.binning import Binned, as_block, bin_rows, block_schema, read_blocks, write_blocks
from velorank.trees.splits import Layout, Rules, leaves, mixed_places

# Library defaults of the families.
DEFAULTS = {"n_estimators": 200, "min_samples_leaf": 1, "learning_rate": 0.1, "max_depth": 3, "max_iter": 200}
SEED, BINS, HIST_LEAVES, HIST_MIN_LEAF = 68, 255, 31, 20
FORESTS, BOOSTED = ("RandomForest", "ExtraTrees"), ("GradientBoosting", "HistGradientBoosting")

LOCAL_ROWS = 1 << 15               # rows of a node that one task may hold to grow its subtree
TREES_AT_ONCE = 64                 # trees grown together in shared passes, fewer if the histograms of their open nodes
OPEN_BYTES = 384 << 20             # would take the driver more than this
NODES_AT_ONCE = 1 << 19            # nodes the driver sends to the tasks at once when scoring (a larger tree by itself)
WRITE_EVERY = 16                   # rounds between written residuals


def rules_of(cfg: Mapping) -> Rules:
    name, depth = cfg["model_name"], cfg.get("max_depth")
    if name in FORESTS:
        return Rules(int(cfg.get("min_samples_leaf", DEFAULTS["min_samples_leaf"])), None if depth is None else int(depth))
    if name == "GradientBoosting":
        return Rules(1, int(DEFAULTS["max_depth"] if depth is None else depth))
    if name == "HistGradientBoosting":
        return Rules(HIST_MIN_LEAF, None if depth is None else int(depth), HIST_LEAVES)
    raise ValueError(f"unknown model {name}")


def size_of(cfg: Mapping) -> int:
    key = "max_iter" if cfg["model_name"] == "HistGradientBoosting" else "n_estimators"
    return int(cfg.get(key, DEFAULTS[key]))


def rate_of(cfg: Mapping) -> float:
    return float(cfg.get("learning_rate", DEFAULTS["learning_rate"]))


def fold_sums(design: Binned) -> dict[int, tuple[float, float, float]]:
    """By fold: rows, sum of the labels, their sum of squares about the fold's mean."""
    def told(batches):
        for _, block in read_blocks(batches):
            for f in np.unique(block["fold"]):
                y = block["y"][block["fold"] == f]
                m = y.mean()
                yield pa.RecordBatch.from_pydict({"fold": [int(f)], "n": [float(len(y))], "m": [m], "q": [((y - m) ** 2).sum()]})

    out: dict[int, tuple[float, float, float]] = {}
    parts = design.rows.select("n", "y", "fold").mapInArrow(told, "fold long, n double, m double, q double")
    # three moments by fold; shifting by any one value keeps the sum of squares exact enough
    shift = parts.agg(F.min("m")).first()[0] or 0.0
    m = F.col("m") - F.lit(shift)
    for r in parts.groupBy("fold").agg(F.sum("n").alias("n"), F.sum(F.col("n") * m).alias("s"), F.sum(F.col("q") + F.col("n") * m * m).alias("q")).collect():
        out[r["fold"]] = (r["n"], r["s"] + r["n"] * shift, max(r["q"] - r["s"] * r["s"] / r["n"], 0.0))
    return out


def fold_means(design: Binned, folds: Sequence[int]) -> dict[int, float]:
    """Mean label of all rows outside each fold."""
    sums, out = fold_sums(design), {}
    for f in folds:
        rest = [v for k, v in sums.items() if k != f]
        n = sum(v[0] for v in rest)
        out[f] = sum(v[1] for v in rest) / n if n else 0.0
    return out


# ---------------------------------------------------------------- forests
def forest_trees(cfg: Mapping, numbers: Sequence[int], fold: int, base: float, seed: int) -> list[G.Tree]:
    """Trees of a forest by number; tree k is the same in a forest of any size."""
    random = cfg["model_name"] == "ExtraTrees"
    return [G.Tree(rules_of(cfg), fold, -1 if random else seed + k, seed + k if random else -1, base=base) for k in numbers]


def trees_at_once(design: Binned, cfg: Mapping, local_rows: int) -> int:
    """How many trees of a config the driver grows at once: a tree's widest level has no more open nodes than its
    depth allows and than hold ``local_rows`` rows."""
    rules, width = rules_of(cfg), Layout(design.sizes).width
    rows = sum(v[0] for v in fold_sums(design).values())
    nodes = max(1, 2 * int(rows / max(local_rows, 1)))
    if rules.max_depth is not None:
        nodes = min(nodes, 1 << max(rules.max_depth - 1, 0))
    return int(min(TREES_AT_ONCE, max(1, OPEN_BYTES // (nodes * max(width, 1) * 16))))


def grow_forest(design: Binned, trees: list[G.Tree], first: int = 0, local_rows: int = LOCAL_ROWS) -> DataFrame:
    return G.node_table(design, trees, G.grow(design, trees, local_rows=local_rows), first)


# ---------------------------------------------------------------- boosting
class Boosting:
    """Boosted models grown round by round in shared passes: one per (rules, rate, left-out fold)."""

    def __init__(self, design: Binned, models: Sequence[tuple[Rules, float, int]]):
        self.design, self.models = design, list(models)
        means = fold_means(design, {m[2] for m in models})
        self.base = np.array([means[m[2]] for m in models])
        self.trees: list[list[dict]] = [[] for _ in models]
        self.state = G.State(len(models), [[] for _ in models])
        self.path = None
        self._write(None)

    def _write(self, state: G.State | None) -> None:
        """Write the models' predictions beside the design rows; the tables of earlier rounds go."""
        base, layout, old = self.base, Layout(self.design.sizes), self.path

        def put(batches):
            for n, block in read_blocks(batches):
                f = np.repeat(base[:, None], n, axis=1) if state is None else state.read(n, block, layout)
                yield as_block(n, {**{c: block[c] for c in ("key", "y", "fold", "bins")}, "f": f})

        rows = self.design.rows.select("n", "key", "y", "fold", "bins", *([] if state is None else ["f"]))
        rows, self.path = write_blocks(rows.mapInArrow(put, block_schema(["key", "y", "fold", "bins", "f"])), "boosted")
        self.design = Binned(rows, self.design.features, self.design.cuts, self.design.values)
        self.state = G.State(len(self.models), [[] for _ in self.models])
        if old:
            remove_path(rows.sparkSession, old)

    def round(self, active: Sequence[int] | None = None) -> None:
        """One more tree of every (active) model."""
        which = list(range(len(self.models)) if active is None else active)
        trees = [G.Tree(self.models[m][0], self.models[m][2], state=m) for m in which]
        G.grow(self.design, trees, self.state)
        for m, t in zip(which, trees):
            a = t.chosen()
            a["value"] = self.models[m][1] * np.divide(a["s"], a["n"], out=np.zeros(len(a["n"])), where=a["n"].astype(float) > 0)
            self.trees[m].append(a)
            self.state.pending[m].append({k: a[k] for k in ("feature", "cut", "left", "right", "value")})
        if max(len(p) for p in self.state.pending) >= WRITE_EVERY:
            self._write(self.state)

    def held_out_errors(self) -> np.ndarray:
        """[model] sum of squared errors on its left-out fold."""
        state, layout, folds = self.state, Layout(self.design.sizes), [m[2] for m in self.models]

        def sums(batches):
            out = np.zeros(len(folds))
            for n, block in read_blocks(batches):
                f = state.read(n, block, layout)
                for k, own in enumerate(folds):
                    out[k] += ((block["y"] - f[k])[block["fold"] == own] ** 2).sum()
            yield pa.RecordBatch.from_pydict({"m": np.arange(len(folds)), "e": out})

        out = np.zeros(len(folds))
        for r in self.design.rows.select("n", "y", "fold", "bins", "f").mapInArrow(sums, "m long, e double").groupBy("m").agg(F.sum("e").alias("e")).collect():
            out[r["m"]] = r["e"]
        return out

    def node_table(self, m: int) -> DataFrame:
        frames = []
        for k, a in enumerate(self.trees[m]):
            f = pd.DataFrame({"tree": k, "node": np.arange(len(a["n"])), **{c: a[c] for c in ("feature", "cut", "left", "right", "n", "s", "key", "depth", "gain")}})
            f.loc[f["feature"] < 0, ["left", "right"]] = -1
            frames.append(f)
        names = ["tree", "node", "feature", "cut", "left", "right", "n", "s", "key", "depth", "gain"]
        return materialize(self.design.rows.sparkSession.createDataFrame(pd.concat(frames)[names], G.NODE_SCHEMA), "tree-nodes")


# ------------------------------------------------------------------ models
def tree_blocks(nodes: DataFrame) -> list[list[int]]:
    """The tree numbers of a node table in blocks of at most ``NODES_AT_ONCE`` nodes, or of one tree."""
    counts = {r["tree"]: r["n"] for r in nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}
    blocks, room = [], 0
    for t in sorted(counts):
        if not blocks or room + counts[t] > NODES_AT_ONCE:
            blocks.append([])
            room = 0
        blocks[-1].append(t)
        room += counts[t]
    return blocks


def read_trees(nodes: DataFrame, trees: list[int]) -> list[tuple[int, dict[str, np.ndarray]]]:
    """(number, arrays for ``route`` with every node's mean as ``value``) of some trees, in small types."""
    rows = nodes.where(F.col("tree").between(trees[0], trees[-1])).select("tree", "node", "feature", "cut", "left", "right", "n", "s").toPandas()
    out = []
    for t, a in zip(sorted(rows["tree"].unique().tolist()), G.pack_nodes(rows)):
        value = np.divide(a["s"], a["n"], out=np.zeros(len(a["n"])), where=a["n"] > 0)
        out.append((t, {"feature": a["feature"].astype(np.int32), "cut": a["cut"], "left": a["left"].astype(np.int32), "right": a["right"].astype(np.int32), "value": value}))
    return out


class TreeEnsemble:
    """A fitted ensemble: a table of nodes, a constant, and the weight of every tree.  Scoring routes Arrow
    batches through arrays of nodes, ``NODES_AT_ONCE`` nodes at a time."""

    def __init__(self, nodes: DataFrame, features: Sequence[str], cuts: list[np.ndarray] | None, base: float, weight: float, size: int,
                 prediction_col: str = "prediction"):
        self.nodes, self.features, self.cuts = nodes, list(features), cuts
        self.base, self.weight, self.size, self.prediction_col = base, weight, size, prediction_col

    def blocks(self) -> list[list[dict[str, np.ndarray]]]:
        """Trees in blocks of bounded size; only one block's nodes are read at a time."""
        for trees in tree_blocks(self.nodes.where(F.col("tree") < self.size)):
            yield self._read(trees)

    def _read(self, trees: list[int]) -> list[dict[str, np.ndarray]]:
        out = [a for _, a in read_trees(self.nodes, trees)]
        for a in out:
            if self.cuts is not None:      # bins to values
                a["cut"] = np.array([self.cuts[f][int(c)] if f >= 0 else 0.0 for f, c in zip(a["feature"], a["cut"])])
            a["value"] = self.weight * a["value"]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        from velorank.trees.binning import _value
        out, names = self.prediction_col, df.columns
        d = len(self.features)
        scored = df.withColumns({out: F.lit(float(self.base)), "_vr_x": F.array(*[_value(c) for c in self.features]).cast("array<double>")})
        schema = scored.drop("_vr_x").schema

        for block in self.blocks():
            def add(batches, block=block):
                for batch in batches:
                    at = batch.schema.names.index
                    x = np.asarray(batch.column(at("_vr_x")).flatten()).reshape(len(batch), d)
                    p = batch.column(at(out)).to_numpy().copy()
                    for t in block:
                        p += t["value"][G.route(t, x)]
                    arrays = [pa.array(p) if c == out else batch.column(at(c)) for c in batch.schema.names]
                    yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

            scored = scored.mapInArrow(add, scored.schema)
        return scored.select(*[F.col(f"`{f.name}`") for f in schema])

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        meta = {"features": self.features, "cuts": None if self.cuts is None else [c.tolist() for c in self.cuts],
                "base": self.base, "weight": self.weight, "size": self.size}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")

    @classmethod
    def load(cls, spark, path: str) -> "TreeEnsemble":
        rows = spark.read.text(f"{path}/meta").take(2)
        if len(rows) != 1:
            raise FileNotFoundError(f"model missing at {path}")
        m = json.loads(rows[0][0])
        return cls(spark.read.schema(G.NODE_SCHEMA).parquet(f"{path}/nodes"), m["features"],
                   None if m["cuts"] is None else [np.array(c) for c in m["cuts"]], m["base"], m["weight"], m["size"])


def fit(train: DataFrame, features: Sequence[str], label: str, cfg: Mapping, key: str = "pos", bins: int = BINS, seed: int = SEED,
        local_rows: int = LOCAL_ROWS, design: Binned | None = None) -> TreeEnsemble:
    """Fit one config of any tree family on all rows.  ``design``: these rows as written before."""
    design = design or bin_rows(train, features, F.col(label), key, bins=bins, raw=cfg["model_name"] == "ExtraTrees")
    size = size_of(cfg)
    if cfg["model_name"] in BOOSTED:
        run = Boosting(design, [(rules_of(cfg), rate_of(cfg), -1)])
        for _ in range(size):
            run.round()
        return TreeEnsemble(run.node_table(0), features, design.cuts, float(run.base[0]), rate_of(cfg), size)
    base = fold_means(design, [-1])[-1]
    nodes, per = None, trees_at_once(design, cfg, local_rows)
    for a in range(0, size, per):
        part = grow_forest(design, forest_trees(cfg, range(a, min(size, a + per)), -1, base, seed), a, local_rows)
        nodes = part if nodes is None else nodes.unionByName(part)
    cuts = None if cfg["model_name"] == "ExtraTrees" else design.cuts
    return TreeEnsemble(nodes, features, cuts, base, 1.0 / size, size)


# ------------------------------------------------------- cross-validation
def _r2(errors: Mapping[int, float], spread: Mapping[int, float]) -> float:
    return float(np.mean([1 - errors[f] / spread[f] if spread[f] > 0 else float(errors[f] <= 0) for f in spread]))


def fold_spread(design: Binned) -> dict[int, float]:
    """Per fold, the sum of squares about its own mean."""
    return {f: v[2] for f, v in fold_sums(design).items()}


def boosted_cv(design: Binned, configs: Sequence[Mapping]) -> list[float]:
    """Mean R^2 over the folds per config; all models take each round together."""
    spread = fold_spread(design)
    kinds = sorted({(str(rules_of(c)), rate_of(c)) for c in configs})
    of = {(str(rules_of(c)), rate_of(c)): rules_of(c) for c in configs}
    last = {k: max(size_of(c) for c in configs if (str(rules_of(c)), rate_of(c)) == k) for k in kinds}
    models = [(k, f) for k in kinds for f in spread]
    run = Boosting(design, [(of[k], k[1], f) for k, f in models])
    marks, scores = sorted({size_of(c) for c in configs}), {}
    for r in range(1, max(marks) + 1):
        run.round([m for m, (k, _) in enumerate(models) if last[k] >= r])
        if r in marks:
            errors = run.held_out_errors()
            for k in kinds:
                scores[k, r] = _r2({f: errors[m] for m, (q, f) in enumerate(models) if q == k}, spread)
    return [scores[(str(rules_of(c)), rate_of(c)), size_of(c)] for c in configs]


def forest_cv(design: Binned, configs: Sequence[Mapping], seed: int = SEED, local_rows: int = LOCAL_ROWS) -> list[float]:
    """Mean R^2 over the folds per config.  Configs of one family and leaf size share their trees: a smaller
    forest is the first part of a larger, a depth limit a tree's top."""
    spread, out = fold_spread(design), {}
    means = fold_means(design, list(spread))
    for name, leaf in sorted({(c["model_name"], rules_of(c).min_leaf) for c in configs}):
        own = [c for c in configs if (c["model_name"], rules_of(c).min_leaf) == (name, leaf)]
        depths = sorted({c.get("max_depth") for c in own}, key=lambda x: (x is None, x or 0))
        deepest = {"model_name": name, "min_samples_leaf": leaf, "max_depth": None if None in depths else depths[-1]}
        marks = sorted({size_of(c) for c in own})
        sums = None                # the design with the total of the trees so far per depth, a written table
        done = 0
        jobs = [(k, f) for k in range(max(marks)) for f in spread]
        # trees of one number are grown for all folds together; a block ends where a forest's size does
        per = max(1, trees_at_once(design, deepest, local_rows) // max(len(spread), 1))
        while done < max(marks):
            upto = min([done + per, *[m for m in marks if m > done]])
            block = [(k, f) for k, f in jobs if done <= k < upto]
            trees = [forest_trees(deepest, [k], f, means[f], seed)[0] for k, f in block]
            nodes = grow_forest(design, trees, local_rows=local_rows)
            sums = _add_held_out(design, nodes, block, depths, means, sums, name == "ExtraTrees")
            done = upto
            if done in marks:
                errors = _squared_errors(sums, len(depths), done)
                for i, depth in enumerate(depths):
                    out[name, leaf, depth, done] = _r2({f: e[i] for f, e in errors.items()}, spread)
    return [out[c["model_name"], rules_of(c).min_leaf, c.get("max_depth"), size_of(c)] for c in configs]


def _squared_errors(sums: Binned, depths: int, size: int) -> dict[int, list[float]]:
    """By fold and depth: squared errors of the totals of ``size`` trees."""
    def told(batches):
        for _, block in read_blocks(batches):
            for f in np.unique(block["fold"]):
                own = block["fold"] == f
                for i in range(depths):
                    yield pa.RecordBatch.from_pydict({"fold": [int(f)], "i": [i], "e": [((block["y"][own] - block["total"][i, own] / size) ** 2).sum()]})

    out: dict[int, list[float]] = {}
    rows = sums.rows.select("n", "y", "fold", "total").mapInArrow(told, "fold long, i long, e double")
    for r in rows.groupBy("fold", "i").agg(F.sum("e").alias("e")).collect():
        out.setdefault(r["fold"], [0.0] * depths)[r["i"]] = r["e"]
    return out


def _add_held_out(design: Binned, nodes: DataFrame, block: list[tuple[int, int]], depths: list, means: Mapping[int, float], sums: Binned | None,
                  raw: bool) -> Binned:
    """Add the block's trees to the running predictions of the rows they left out."""
    for trees in tree_blocks(nodes):
        own = [(block[t][1], {**a, "value": means[block[t][1]] + a["value"]}) for t, a in read_trees(nodes, trees)]
        sums = _add_trees(design if sums is None else sums, own, depths, sums is None, raw)
    return sums


def _add_trees(design: Binned, own: list[tuple[int, dict]], depths: list, first: bool, raw: bool) -> Binned:
    """Add (fold, tree) pairs, few enough for a task, to the running predictions beside the design."""
    layout, names = Layout(design.sizes), ["y", "fold", *(["codes", "x"] if raw else ["bins"])]
    places, wide = mixed_places(design.mixed) if raw else (layout.places, None)
    if raw:
        own = [(f, {**t, "cut": design.mixed.code_cuts(t["feature"], t["cut"])}) for f, t in own]

    def add(batches):
        for n, b in read_blocks(batches):
            total = np.zeros((len(depths), n)) if first else b["total"].copy()
            bins, x = b["codes" if raw else "bins"], b.get("x")
            for f in np.unique(b["fold"]):
                mine = np.flatnonzero(b["fold"] == f)
                held, x_held = np.ascontiguousarray(bins[:, mine]), np.ascontiguousarray(x[:, mine]) if raw else None
                for _, tree in (o for o in own if o[0] == f):
                    for i, depth in enumerate(depths):
                        total[i, mine] += tree["value"].take(leaves(tree, len(mine), held, places, x_held, wide, depth))
            yield as_block(n, {**{c: b[c] for c in names}, "total": total})

    rows = design.rows.select("n", *names, *([] if first else ["total"]))
    rows, _ = write_blocks(rows.mapInArrow(add, block_schema([*names, "total"])), "held-out")
    return Binned(rows, design.features, design.cuts, design.values)


def tree_cv(train: DataFrame, features: Sequence[str], label: str, configs: Sequence[Mapping], fold: str, key: str = "pos", bins: int = BINS) -> list[float]:
    """Mean R^2 over the folds of every config of the tree families."""
    design = bin_rows(train, features, F.col(label), key, F.col(fold), bins, any(c["model_name"] == "ExtraTrees" for c in configs))
    out = {}
    for families, search in ((FORESTS, forest_cv), (BOOSTED, boosted_cv)):
        own = [i for i, c in enumerate(configs) if c["model_name"] in families]
        if own:
            out.update(zip(own, search(design, [configs[i] for i in own])))
    return [out[i] for i in range(len(configs))]
