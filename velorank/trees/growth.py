"""Growing many trees at once: every pass over the design rows serves all nodes that still lack a split.

A tree grows in waves.  A wave expands leaves whose best split is known, and one pass counts the
children's histograms for all trees, configs and folds together: as many tasks as cores add up arrays of
(rows, sum) per (tree, node), the arrays are summed, and the driver gets one array per node, whose size
depends on the features and bins, not on the rows.  Only the smaller child is counted; the other is parent less
child.  Leaves are taken best gain first up to ``max_leaves``: a wave expands every leaf that can
still be reached (the highest gains, as many as there are splits left), so the result is the one-by-one
order's with about as many passes as the tree is deep.

Random thresholds: a pass for the nodes' least and largest values, one for the sums below the seeded
thresholds; features of few values have both from one histogram of their values.

Nodes with few rows (``local_rows``) are not counted in passes: their rows are dealt out by (tree, node) and
each task grows whole subtrees.  So deep trees take as many passes as their top, and their nodes are a
written table, never a driver's list.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from velorank.session import materialize
from velorank.trees import splits as S
from velorank.trees.binning import Binned, as_binary, as_matrix, read_blocks

GROUPS = 64                        # groups of the first sum when there are many partial arrays
MANY_PARTS = 256
PASS_BYTES = 96 << 20              # arrays of one pass in a task
DRIVER_BYTES = 128 << 20           # partial arrays of all tasks that the driver may add up itself
NODE_SCHEMA = "tree int, node long, feature int, cut double, left long, right long, n double, s double, key long, depth int, gain double"
SUB = 1 << 24                      # nodes of the subtree under top node i are numbered from (i + 1) * SUB


@dataclass
class Tree:
    """One tree while it grows.  Arrays are indexed by node; a leaf has feature -1."""
    rules: S.Rules
    fold: int = -1                 # rows of this fold are left out
    sample: int = -1               # bootstrap stream; -1: every row once
    random: int = -1               # stream of the random thresholds; -1: best cuts
    state: int = -1                # column of the boosted state whose residuals are fitted; -1: the label
    base: float = 0.0              # constant taken off the label
    feature: list = field(default_factory=lambda: [-1])
    cut: list = field(default_factory=lambda: [0.0])
    left: list = field(default_factory=lambda: [-1])
    right: list = field(default_factory=lambda: [-1])
    n: list = field(default_factory=lambda: [None])
    s: list = field(default_factory=lambda: [None])
    key: list = field(default_factory=lambda: [1])
    depth: list = field(default_factory=lambda: [0])
    split: list = field(default_factory=lambda: [None])      # best split once known
    array: dict = field(default_factory=dict)                # histograms of the nodes that may still have children

    def may_split(self, i: int) -> bool:
        return self.n[i] >= 2 * max(self.rules.min_leaf, 1) and (self.rules.max_depth is None or self.depth[i] < self.rules.max_depth)

    def expand(self, i: int) -> tuple[int, int]:
        b = self.split[i]
        both = ((b["n_left"], b["s_left"]), (self.n[i] - b["n_left"], self.s[i] - b["s_left"]))
        for side, (n, s) in enumerate(both):
            for name, v in (("feature", -1), ("cut", 0.0), ("left", -1), ("right", -1), ("n", n), ("s", s),
                            ("key", S.child_key(self.key[i], side)), ("depth", self.depth[i] + 1), ("split", None)):
                getattr(self, name).append(v)
        self.feature[i], self.cut[i] = int(b["feature"]), float(b["cut"])
        self.left[i], self.right[i] = len(self.n) - 2, len(self.n) - 1
        return self.left[i], self.right[i]

    def walk(self) -> tuple[list[int], list[int]]:
        """(nodes split in best-first order up to the first whose children are not expanded, leaves to expand next)."""
        left = (self.rules.max_leaves or 1 << 60) - 1
        queue = [(-self.split[0]["gain"], 0)] if self.split[0] else []
        taken = []
        while queue and left > 0 and queue[0][0] < 0:
            i = queue[0][1]
            if self.left[i] < 0:
                break
            heapq.heappop(queue)
            taken.append(i)
            left -= 1
            for c in (self.left[i], self.right[i]):
                if self.split[c]:
                    heapq.heappush(queue, (-self.split[c]["gain"], c))
        # leaves by the least gain on their way from the queue: those far down can't be split before the others
        found, todo = [], [(g, i) for g, i in queue if g < 0] if left > 0 else []
        while todo:
            g, i = todo.pop()
            if self.left[i] < 0:
                found.append((g, i))
            else:
                todo += [(max(g, -self.split[c]["gain"]), c) for c in (self.left[i], self.right[i]) if self.split[c] and self.split[c]["gain"] > 0]
        return taken, [i for _, i in sorted(found)[:left]]

    def chosen(self) -> dict[str, np.ndarray]:
        """The tree of the splits taken, as arrays; nodes keep their numbers, those not taken are leaves."""
        taken = set(self.walk()[0])
        out = {k: np.array(getattr(self, k)) for k in ("cut", "n", "s", "key", "depth", "left", "right")}
        out["feature"] = np.array([f if i in taken else -1 for i, f in enumerate(self.feature)])
        out["gain"] = np.array([self.split[i]["gain"] if i in taken else 0.0 for i in range(len(self.n))])
        return out


def route(arrays: dict[str, np.ndarray], values: np.ndarray, max_depth: int | None = None) -> np.ndarray:
    """The leaf of every row; with ``max_depth``, the node that deep."""
    at = np.zeros(len(values), np.int64)
    feature, cut, left, right = (np.asarray(arrays[k]) for k in ("feature", "cut", "left", "right"))
    rows = np.arange(len(values))
    step = 0
    while len(rows) and (max_depth is None or step < max_depth):
        f = feature[at[rows]]
        rows, f = rows[f >= 0], f[f >= 0]
        if not len(rows):
            break
        i = at[rows]
        at[rows] = np.where(values[rows, f] <= cut[i], left[i], right[i])
        step += 1
    return at


@dataclass
class State:
    """Boosted predictions: a written column of arrays, and the trees grown since."""
    width: int                     # rows of ``f``; 0: none
    pending: list                  # per row of ``f``, trees as arrays with ``value``

    def read(self, n: int, block: dict, layout: S.Layout) -> np.ndarray:
        """[model, row] of a block."""
        f = block["f"].copy()
        places = layout.places
        for k, trees in enumerate(self.pending):
            for t in trees:
                f[k] += t["value"].take(S.leaves(t, n, block["bins"], places))
        return f


NO_STATE = State(0, [])


def _columns(design: Binned, state: State, trees: Sequence[Tree], raw: bool) -> DataFrame:
    """The blocks' columns that the trees need, in as many parts as there are cores."""
    names = ["n", "y", *(["key"] if any(t.sample >= 0 for t in trees) else []), *(["fold"] if any(t.fold != -1 for t in trees) else []),
             *(["codes", "x"] if raw else []), *(["bins"] if not raw or state.width else []), *(["f"] if state.width else [])]
    return design.rows.select(*names).coalesce(design.rows.sparkSession.sparkContext.defaultParallelism)


def _own_rows(tree: Tree, rows: np.ndarray | None, block: dict, f):
    """(row numbers, weights, targets) of the rows (None: all) that a tree learns from."""
    y = block["y"]
    if tree.fold != -1:
        own = block["fold"] != tree.fold
        rows = np.flatnonzero(own) if rows is None else rows[own[rows]]
    if tree.sample >= 0:
        w = S.copies(tree.sample, block["key"] if rows is None else block["key"][rows])
        hit = np.flatnonzero(w > 0)
        rows, w = hit if rows is None else rows[hit], w[hit].astype(np.float64)
    else:
        w = np.ones(len(y) if rows is None else len(rows))
    g = y if rows is None else y[rows]
    if tree.state < 0:
        return rows, w, g - tree.base
    return rows, w, g - (f[tree.state] if rows is None else f[tree.state][rows])


def _light(tree: Tree, design: Binned) -> Tree:
    """What tasks need of a tree; cuts of features written as bins are bins."""
    feature = np.array(tree.feature)
    cut = design.mixed.code_cuts(feature, np.array(tree.cut)) if tree.random >= 0 else np.array(tree.cut)
    return Tree(tree.rules, tree.fold, tree.sample, tree.random, tree.state, tree.base, feature, cut, np.array(tree.left), np.array(tree.right),
                [], [], list(tree.key), list(tree.depth), [], {})


def _at(tree: Tree, n: int, block: dict, layout: S.Layout, mixed: tuple | None) -> np.ndarray:
    """The leaf of every row of a block; ``mixed``: places and raw rows of the features of random thresholds."""
    if mixed:
        return S.leaves(vars(tree), n, block["codes"], mixed[0], block["x"], mixed[1])
    return S.leaves(vars(tree), n, block["bins"], layout.places)


def node_arrays(design: Binned, state: State, wanted: list[tuple[Tree, list[int]]], kind: str, layout: S.Layout,
                cuts: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """One pass: per tree an array [node, ...] over its ``wanted`` nodes.  ``kind``: ``hist`` [bin, 2],
    ``total`` [2], ``spread`` (``splits.spreads``), ``below`` [2, raw feature] at the given cuts."""
    raw, mixed = kind in ("spread", "below"), design.mixed
    shape = {"hist": (layout.width, 2), "total": (2,), "spread": (mixed.size,), "below": (2, len(mixed.wide))}[kind]
    added = 2 * mixed.layout.width if kind == "spread" else None      # of a spread, sums come first; the least of the rest counts
    size = 8 * int(np.prod(shape))
    out: list[np.ndarray] = [np.zeros((len(ids), *shape)) for _, ids in wanted]
    todo = [(t, i) for t, (_, ids) in enumerate(wanted) for i in range(len(ids))]
    room = max(1, PASS_BYTES // max(size, 1))
    look = S.mixed_places(mixed) if raw else None
    for a in range(0, len(todo), room):
        piece: dict[int, list[int]] = {}
        for t, i in todo[a:a + room]:
            piece.setdefault(t, []).append(i)
        jobs = [(t, _light(wanted[t][0], design), np.array([wanted[t][1][i] for i in own]), own, cuts[t][own] if cuts else None) for t, own in piece.items()]

        def count(batches, jobs=jobs):
            acc = {}
            for n, block in read_blocks(batches):
                f = state.read(n, block, layout) if state.width else None
                for t, tree, ids, own, cut in jobs:
                    slot = rows = None
                    if kind != "total" and len(tree.feature) > 1:
                        place = np.full(len(tree.feature), -1)
                        place[ids] = np.arange(len(ids))
                        slot = place.take(_at(tree, n, block, layout, look))
                        rows = np.flatnonzero(slot >= 0)
                    rows, w, g = _own_rows(tree, rows, block, f)
                    slot = np.zeros(len(w), np.int64) if slot is None else slot[rows]
                    if t not in acc:
                        acc[t] = np.zeros((len(own), *shape))
                        if kind == "spread":
                            acc[t][:, added:] = np.inf
                    if kind == "hist":
                        S.histograms(block["bins"], slot, w, g, len(ids), layout, rows, acc[t])
                    elif kind == "total":
                        acc[t] += [[w.sum(), (w * g).sum()]]
                    elif kind == "spread":
                        h, ends = S.spreads(block["codes"], block["x"], rows, slot, w, g, len(ids), mixed)
                        acc[t][:, :added] += h
                        np.minimum(acc[t][:, added:], ends, out=acc[t][:, added:])
                    else:
                        acc[t] += S.sums_below(block["x"], rows, slot, w, g, cut[:, mixed.wide])
            part = TaskContext.get().partitionId() % GROUPS
            for t, _, _, own, _ in jobs:
                if t in acc:
                    m = acc.pop(t).reshape(len(own), -1)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), t), pa.int32()), pa.array(own, pa.int32()),
                                                      pa.array(np.full(len(own), part), pa.int32()), as_binary(m)], names=["t", "i", "part", "a"])

        def together(m: np.ndarray) -> np.ndarray:
            return m.sum(axis=0) if added is None else np.concatenate([m[:, :added].sum(axis=0), m[:, added:].min(axis=0)])

        def grouped(table: pa.Table) -> pa.Table:
            m = as_matrix(table.column("a").combine_chunks(), size // 8, np.float64)
            return pa.table([*[table.column(k).slice(0, 1).combine_chunks() for k in ("t", "i", "part")], as_binary(together(m)[None])], names=["t", "i", "part", "a"])

        def whole(table: pa.Table) -> pa.Table:
            return grouped(table).drop_columns(["part"])

        rows = _columns(design, state, [wanted[t][0] for t in piece], raw)
        parts, tasks = rows.mapInArrow(count, "t int, i int, part int, a binary"), rows.sparkSession.sparkContext.defaultParallelism
        # the partial arrays are summed by node, those of many tasks in groups first; few small ones on the driver
        if tasks > MANY_PARTS:
            parts = parts.groupBy("t", "i", "part").applyInArrow(grouped, "t int, i int, part int, a binary")
        if tasks * min(room, len(todo) - a) * size > DRIVER_BYTES:
            parts = parts.groupBy("t", "i").applyInArrow(whole, "t int, i int, a binary")
        seen = set()
        for batch in parts.toArrow().to_batches():
            for t, i, m in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), as_matrix(batch.column(batch.num_columns - 1), size // 8, np.float64)):
                out[t][i] = (m if (t, i) not in seen else together(np.stack([out[t][i].reshape(-1), m]))).reshape(shape)
                seen.add((t, i))
    return out


def _told(tree: Tree, i: int, found: dict, k: int) -> None:
    good = bool(S.worth(found["gain"][k], tree.n[i], tree.s[i]))
    tree.split[i] = {name: v[k] for name, v in found.items()} if good else {"gain": 0.0}


def grow(design: Binned, trees: Sequence[Tree], state: State = NO_STATE, local_rows: int = 0) -> dict[int, list[int]]:
    """Grow all trees.  Nodes of at most ``local_rows`` rows stay leaves; their numbers are returned per tree."""
    layout = S.Layout(design.sizes)
    local: dict[int, list[int]] = {}
    number = {id(t): k for k, t in enumerate(trees)}
    best = [t for t in trees if t.random < 0]
    for t, h in zip(best, node_arrays(design, state, [(t, [0]) for t in best], "hist", layout) if best and layout.width else []):
        t.n[0], t.s[0] = h[0, :design.sizes[0]].sum(axis=0)
        t.array[0] = h[0]
    rest = [t for t in trees if t.n[0] is None]
    for t, m in zip(rest, node_arrays(design, state, [(t, [0]) for t in rest], "total", layout) if rest else []):
        t.n[0], t.s[0] = m[0]

    def judge(tree: Tree, ids: list[int]) -> list[int]:
        """Settle what needs no pass; what is left needs a random split's two passes or has its histogram."""
        out = []
        for i in ids:
            if not tree.may_split(i) or not layout.width:
                tree.split[i] = {"gain": 0.0}
            elif tree.n[i] <= local_rows:
                tree.split[i] = {"gain": 0.0}
                local.setdefault(number[id(tree)], []).append(i)
            else:
                out.append(i)
        return out

    open_: list[tuple[Tree, list[int]]] = [(t, judge(t, [0])) for t in trees]
    while True:
        by_hist = [(t, [i for i in ids if i in t.array]) for t, ids in open_ if t.random < 0 and ids]
        for t, ids in by_hist:
            for a in range(0, len(ids), 64):
                own = ids[a:a + 64]
                found = S.best_splits(np.stack([t.array[i] for i in own]), layout, t.rules.min_leaf)
                for k, i in enumerate(own):
                    _told(t, i, found, k)
        drawn = [(t, ids) for t, ids in open_ if t.random >= 0 and ids]
        if drawn:
            mixed = design.mixed
            spans = [mixed.split_up(m) for m in node_arrays(design, state, drawn, "spread", layout)]
            cuts = [S.thresholds(t.random, np.array([t.key[i] for i in ids], np.int64), low, high) for (t, ids), (_, low, high) in zip(drawn, spans)]
            below = node_arrays(design, state, drawn, "below", layout, cuts) if len(mixed.wide) else [np.zeros((len(ids), 2, 0)) for _, ids in drawn]
            for (t, ids), (h, low, high), c, b in zip(drawn, spans, cuts, below):
                total = np.array([[t.n[i], t.s[i]] for i in ids])
                found = S.random_splits(*mixed.left_of(h, c, b), c, total, t.rules.min_leaf, low < high)
                for k, i in enumerate(ids):
                    _told(t, i, found, k)
        # expand every leaf the best-first order can still reach, and count the children
        families = []
        for t in trees:
            families += [(t, i, *t.expand(i)) for i in t.walk()[1]]
        if not families:
            break
        waiting: dict[int, tuple[Tree, list[int]]] = {}
        small: dict[int, tuple[Tree, list[int], list[tuple[int, int]]]] = {}
        for t, p, a, b in families:
            need = judge(t, [a, b])
            if need:
                waiting.setdefault(id(t), (t, []))[1].extend(need)
                if t.random < 0:
                    few, many = (a, b) if t.n[a] <= t.n[b] else (b, a)
                    entry = small.setdefault(id(t), (t, [], []))
                    entry[1].append(few)
                    entry[2].append((p, many))
        if small:
            lists = list(small.values())
            for (t, ids, kin), h in zip(lists, node_arrays(design, state, [(t, ids) for t, ids, _ in lists], "hist", layout)):
                for k, i in enumerate(ids):
                    p, other = kin[k]
                    t.array[i], t.array[other] = h[k], t.array[p] - h[k]
        for t, p, a, b in families:
            t.array.pop(p, None)
            for c in (a, b):
                if t.split[c]:
                    t.array.pop(c, None)
        open_ = list(waiting.values())
    for t in trees:
        t.array.clear()
    return local


def _pieces(m: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value per range of rows."""
    size = m.nbytes // max(len(m), 1)
    offsets = np.append(starts, ends[-1:]).astype(np.int32) * np.int32(size) if len(ends) else np.zeros(1, np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(m).tobytes())])


def _joined(column: pa.ChunkedArray, dtype) -> np.ndarray:
    """The rows of all ranges, one after another."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype)


def subtrees(design: Binned, trees: Sequence[Tree], local: dict[int, list[int]]) -> DataFrame | None:
    """Node rows of the subtrees under the ``local`` nodes: their rows are dealt out by (tree, node), a task grows each whole."""
    if not local:
        return None
    raw = trees[0].random >= 0
    layout, mixed = S.Layout(design.sizes), design.mixed
    width, many = len(mixed.layout.packed if raw else layout.packed), len(mixed.wide) if raw else 0
    look = S.mixed_places(mixed) if raw else None
    jobs = [(k, _light(trees[k], design), np.array(ids)) for k, ids in sorted(local.items())]

    def deal(batches):
        for n, block in read_blocks(batches):
            packed = np.ascontiguousarray(block["codes" if raw else "bins"].T)
            x = np.ascontiguousarray(block["x"].T) if raw else np.empty((n, 0))
            for k, tree, ids in jobs:
                place = np.full(len(tree.feature), -1)
                place[ids] = ids
                node = place.take(_at(tree, n, block, layout, look))
                rows, w, g = _own_rows(tree, np.flatnonzero(node >= 0), block, None)
                # the rows of a block for one node travel as one record
                order = np.argsort(node[rows], kind="stable")
                rows, w, g = rows[order], w[order], g[order]
                node = node[rows]
                ends = np.append(np.flatnonzero(np.diff(node)) + 1, len(node)) if len(node) else np.empty(0, np.int64)
                starts = np.append(0, ends[:-1]) if len(ends) else ends
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(starts), k), pa.int32()), pa.array(node[starts], pa.int64()),
                                                  *(_pieces(m, starts, ends) for m in (w.astype(np.uint8), g, packed[rows], x[rows]))],
                                                 names=["tree", "node", "w", "g", "v", "x"])

    shape = {k: (t.rules, t.random, t.depth, t.key) for k, t, _ in jobs}

    def whole(table: pa.Table) -> pa.Table:
        S.keep_heap()
        k, top = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        rules, stream, depth, key = shape[k]
        # the order of the rows in sums must not depend on how they arrive
        w, g = _joined(table.column("w"), np.uint8).astype(np.float64), _joined(table.column("g"), np.float64)
        order = np.lexsort((w, g))
        v = np.ascontiguousarray(_joined(table.column("v"), np.uint8).reshape(len(g), width)[order].T)
        x = np.ascontiguousarray(_joined(table.column("x"), np.float64).reshape(len(g), many)[order].T) if raw else None
        t = S.small_tree(None, g[order], w[order], rules, depth[top], key[top], None if raw else layout, stream, v, x, mixed if raw else None)
        n = len(t["n"])
        number = lambda x: np.where(x < 0, -1, x + (top + 1) * SUB)
        return pa.table([pa.array(np.full(n, k), pa.int32()), pa.array(np.arange(n) + (top + 1) * SUB), pa.array(t["feature"], pa.int32()),
                         pa.array(t["cut"]), pa.array(number(t["left"])), pa.array(number(t["right"])), pa.array(t["n"]), pa.array(t["s"]),
                         pa.array(t["key"]), pa.array(t["depth"], pa.int32()), pa.array(t["gain"])],
                        names=["tree", "node", "feature", "cut", "left", "right", "n", "s", "key", "depth", "gain"])

    dealt = _columns(design, NO_STATE, trees, raw).mapInArrow(deal, "tree int, node long, w binary, g binary, v binary, x binary")
    return dealt.groupBy("tree", "node").applyInArrow(whole, NODE_SCHEMA)


def node_table(design: Binned, trees: Sequence[Tree], local: dict[int, list[int]], first: int = 0) -> DataFrame:
    """All nodes of grown trees as a written table (``NODE_SCHEMA``); a top leaf with a subtree points to its root."""
    spark = design.rows.sparkSession
    frames = []
    for k, t in enumerate(trees):
        a = t.chosen()
        f = pd.DataFrame({"tree": k, "node": np.arange(len(a["n"])), **{c: a[c] for c in ("feature", "cut", "left", "right", "n", "s", "key", "depth", "gain")}})
        f.loc[f["feature"] < 0, ["left", "right"]] = -1
        for i in local.get(k, []):     # its subtree's root replaces it
            f.loc[i, ["left", "right"]] = (i + 1) * SUB
        frames.append(f)
    top = spark.createDataFrame(pd.concat(frames)[["tree", "node", "feature", "cut", "left", "right", "n", "s", "key", "depth", "gain"]], NODE_SCHEMA)
    deep = subtrees(design, trees, local)
    nodes = top if deep is None else top.unionByName(deep)
    return materialize(nodes.withColumn("tree", F.col("tree") + first), "tree-nodes")


def pack_nodes(rows: pd.DataFrame) -> list[dict[str, np.ndarray]]:
    """Trees as arrays for ``route``, numbered densely from the root; links to subtree roots are followed."""
    out = []
    for _, f in rows.groupby("tree", sort=True):
        f = f.sort_values("node")
        ids = f["node"].to_numpy()
        a = {k: f[k].to_numpy().copy() for k in ("feature", "cut", "left", "right", "n", "s")}
        # a top leaf that points to a subtree takes the subtree root's place
        link = np.flatnonzero((a["feature"] < 0) & (a["left"] >= 0))
        if len(link):
            root = np.searchsorted(ids, a["left"][link])
            for k in a:
                a[k][link] = a[k][root]
        for k in ("left", "right"):
            a[k] = np.where(a[k] >= 0, np.searchsorted(ids, a[k]), -1)
        out.append(a)
    return out
