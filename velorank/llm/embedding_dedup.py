"""Near-duplicate embeddings by an epsilon grid order join.

Unit vectors with cosine >= t are at most eps = sqrt(2 - 2t) apart.  Vectors are projected on their
leading principal axes, put in the order of their grid cells (side eps) and cut into blocks.  The
sequence is a tree of intervals; starting with the whole sequence against itself, pairs of intervals
are split and pairs whose bounding boxes are more than eps apart are dropped, down to pairs of
blocks, which are compared in full.  Boxes hold the projection and the norm of the rest, a lower
bound of the distance whatever the axes, so no link is lost.

Equal vectors (same label) are one node with a count; links of block pairs are counted, never
listed: every block pair gives one row per linked vector (its links there and a local root).

Only vectors with the same non-null label and the same length are compared.  A vector that is null,
empty, zero or holds a null or non-finite component, or has a null id, links with nothing: no
links, and it is its own component.  Equal ids with different vectors are separate nodes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from velorank.llm.components import connected
from velorank.session import materialize

THRESHOLD = 0.98
AXES = 6                            # grid dimensions
SAMPLE = 4096                       # vectors that fix the axes (a bounded sample; results don't depend on it)
BLOCK = 256                         # vectors in a block
FAN = 3                             # an interval has 2**FAN parts
SLACK = 1e-9
EDGE = 1e-12                        # cosines this near the threshold are summed again exactly


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _axes(sample: list[np.ndarray]) -> dict[int, np.ndarray]:
    """Principal axes by vector length."""
    out = {}
    for d in {len(v) for v in sample}:
        x = _unit(np.stack([v for v in sample if len(v) == d]))
        x = x - x.mean(0)
        values, axes = np.linalg.eigh(x.T @ x)
        out[d] = axes[:, ::-1][:, :AXES].copy()
    return out


def _project(unit: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """AXES coordinates (missing ones 0) and the norm of the rest."""
    d = unit.shape[1]
    basis = axes.get(d, np.eye(d)[:, :AXES])
    p = np.zeros((len(unit), AXES + 1))
    p[:, :basis.shape[1]] = unit @ basis
    p[:, AXES] = np.sqrt(np.maximum(0, 1 - (p * p).sum(1)))
    return p


def _linked(a: np.ndarray, b: np.ndarray, t: float) -> np.ndarray:
    import math
    s = a @ b.T
    mask = s >= t
    for i, j in zip(*np.nonzero(np.abs(s - t) < EDGE)):
        x, y = a[i].tolist(), b[j].tolist()
        dot = math.fsum(p * q for p, q in zip(x, y, strict=True))
        mask[i, j] = dot >= t * math.sqrt(math.fsum(p * p for p in x) * math.fsum(q * q for q in y))
    return mask


def _roots(mask: np.ndarray) -> np.ndarray:
    """Smallest index reachable over a symmetric link matrix."""
    root = np.arange(len(mask))
    while True:
        new = np.where(mask, root[None, :], len(mask)).min(1)
        new = np.minimum(root, new)
        if (new == root).all():
            return root
        root = new


def compare_pairs(batches, t: float, kind: str):
    """Rows (node, links, root) from rows of two blocks."""
    for b in batches:
        out = {"node": [], "links": [], "root": []}
        for k in range(b.num_rows):
            row = {c: b.column(c)[k] for c in b.schema.names}
            d = row["dim"].as_py()
            read = lambda c: _unit(np.frombuffer(row[c].as_buffer(), kind).reshape(-1, d))  # noqa: B023, E731
            ids = lambda c: row[c].values.to_numpy()  # noqa: B023, E731
            same = row["a"].as_py() == row["b"].as_py()
            x, nx, mx = read("data_a"), ids("node_a"), ids("copies_a")
            if same:
                mask = _linked(x, x, t)
                np.fill_diagonal(mask, False)
                links, nodes, whole = mask @ mx, nx, mask
            else:
                y, ny, my = read("data_b"), ids("node_b"), ids("copies_b")
                mask = _linked(x, y, t)
                if not mask.any():
                    continue
                links, nodes = np.concatenate([mask @ my, mask.T @ mx]), np.concatenate([nx, ny])
                n = len(nx)
                whole = np.zeros((len(nodes), len(nodes)), bool)
                whole[:n, n:], whole[n:, :n] = mask, mask.T
            some = links > 0
            if some.any():
                root = nodes[_roots(whole)]
                out["node"].append(nodes[some])
                out["links"].append(links[some])
                out["root"].append(root[some])
        if out["node"]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out[c]).astype(np.int64)) for c in out], list(out))


def _blocks(reps: DataFrame, axes: dict[int, np.ndarray], eps: float, parts: int) -> DataFrame:
    """Blocks of the vectors in grid order: part, seq, label, dim, bounding box, ids, copies and vectors."""
    spark = reps.sparkSession
    shared = spark.sparkContext.broadcast(axes)
    cells = [f"c{i}" for i in range(AXES)]
    stored = number_kind(reps)

    def place(batches):
        for b in batches:
            vec = b.column("vec")
            lens = np.diff(vec.offsets.to_numpy())
            flat = vec.values.to_numpy(zero_copy_only=False)[vec.offsets[0].as_py():]
            starts = np.concatenate([[0], np.cumsum(lens)])
            cell = np.zeros((b.num_rows, AXES), np.int32)
            for d in np.unique(lens):
                at = np.flatnonzero(lens == d)
                x = flat[starts[at][:, None] + np.arange(d)]
                cell[at] = np.floor(_project(_unit(x), shared.value)[:, :AXES] / eps)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lens.astype(np.int32)), *[pa.array(cell[:, i]) for i in range(AXES)]],
                [*b.schema.names, "dim", *cells])

    def cut(batches):
        for b in batches:
            label, dim = b.column("label").to_pylist(), b.column("dim").to_numpy()
            out, i = [], 0
            while i < b.num_rows:
                j = i + 1
                while j < b.num_rows and j - i < BLOCK and label[j] == label[i] and dim[j] == dim[i]:
                    j += 1
                x = np.stack(b.column("vec").slice(i, j - i).to_numpy(zero_copy_only=False)).astype(stored)
                p = _project(_unit(x), shared.value)
                out.append({"label": label[i], "dim": int(dim[i]), "node": b.column("node").slice(i, j - i).to_pylist(),
                            "copies": b.column("copies").slice(i, j - i).to_pylist(), "data": x.tobytes(),
                            **{f"lo{k}": float(p[:, k].min()) for k in range(AXES + 1)}, **{f"hi{k}": float(p[:, k].max()) for k in range(AXES + 1)}})
                i = j
            yield pa.RecordBatch.from_pylist(out, schema)

    box = [f"{s}{k}" for s in ("lo", "hi") for k in range(AXES + 1)]
    schema = pa.schema([("label", b_type(reps)), ("dim", pa.int32()), ("node", pa.list_(pa.int64())), ("copies", pa.list_(pa.int64())),
                        ("data", pa.binary()), *[(c, pa.float64()) for c in box]])
    label = reps.schema["label"].dataType.simpleString()
    order = ["label", "dim", *cells, "node"]
    kind = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in reps.schema.fields] + ["dim int"] + [f"{c} int" for c in cells])
    placed = reps.mapInArrow(place, kind).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    cut_kind = f"label {label}, dim int, node array<long>, copies array<long>, data binary, " + ", ".join(f"{c} double" for c in box)
    return placed.mapInArrow(cut, cut_kind).withColumn("_id", F.monotonically_increasing_id()).withColumns(
        {"part": F.shiftright("_id", 33).cast("long"), "seq": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id")


def number_kind(reps: DataFrame) -> str:
    """Blocks keep the components' own width."""
    return "f4" if reps.schema["vec"].dataType.elementType.typeName() == "float" else "f8"


def b_type(reps: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(reps.schema["label"].dataType)


def _interval_pairs(boxes: DataFrame, depth: int, eps: float) -> DataFrame:
    """(label, dim, a, b) of blocks a <= b that may hold a link, by splitting pairs of intervals."""
    sides = range(AXES + 1)

    def level(k: int) -> DataFrame:
        return boxes.groupBy("label", "dim", F.shiftright("gid", FAN * k).alias("id")).agg(
            *[F.min(f"lo{i}").alias(f"lo{i}") for i in sides], *[F.max(f"hi{i}").alias(f"hi{i}") for i in sides])

    pairs = level(depth).select("label", "dim", F.col("id").alias("a"), F.col("id").alias("b"))
    for k in range(depth - 1, -1, -1):
        parts = level(k) if k else boxes.withColumnRenamed("gid", "id")
        parts = parts.withColumn("up", F.shiftright("id", FAN))
        one = parts.select("label", "dim", F.col("up").alias("a"), F.col("id").alias("a1"), *[F.col(f"{s}{i}").alias(f"a{s}{i}") for s in ("lo", "hi") for i in sides])
        two = parts.select("label", "dim", F.col("up").alias("b"), F.col("id").alias("b1"), *[F.col(f"{s}{i}").alias(f"b{s}{i}") for s in ("lo", "hi") for i in sides])
        gap = sum((F.pow(F.greatest(F.lit(0.0), F.col(f"alo{i}") - F.col(f"bhi{i}"), F.col(f"blo{i}") - F.col(f"ahi{i}")), F.lit(2.0)) for i in sides), F.lit(0.0))
        pairs = pairs.join(one, ["label", "dim", "a"]).join(two, ["label", "dim", "b"]) \
            .where((F.col("a1") <= F.col("b1")) & (gap <= eps * eps + SLACK)) \
            .select("label", "dim", F.col("a1").alias("a"), F.col("b1").alias("b"))
    return pairs


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vec: str = "embedding", label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    eps = float(np.sqrt(2 - 2 * threshold))
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vec)
    valid = F.coalesce(F.col(vec_id).isNotNull() & F.col(label).isNotNull() & v.isNotNull() & F.forall(v, real) & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(vec_id).alias("vec_id"), F.when(valid, F.col(label)).alias("label"), F.when(valid, v).alias("vec"))
    reps = materialize(rows.where(F.col("vec").isNotNull()).groupBy("label", "vec").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id()), "vectors")
    n = reps.count()
    sample = reps.orderBy(F.xxhash64("node")).limit(SAMPLE).select("vec").toArrow().column("vec").to_pylist() if n else []
    axes = _axes([np.array(x) for x in sample])
    blocks = materialize(_blocks(reps.select("node", "copies", "label", "vec"), axes, eps, max(1, -(-n // (8 * BLOCK)))), "vector-blocks")
    top = blocks.agg(F.max("part").alias("p"), F.max("seq").alias("s")).first()
    width = (top["s"] or 0) + 1
    depth = 1
    while (((top["p"] or 0) + 1) * width - 1) >> (FAN * depth):
        depth += 1
    blocks = blocks.withColumn("gid", F.col("part") * width + F.col("seq"))
    boxes = blocks.select("label", "dim", "gid", *[f"{s}{k}" for s in ("lo", "hi") for k in range(AXES + 1)])
    pairs = materialize(_interval_pairs(boxes, depth, eps), "block-pairs")
    kind = number_kind(reps)
    side = lambda k: blocks.select(F.col("gid").alias(k), *[F.col(c).alias(f"{c}_{k}") for c in ("node", "copies", "data")])
    told = pairs.select("dim", "a", "b").join(side("a"), "a").join(side("b"), "b") \
        .mapInArrow(lambda it: compare_pairs(it, threshold, kind), "node long, links long, root long")
    told = materialize(told, "vector-links")
    links = told.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected(told.select("node", "root"), "node", "root")
    named = reps.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    result = named.select("node", "label", "vec", "copies", "component").join(smallest, "component").join(links, "node", "left") \
        .select(F.col("label").alias("_label"), F.col("vec").alias("_vec"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    result = materialize(result, "vector-results")
    return rows.join(result, (F.col("vec") == F.col("_vec")) & (F.col("label") == F.col("_label")), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
