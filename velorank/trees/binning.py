"""Design rows for tree growth: every feature as a small bin number, written once in blocks of rows.

A feature with at most ``bins`` values is cut midway between neighbours, so its bins are its values; any
other is cut at approximate quantiles.  Bin ``b`` holds the values above cut ``b - 1`` and at or below cut
``b``.  Null and NaN features count as 0.

A row of the written table is a block of up to ``BLOCK`` design rows: each column holds the numbers of the
whole block, one feature after another, so a pass gets whole columns without taking rows apart.  Bins are
packed (``splits.Layout``).  For random thresholds, features whose bins are their values are written as bins
(``codes``), only the others as raw values (``x``).  Every pass reads only the columns it needs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from velorank.session import materialize, scratch_path
from velorank.trees import splits as S

QUANTILE_ACCURACY = 10_000
BLOCK = 1 << 15                    # rows of a block
BLOCKS_A_FILE = 8                  # so a reader holds few blocks at once
#: What a block's columns hold; ``bins`` and ``codes`` by packed column, ``x`` by wide feature, ``f`` and ``total`` by number.
TYPES = {"key": np.int64, "y": np.float64, "fold": np.int32, "bins": np.uint8, "codes": np.uint8, "x": np.float64, "f": np.float64, "total": np.float64}


@dataclass
class Binned:
    """A written design table and what its bins mean."""
    rows: DataFrame                # a row a block: n long, then binary columns (TYPES)
    features: list[str]
    cuts: list[np.ndarray]         # per feature, ascending; one bin more than cuts
    values: list = field(default_factory=list)   # per feature its values if its bins are its values, else None

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts])

    @property
    def mixed(self) -> S.Mixed:
        return S.Mixed(self.values)


def _value(c: str):
    return F.expr(_plain(c))


def _plain(c: str) -> str:
    """A feature as a number, null and NaN as 0."""
    quoted = "`" + c.replace("`", "``") + "`"
    return f"coalesce(nanvl(cast({quoted} as double), 0D), 0D)"


def find_cuts(df: DataFrame, features: Sequence[str], bins: int) -> tuple[list[np.ndarray], list]:
    """At most ``bins - 1`` cuts a feature, and its values if they are so few: one pass that ends a feature's list of values once it is too
    long, one pass of quantile sketches for the features whose list was."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = [np.empty(0)] * len(features)
        for batch in batches:
            for j in range(len(features)):
                if len(seen[j]) <= bins:
                    seen[j] = np.union1d(seen[j], batch.column(j).to_numpy(zero_copy_only=False))[:bins + 1]
        yield pa.RecordBatch.from_pydict({"j": np.repeat(np.arange(len(features)), [len(s) for s in seen]),
                                          "v": np.concatenate([*seen, np.empty(0)])}, pa.schema([("j", pa.int64()), ("v", pa.float64())]))

    flat = df.selectExpr(*[f"{_plain(c)} as f{j}" for j, c in enumerate(features)])
    distinct = materialize(flat.mapInArrow(values, "j long, v double").distinct(), "feature-values")
    # a feature that had too many values in one task has them here; bins + 1 smallest suffice to see it
    told = distinct.groupBy("j").agg(F.count(F.lit(1)).alias("n")).collect()
    many = sorted(r["j"] for r in told if r["n"] > bins)
    few = {r["j"]: np.sort(r["v"]) for r in distinct.where(~F.col("j").isin(many)).groupBy("j").agg(F.collect_list("v").alias("v")).collect()}
    # one expression a feature as text: the levels are not sent to the engine one by one
    levels = ", ".join(f"{(i + 1) / bins!r}D" for i in range(bins - 1))
    wide = flat.agg(*[F.expr(f"percentile_approx(f{j}, array({levels}), {QUANTILE_ACCURACY})").alias(f"q{j}") for j in many]).first() if many else {}
    out = []
    for j in range(len(features)):
        v = few.get(j, np.empty(0))
        out.append(np.unique(wide[f"q{j}"]) if j in many else (v[:-1] + v[1:]) / 2)
    return out, [None if j in many else few.get(j, np.empty(0)) for j in range(len(features))]


def whole_blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[list[np.ndarray]]:
    """The columns of ``most`` rows at a time."""
    held: list[pa.RecordBatch] = []
    n = 0
    joined = lambda: [np.concatenate([b.column(j).to_numpy(zero_copy_only=False) for b in held]) for j in range(held[0].num_columns)]
    for batch in batches:
        while n + len(batch) >= most:
            held.append(batch.slice(0, most - n))
            yield joined()
            batch, held, n = batch.slice(most - n), [], 0
        if len(batch):
            held.append(batch)
            n += len(batch)
    if held:
        yield joined()


def as_block(n: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One block as a row."""
    return pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *(pa.array([np.ascontiguousarray(v, TYPES[k]).tobytes()], pa.binary()) for k, v in columns.items())],
                                      names=["n", *columns])


def block_schema(names: Sequence[str]) -> str:
    return ", ".join(["n long", *(f"{c} binary" for c in names)])


def read_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """(rows, columns) of every block; columns of several features as [feature, row]."""
    S.keep_heap()
    for batch in batches:
        for i in range(len(batch)):
            n = batch.column(0)[i].as_py()
            block = {}
            for c, column in zip(batch.schema.names[1:], batch.columns[1:]):
                v = np.frombuffer(column[i].as_buffer(), TYPES[c])
                block[c] = v if c in ("key", "y", "fold") else v.reshape(-1, n)
            yield n, block


def write_blocks(rows: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Blocks as a table of small files."""
    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.write.option("maxRecordsPerFile", BLOCKS_A_FILE).parquet(path)
    return spark.read.schema(rows.schema).parquet(path), path


def bin_rows(df: DataFrame, features: Sequence[str], label, key: str, fold=None, bins: int = 255, raw: bool = True) -> Binned:
    """Write the design table.  ``label`` and ``fold`` are columns; without ``fold`` all rows are in fold 0.
    Without ``raw`` it serves no random thresholds."""
    if not 2 <= bins <= 256:
        raise ValueError("a bin number is one byte")
    features = list(features)
    d, spark = len(features), df.sparkSession
    flat = df.select(F.col(key).cast("long").alias("key"), label.cast("double").alias("y"),
                     (F.lit(0) if fold is None else fold).cast("int").alias("fold"), *[_value(c).alias(f"f{j}") for j, c in enumerate(features)])
    # dealt out once over all cores, and worked out once for the cuts and the bins
    flat = materialize(flat.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))), "features")
    cuts, values = find_cuts(flat, [f"f{j}" for j in range(d)], bins)
    layout, mixed = S.Layout(np.array([len(c) + 1 for c in cuts], np.int64)), S.Mixed(values)

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if any(batch.column(j).null_count for j in range(3)):
                raise ValueError("a training row without key, label or fold")
            yield batch

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        S.keep_heap()
        for key_, y, fold_, *x in whole_blocks(told(batches), BLOCK):
            b = np.array([np.searchsorted(cuts[j], x[j], "left") for j in range(d)], np.uint8).reshape(d, len(y))
            extra = {"codes": mixed.layout.pack(b[mixed.exact]), "x": np.array([x[j] for j in mixed.wide]).reshape(len(mixed.wide), len(y))} if raw else {}
            yield as_block(len(y), {"key": key_, "y": y, "fold": fold_, "bins": layout.pack(b), **extra})

    names = ["key", "y", "fold", "bins", *(["codes", "x"] if raw else [])]
    rows, _ = write_blocks(flat.mapInArrow(encode, block_schema(names)), "design")
    return Binned(rows, features, cuts, values)


def as_binary(m: np.ndarray) -> pa.Array:
    """One binary value per matrix row."""
    n, width = len(m), m.nbytes // max(len(m), 1)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * np.int32(width)), pa.py_buffer(m.tobytes())])


def as_matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    """The matrix of a column made by ``as_binary``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if n == 0 or width == 0:
        return np.empty((n, width), dtype)
    first = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
    return np.frombuffer(column.buffers()[2], np.uint8)[first:first + n * width * np.dtype(dtype).itemsize].view(dtype).reshape(n, width)
