"""MinHash near-duplicates by a chosen-path set similarity join.

A document's set is its distinct word shingles (64-bit codes); its sketch is one byte of each of
64 minwise hashes.  Documents with equal sets are one node.  Each of ``TREES`` independent trees
starts with all nodes and branches: a tree node chooses one or two sketch positions from its own
path, and a document goes to the child named by its bytes there.  Tree nodes with at most ``SMALL``
documents are compared exhaustively by sketch.  In a larger one every document is compared with up to
``PIVOTS`` of them; if these connect all its documents the node is done.  If they connect all but at
most ``SMALL`` loose ones, these are compared with the whole node and it is done too; else it branches.  Nodes
that are still large and mixed after ``DEEPEST`` levels are compared in blocks of documents, all
blocks with all.

Sketches that agree give candidate clusters (connected components); within each, links are confirmed
on the full sets, most alike pairs first, skipping pairs that are already connected.  Large clusters
are first linked to a pivot; only what that leaves open is compared in blocks.

Only connections are kept, never all pairs of a group.  Texts without words have the empty set and
link with nothing.  Null ids take part but name no component unless nothing else does.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from velorank.llm import textcodes as X
from velorank.llm.components import connected
from velorank.operators.sizing import broadcast_bounded
from velorank.session import materialize, remove_path

SHINGLE = 5                        # words, unless the caller says otherwise
NUM, DEN = 80, 100                 # link when DEN * |both| >= NUM * |either|
POSITIONS = 64                     # bytes of a sketch
AGREE = 38                         # of 64 positions make a candidate: 4 standard deviations under a similarity of 0.8
TREES = 12                         # of pairs at 0.8, 99.9 % share a tree node four levels down, 99.0 % eight down; more above 0.8
SECOND = 0.25                      # chance of a second chosen position: 1.25 = 1 / 0.8 children on average
SMALL = 1024
PIVOTS = 8                         # of a larger tree node
DEEPEST = 8                        # levels; recall sinks with each, so what is still large and mixed there is compared whole
BLOCK_DOCS, BLOCK_BYTES = 500, 16 << 20
BROADCAST_IDS = 200_000            # at most about 100 bytes each: 20 MB
BROADCAST_PATHS = 1_000_000        # 8 MB of names of large tree nodes
_RNG = np.random.default_rng(7)
_MUL = _RNG.integers(0, 1 << 32, POSITIONS, dtype=np.uint32) | np.uint32(1)
_ADD = _RNG.integers(0, 1 << 32, POSITIONS, dtype=np.uint32)


def shingles(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the ``size``-word shingles of each text and where they start; a shorter text's words are one shingle."""
    words, at = X.word_codes(data, offsets)
    n = np.diff(at)
    counts = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    starts = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(starts[-1], np.uint64)
    step = np.uint64(0x9E3779B97F4A7C15)
    if len(words) >= size:
        codes = words[:len(words) - size + 1].copy()
        for k in range(1, size):
            codes = X.mix(codes * step + words[k:len(words) - size + 1 + k])
        doc = np.repeat(np.arange(len(n)), n)
        whole = np.flatnonzero(doc[:len(codes)] == doc[size - 1:])
        out[starts[doc[whole]] + whole - at[doc[whole]]] = codes[whole]
    for d in np.flatnonzero((n > 0) & (n < size)).tolist():
        code = words[at[d]:at[d] + 1]
        for w in words[at[d] + 1:at[d + 1]]:
            code = X.mix(code * step + w)
        out[starts[d]] = X.mix(code ^ np.uint64(n[d]))[0]
    return out, starts


def sketches(codes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One byte of every minwise hash per text; texts without shingles have zeros."""
    n = len(at) - 1
    out = np.zeros((n, POSITIONS), np.uint8)
    full = np.flatnonzero(np.diff(at) > 0)
    if len(full):
        x = (codes >> np.uint64(32)).astype(np.uint32)
        starts = at[full]
        for k in range(POSITIONS):
            low = np.minimum.reduceat(x * _MUL[k] + _ADD[k], starts)
            low = (low ^ (low >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out[full, k] = (low >> np.uint32(24)).astype(np.uint8)
    return out


def _fixed(sketch: np.ndarray) -> pa.Array:
    at = np.arange(len(sketch) + 1, dtype=np.int32) * np.int32(POSITIONS)
    return pa.Array.from_buffers(pa.binary(), len(sketch), [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(sketch).tobytes())])


def _matrix(column: pa.Array) -> np.ndarray:
    data, _ = X.text_buffer(column)
    return data.reshape(-1, POSITIONS)


def describe(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2 (a set's signature) and sketch per document."""

    def run(batches):
        for b in batches:
            for i, j, data, offsets in X.chunks(b.column("text")):
                codes, at = shingles(data, offsets, size)
                found, k1, k2 = (np.zeros(j - i, np.uint64) for _ in range(3))
                for d in range(j - i):
                    own = np.unique(codes[at[d]:at[d + 1]])
                    found[d], k1[d], k2[d] = len(own), own.sum(), np.bitwise_xor.reduce(X.mix(own), initial=np.uint64(0))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(i, j - i), *[pa.array(x.view(np.int64)) for x in (found, k1, k2)], _fixed(sketches(codes, at))],
                    ["doc_id", "n_shingles", "k1", "k2", "sketch"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_shingles long, k1 long, k2 long, sketch binary")


def _children(path: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path): the one or two positions a tree node chooses depend on its path alone."""
    h = X.mix(path)
    first = (h & np.uint64(63)).astype(np.int64)
    second = (first + 1 + ((h >> np.uint64(6)) % np.uint64(POSITIONS - 1)).astype(np.int64)) % POSITIONS
    two = np.flatnonzero((h >> np.uint64(40)).astype(np.float64) < SECOND * (1 << 24))
    rows = np.concatenate([np.arange(len(path)), two])
    at = np.concatenate([first, second[two]])
    value = sketch[rows, at].astype(np.uint64) + np.uint64(256) * at.astype(np.uint64)
    return rows, X.mix(path[rows] ^ X.mix(value + np.uint64(1)))


def _entries(path: np.ndarray, node: np.ndarray, sketch: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(path.view(np.int64)), pa.array(node), _fixed(sketch)], ["path", "node", "sketch"])


ENTRY = "path long, node long, sketch binary"
LINK = "a long, b long"


def plant(batches):
    """Each document's entries two levels down all trees: no tree node above is small in a large corpus."""
    for b in batches:
        node, sketch = b.column("node").to_numpy(), _matrix(b.column("sketch"))
        for t in range(TREES):
            path = np.full(len(node), X.mix(np.array([t + 1], np.uint64))[0])
            rows = np.arange(len(node))
            for _ in range(2):
                r, path = _children(path, sketch[rows])
                rows = rows[r]
            yield _entries(path, node[rows], sketch[rows])


def branch(batches):
    for b in batches:
        path, node, sketch = b.column("path").to_numpy().view(np.uint64), b.column("node").to_numpy(), _matrix(b.column("sketch"))
        rows, path = _children(path, sketch)
        yield _entries(path, node[rows], sketch[rows])


def _links(nodes: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch | None:
    """The links' connected rows as (node, smallest row's node): no more rows than nodes."""
    a, b = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (a, b))
    if not len(a):
        return None
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    some = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(nodes[root[some]])], ["a", "b"])


def compare_small(batches):
    """Rows sorted by path: all pairs of a path's rows by sketch.  A path cut by a batch's end is carried over."""
    held = None
    for b in batches:
        path, node, sketch = b.column("path").to_numpy(), b.column("node").to_numpy(), _matrix(b.column("sketch"))
        if held is not None:
            path, node, sketch = (np.concatenate([x, y]) for x, y in zip(held, (path, node, sketch), strict=True))
        end = int(np.searchsorted(path, path[-1])) if len(path) else 0
        held = path[end:], node[end:], sketch[end:]
        if end and (got := _compare_sorted(path[:end], node[:end], sketch[:end])) is not None:
            yield got
    if held is not None and (got := _compare_sorted(*held)) is not None:
        yield got


def _compare_sorted(path, node, sketch) -> pa.RecordBatch | None:
    a, b = [], []
    rows = np.arange(len(path) - 1)
    step = 1
    while len(rows := rows[rows + step < len(path)]):
        rows = rows[path[rows] == path[rows + step]]
        for i in range(0, len(rows), 1 << 16):
            x = rows[i:i + (1 << 16)]
            hit = x[np.count_nonzero(sketch[x] == sketch[x + step], axis=1) >= AGREE]
            if len(hit):
                a.append(hit)
                b.append(hit + step)
        step += 1
    return _links(node, a, b)


def compare_pivots(batches):
    """Each row against its tree node's pivots: bit i of ``mask`` says that it agrees with the i-th."""
    for b in batches:
        sketch, pivots = _matrix(b.column("sketch")), b.column("pivot_sketches")
        n = np.diff(pivots.offsets.to_numpy())
        first = pivots.offsets.to_numpy()[:-1]
        known = _matrix(pivots.values)
        mask = np.zeros(len(sketch), np.int32)
        for i in range(PIVOTS):
            rows = np.flatnonzero(n > i)
            agree = np.count_nonzero(sketch[rows] == known[first[rows] + i], axis=1) >= AGREE
            mask[rows] |= agree.astype(np.int32) << i
        yield pa.RecordBatch.from_arrays([*[b.column(c) for c in ("path", "node", "sketch", "pivots")], pa.array(mask)],
                                         ["path", "node", "sketch", "pivots", "mask"])


def join_pivots(batches):
    """Per tree node: pivots that rows connect (as links to the smallest); is every row connected to all
    others through them (``pure``), or all but a few loose rows (``few``)?"""
    for b in batches:
        out = {"path": [], "pure": [], "few": [], "a": [], "b": []}
        for path, pivots, masks, loose in zip(*(b.column(c).to_pylist() for c in ("path", "pivots", "masks", "loose")), strict=True):
            groups: list[int] = []
            for m in masks:
                if m:
                    for g in [g for g in groups if g & m]:
                        groups.remove(g)
                        m |= g
                    groups.append(m)
            links = [(pivots[i], pivots[_low(g)]) for g in groups for i in range(len(pivots)) if g >> i & 1 and i != _low(g)]
            out["path"].append(path)
            out["pure"].append(not loose and len(groups) == 1)
            out["few"].append(0 < loose <= SMALL and len(groups) == 1)
            out["a"].append([x for x, _ in links])
            out["b"].append([y for _, y in links])
        yield pa.RecordBatch.from_pydict(out, pa.schema([("path", pa.int64()), ("pure", pa.bool_()), ("few", pa.bool_()), ("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]))


def compare_loose(batches):
    """Each row against the loose rows of its tree node; a batch gives every loose row one link to the
    others it agrees with, as those are connected, and all its links to other loose rows."""
    for b in batches:
        path, node, sketch = b.column("path").to_numpy(), b.column("node").to_numpy(), _matrix(b.column("sketch"))
        bound = b.column("mask").to_numpy() != 0
        own, known = b.column("loose_nodes"), _matrix(b.column("loose_sketches").values)
        ids, at = own.values.to_numpy(), own.offsets.to_numpy()
        a, c = [], []
        for p in np.unique(path):
            rows = np.flatnonzero(path == p)
            span = slice(at[rows[0]], at[rows[0] + 1])
            for r, s in zip(ids[span], known[span], strict=True):
                hit = rows[np.count_nonzero(sketch[rows] == s, axis=1) >= AGREE]
                hit = np.concatenate([hit[bound[hit]][:1], hit[~bound[hit]]])
                a.append(np.full(len(hit), r))
                c.append(node[hit])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(c))], ["a", "b"])


def _low(mask: int) -> int:
    return (mask & -mask).bit_length() - 1


def compare_blocks(batches):
    """Two blocks of documents of one tree node, by sketch."""
    for b in batches:
        for k in range(b.num_rows):
            n1, n2 = (b.column(c)[k].values.to_numpy() for c in ("nodes_a", "nodes_b"))
            s1, s2 = (_matrix(b.column(c)[k].values) for c in ("sketches_a", "sketches_b"))
            nodes, a, c = np.concatenate([n1, n2]), [], []
            for i in range(len(n1)):
                hit = np.flatnonzero(np.count_nonzero(s2 == s1[i], axis=1) >= AGREE) + len(n1)
                a.append(np.full(len(hit), i))
                c.append(hit)
            if (got := _links(nodes, a, c)) is not None:
                yield got


def candidates(reps: DataFrame) -> DataFrame:
    """(a, b): nodes whose sketches agree, connected like all agreeing pairs that share a tree node that was compared.

    The first entries are worked out again by each pass that needs them, deeper levels are written; a level's tables
    go once the next one is there."""
    level, tables = reps.select("node", "sketch").mapInArrow(plant, ENTRY), []
    found = []

    def write(df: DataFrame, name: str) -> DataFrame:
        tables.append(materialize(df, name))
        return tables[-1]

    for depth in range(2, DEEPEST + 1):
        sizes = write(level.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SMALL).select("path"), "large-names")
        some_large = sizes.limit(1).count() > 0
        names = broadcast_bounded(sizes, BROADCAST_PATHS)
        small = (level.join(names, "path", "left_anti") if some_large else level).repartition("path").sortWithinPartitions("path")
        found.append(materialize(small.mapInArrow(compare_small, LINK), "small-links"))
        if not some_large:
            _drop(tables)
            break
        large = write(level.join(names, "path", "left_semi"), "large-paths")
        one = large.groupBy("path", F.pmod(F.xxhash64("node"), F.lit(PIVOTS)).alias("_i")).agg(F.min(F.struct("node", "sketch")).alias("p"))
        pivots = write(one.groupBy("path").agg(F.array_sort(F.collect_list("p")).alias("p"))   # at most PIVOTS
                       .select("path", F.col("p.node").alias("pivots"), F.col("p.sketch").alias("pivot_sketches")), "pivots")
        told = write(large.join(pivots, "path").mapInArrow(compare_pivots, ENTRY + ", pivots array<long>, mask int"), "pivot-links")
        first = F.get("pivots", F.length(F.bin(F.col("mask").bitwiseAND(-F.col("mask")))) - 1)
        bound = told.where("mask <> 0").select(F.col("node").alias("a"), first.alias("b")).where("a <> b")
        found.append(materialize(bound.distinct(), "bound-links"))
        joined = told.groupBy("path").agg(F.first("pivots").alias("pivots"), F.collect_set(F.nullif("mask", F.lit(0))).alias("masks"),   # at most 2**PIVOTS
                                            F.count_if(F.col("mask") == 0).alias("loose"))
        joined = write(joined.mapInArrow(join_pivots, "path long, pure boolean, few boolean, a array<long>, b array<long>"), "joined-pivots")
        found.append(materialize(joined.select(F.inline(F.arrays_zip("a", "b"))), "joined-links"))
        few = joined.where("few").select("path")
        loose = told.where("mask = 0").join(few, "path").groupBy("path").agg(F.collect_list(F.struct("node", "sketch")).alias("l"))   # at most SMALL
        loose = write(loose.select("path", F.col("l.node").alias("loose_nodes"), F.col("l.sketch").alias("loose_sketches")), "loose-rows")
        found.append(materialize(told.select("path", "node", "sketch", "mask").join(loose, "path").mapInArrow(compare_loose, LINK).where("a <> b").distinct(), "loose-links"))
        mixed = joined.where("not pure and not few").select("path")
        rest = told.select("path", "node", "sketch").join(mixed, "path")
        if mixed.limit(1).count() == 0:
            _drop(tables)
            break
        if depth < DEEPEST:
            level = materialize(rest.mapInArrow(branch, ENTRY), "paths")
            _drop(tables)
            tables.append(level)
        else:
            found.append(materialize(_block_links(rest), "block-links"))
            _drop(tables)
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.distinct()


def _drop(tables: list[DataFrame]) -> None:
    """Remove written tables that nothing reads any more."""
    for t in tables:
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            remove_path(t.sparkSession, folder)
    tables.clear()


def _block_links(rest: DataFrame) -> DataFrame:
    """All pairs of blocks of each path's documents."""
    rest = materialize(rest, "deep-paths")
    many = rest.groupBy("path").agg(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS).cast("long").alias("many"))
    blocks = materialize(rest.join(many, "path").withColumn("block", F.pmod(F.xxhash64("node"), "many"))
                         .groupBy("path", "block", "many").agg(F.collect_list(F.struct("node", "sketch")).alias("docs"))
                         .select("path", "block", "many", F.col("docs.node").alias("nodes"), F.col("docs.sketch").alias("sketches")), "deep-blocks")
    pairs = blocks.select("path", F.col("block").alias("a"), F.explode(F.expr("sequence(block, many - 1)")).alias("b"))
    side = lambda k: blocks.select("path", F.col("block").alias(k), F.col("nodes").alias(f"nodes_{k}"), F.col("sketches").alias(f"sketches_{k}"))
    return pairs.join(side("a"), ["path", "a"]).join(side("b"), ["path", "b"]).mapInArrow(compare_blocks, LINK)


# ---- confirmation on full sets ----


def is_link(x: np.ndarray, y: np.ndarray) -> bool:
    if len(x) > len(y):
        x, y = y, x
    if DEN * len(x) < NUM * len(y):
        return False
    at = np.searchsorted(y, x)
    both = int(np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x))
    return DEN * both >= NUM * (len(x) + len(y) - both)


def confirm(nodes: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray], split: int | None = None) -> list[tuple[int, int]]:
    """Links that connect all that the confirmed pairs connect; with ``split``, only pairs across it."""
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    n = len(nodes)
    first, second, alike = [], [], []
    for i in range(n - 1 if split is None else split):
        lo = i + 1 if split is None else split
        agree = np.count_nonzero(sketch[lo:] == sketch[i], axis=1)
        hit = np.flatnonzero(agree >= AGREE)
        first.append(np.full(len(hit), i))
        second.append(hit + lo)
        alike.append(agree[hit])
    out = []
    if first:
        first, second, alike = map(np.concatenate, (first, second, alike))
        for k in np.argsort(-alike, kind="stable").tolist():
            i, j = int(first[k]), int(second[k])
            a, b = find(i), find(j)
            if a != b and is_link(sets[i], sets[j]):
                root[max(a, b)] = min(a, b)
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def _set(buffer: bytes) -> np.ndarray:
    return np.frombuffer(buffer, np.uint64)


def _confirm_cluster(pdf):
    import pandas as pd
    pdf = pdf.sort_values("node")
    sketch = np.frombuffer(b"".join(pdf["sketch"]), np.uint8).reshape(-1, POSITIONS)
    return pd.DataFrame(confirm(pdf["node"].to_numpy(), sketch, [_set(x) for x in pdf["codes"]]), columns=["a", "b"]).astype("int64")


def _confirm_pivot(batches):
    for b in batches:
        ok = [is_link(_set(x), _set(y)) for x, y in zip(b.column("codes").to_pylist(), b.column("pivot_codes").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("cluster"), b.column("node"), b.column("pivot"), pa.array(ok, pa.bool_())],
                                         ["cluster", "node", "pivot", "linked"])


def _confirm_blocks(batches):
    for b in batches:
        for r in b.to_pylist():
            one, two = r["docs_a"], r["docs_b"]
            same = r["a"] == r["b"]
            docs = one if same else one + two
            sketch = np.frombuffer(b"".join(d["sketch"] for d in docs), np.uint8).reshape(-1, POSITIONS)
            links = confirm(np.array([d["node"] for d in docs]), sketch, [_set(d["codes"]) for d in docs], None if same else len(one))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], ["a", "b"])


def _member_sets(docs: DataFrame, members: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(cluster, node, sketch, codes) of the candidate clusters' nodes, from the text of one document each."""
    rows = docs.select(F.col(doc_id).alias("first_id"), F.col(text).alias("text"))
    ids = members.select("node", "cluster", "first_id", "n_shingles", "k1", "k2")
    small = F.broadcast if members.count() <= BROADCAST_IDS else (lambda x: x)
    named = rows.join(small(ids.withColumnRenamed("first_id", "_id")), F.col("first_id").eqNullSafe(F.col("_id")))

    def run(batches):
        for b in batches:
            for i, j, data, offsets in X.chunks(b.column("text")):
                codes, at = shingles(data, offsets, size)
                own = [np.unique(codes[at[d]:at[d + 1]]) for d in range(j - i)]
                found = np.array([len(x) for x in own])
                k1 = np.array([x.sum() for x in own], np.uint64).view(np.int64)
                k2 = np.array([np.bitwise_xor.reduce(X.mix(x), initial=np.uint64(0)) for x in own], np.uint64).view(np.int64)
                part = lambda c: b.column(c).slice(i, j - i)  # noqa: B023, E731
                same = (found == part("n_shingles").to_numpy()) & (k1 == part("k1").to_numpy()) & (k2 == part("k2").to_numpy())
                at_ = np.flatnonzero(same)
                if len(at_):
                    yield pa.RecordBatch.from_arrays(
                        [part("cluster").take(pa.array(at_)), part("node").take(pa.array(at_)), _fixed(sketches(codes, at)[at_]),
                         pa.array([own[d].tobytes() for d in at_], pa.binary())], ["cluster", "node", "sketch", "codes"])

    told = named.select("text", "node", "cluster", "n_shingles", "k1", "k2").mapInArrow(run, "cluster long, node long, sketch binary, codes binary")
    return materialize(told, "cluster-sets")


def confirmed_links(docs: DataFrame, reps: DataFrame, clusters: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(a, b): confirmed links that connect what all links in the candidate clusters connect."""
    members = materialize(clusters.withColumnRenamed("component", "cluster").join(reps.drop("sketch"), "node"), "cluster-members")
    sets = _member_sets(docs, members, doc_id, text, size)
    sizes = materialize(sets.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum(F.length("codes")).alias("bytes"), F.min("node").alias("pivot"))
                        .withColumn("many", F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("long")), "cluster-sizes")
    sized = sets.join(sizes, "cluster")
    small = sized.where("many = 1").select("cluster", "node", "sketch", "codes").groupBy("cluster").applyInPandas(_confirm_cluster, LINK)
    out = materialize(small, "cluster-links")
    if not sizes.where("many > 1").limit(1).count():
        return out
    big = materialize(sized.where("many > 1").select("cluster", "node", "sketch", "codes", "pivot", "many"), "big-clusters")
    pivots = materialize(big.where("node = pivot").dropDuplicates(["node"]).select("cluster", F.col("codes").alias("pivot_codes")), "cluster-pivots")
    linked = materialize(big.select("cluster", "node", "pivot", "codes").join(pivots, "cluster")
                         .mapInArrow(_confirm_pivot, "cluster long, node long, pivot long, linked boolean"), "cluster-pivot-links")
    # documents linked to the pivot are connected; pairs among them are settled
    parted = big.join(linked.select("node", "linked").distinct(), "node").withColumn("block", F.pmod(F.xxhash64("node"), "many") * 2 + F.col("linked").cast("int"))
    blocks = materialize(parted.groupBy("cluster", "block", "linked").agg(F.collect_list(F.struct("node", "sketch", "codes")).alias("docs")), "cluster-blocks")
    names = blocks.select("cluster", "block", "linked")
    pairs = names.where("not linked").select("cluster", F.col("block").alias("a")).join(
        names.select("cluster", F.col("block").alias("b"), F.col("linked").alias("_l")), "cluster").where("_l or a <= b").drop("_l")
    side = lambda k: blocks.select("cluster", F.col("block").alias(k), F.col("docs").alias(f"docs_{k}"))
    across = pairs.join(side("a"), ["cluster", "a"]).join(side("b"), ["cluster", "b"]).mapInArrow(_confirm_blocks, LINK)
    return out.union(linked.where("linked and node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b"))).union(
        materialize(across, "cluster-block-links"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept; sets are of ``size``-word shingles."""
    sets = materialize(describe(docs, doc_id, text, size), "document-sets")
    reps = materialize(sets.where("n_shingles > 0").groupBy("n_shingles", "k1", "k2").agg(
        F.min("doc_id").alias("first_id"), F.min("sketch").alias("sketch")).withColumn("node", F.monotonically_increasing_id()), "distinct-sets")
    clusters = connected(candidates(reps), "a", "b")
    links = confirmed_links(docs, reps, clusters, doc_id, text, size)
    named = reps.select("n_shingles", "k1", "k2", "first_id", "node").join(connected(links, "a", "b"), "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    classes = materialize(named.join(smallest, "component").select("n_shingles", "k1", "k2", "component_id"), "document-classes")
    return sets.select("doc_id", "n_shingles", "k1", "k2").join(classes, ["n_shingles", "k1", "k2"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
