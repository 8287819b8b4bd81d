"""Language-model scoring by context-tree weighting over binary-decomposed bytes.

A byte is eight binary decisions (a node of the 255-node tree of its leading bits); each decision
keeps Krichevsky-Trofimov counts in every context of 0 to ``DEPTH`` preceding bytes, and context-
tree weighting mixes all depths: Pw(s) = 1/2 Pe(s) + 1/2 Pw(children).  Texts are A-Z lower-cased
and end in one end symbol (0xFF, never a byte of UTF-8), which also pads the contexts.

Every context seen in training is in the tree, however rare: the tree is a written table of
(DEPTH + 1)-grams, weighted in tasks.  A context's subtree hangs on its last ``TOP`` bytes, so tasks
weight whole subtrees bottom-up; the driver joins their roots (at most 2^24 of them) to the top of
the tree, and a second pass gives each distinct gram of the scored texts its log-probability.
Texts look up the ``TABLE`` most frequent grams and are joined to the others.

``tree_counts``, ``build_tree`` and ``score_texts`` are the same model in one process, with contexts
below ``MIN_SHARE`` merged; scoring does not use them, tests compare with them.

The unigram base needs every word's count: words with at least ``COMMON_SHARE`` of the tokens are
looked up from a bounded table, the others are joined by their 64-bit code.

Null texts are empty; an empty text scores its end symbol and has one token.  Rows with a null id
are scored but never learned from.  With no training rows every count is 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from velorank.llm import textcodes as X
from velorank.llm.common import remainder
from velorank.session import materialize

DEPTH = 6                          # at most 7: a context and a byte are one 64-bit code
TOP = 2                            # last context bytes that keep a subtree together
HELD_CODES = 5 << 18               # counted codes a task holds at once
TABLE = 1 << 21                    # grams that every task holds
GROUP = 1 << 16                    # grams weighted together, unless one subtree has more
MIN_SHARE = 2.0 ** -16             # of tree_counts only
COMMON_SHARE = 2.0 ** -20
END = 0xFF
GRAMS, WORDS = 0, 1


def _streams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts with DEPTH pad symbols ahead and the end symbol behind."""
    return X.padded(X.LOWERED[data], offsets, DEPTH, 1, END)


def _gram_codes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Context and next byte at each position as one code, the next byte lowest."""
    buf, at = _streams(data, offsets)
    n = len(buf) - DEPTH
    code = np.zeros(n, np.uint64)
    for i in range(DEPTH + 1):
        code |= buf[i:n + i].astype(np.uint64) << np.uint64(8 * (DEPTH - i))
    real = np.ones(len(buf), bool)
    for i in range(DEPTH):
        real[at[:-1] + i] = False     # pads are not predicted
    return code[real[DEPTH:]]


def _counted(rows: DataFrame, text: str, learns: Column, asks: Column) -> DataFrame:
    """(kind, code, n, m): byte grams of the texts that the model learns from (n) and is asked for (m), in one pass;
    words of the learned texts."""
    schema = "kind int, code long, n long, m long"

    def run(batches):
        counters = {(kind, l, a): X.Counter() for kind, l, a in [(GRAMS, 1, 1), (GRAMS, 1, 0), (GRAMS, 0, 1), (WORDS, 1, 0)]}

        def out(key, got):
            kind, l, a = key
            n = got[1].astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(n), kind, np.int32)), pa.array(got[0].view(np.int64)), pa.array(n * l), pa.array(n * a)],
                                              ["kind", "code", "n", "m"])

        for b in batches:
            for l, a in ((1, 1), (1, 0), (0, 1)):
                own = b.filter(pc.and_(pc.equal(b.column(1), bool(l)), pc.equal(b.column(2), bool(a))))
                for _, _, data, offsets in X.chunks(own.column(0)):
                    counters[GRAMS, l, a].add(_gram_codes(data, offsets))
                    if l:
                        counters[WORDS, 1, 0].add(X.word_codes(data, offsets)[0])
                    if sum(c.size for c in counters.values()) > HELD_CODES:
                        key, c = max(counters.items(), key=lambda x: x[1].size)
                        if got := c.drain():
                            yield out(key, got)
        for key, c in counters.items():
            if got := c.drain():
                yield out(key, got)

    told = lambda c: F.coalesce(c, F.lit(False))
    return rows.select(F.col(text).alias("t"), told(learns).alias("l"), told(asks).alias("a")).mapInArrow(run, schema)


def count_corpus(docs: DataFrame, text: str = "text", train: DataFrame | None = None, learns: Column | None = None) -> DataFrame:
    """(kind, code, n, m): counts of all byte grams and words of the training texts (n), and of the grams of
    ``docs`` (m), written.  The training texts are ``train``, or the ``docs`` where ``learns`` holds, read once."""
    yes, no = F.lit(True), F.lit(False)
    if train is None:
        parts = _counted(docs, text, yes if learns is None else learns, yes)
    else:
        parts = _counted(train, text, yes, no).unionByName(_counted(docs, text, no, yes))
    return materialize(parts.groupBy("kind", "code").agg(F.sum("n").alias("n"), F.sum("m").alias("m")), "lm-counts")


@dataclass
class Level:
    """One depth of one binary node: its contexts (context << 8 | leading bits of the next byte),
    counts, weight, chance of a 1 and the weight of ending here."""

    keys: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    log_w: np.ndarray
    kt: np.ndarray
    stop: np.ndarray


def _level(d: int, key: np.ndarray, zeros: np.ndarray, ones: np.ndarray, log_w: np.ndarray | None) -> Level:
    """The entries of depth d from its grams (log_w None) or from those of depth d + 1."""
    keys, up = np.unique(key, return_inverse=True)
    zeros, ones = (np.bincount(up, c, len(keys)).astype(np.float64) for c in (zeros, ones))   # whole if empty
    log_e = _log_kt_counts(zeros, ones)
    if log_w is None:
        weight, stop = log_e, np.ones(len(keys))
    else:
        weight = np.logaddexp(log_e, np.bincount(up, log_w, len(keys))) - math.log(2)
        stop = np.exp(np.minimum(log_e - math.log(2) - weight, 0))
    return Level(keys, zeros, ones, weight, (ones + 0.5) / (zeros + ones + 1), stop)


def _key(code: np.ndarray, d: int, prefix: np.ndarray) -> np.ndarray:
    return ((code >> 8) & ((1 << 8 * d) - 1)) << 8 | prefix


def _shallower(level: Level, d: int) -> Level:
    return _level(d, _key(level.keys, d, level.keys & 255), level.zeros, level.ones, level.log_w)


def _subtree(code: np.ndarray, n: np.ndarray, bit: int) -> dict[int, Level]:
    """The levels DEPTH to TOP of whole subtrees at one of the byte's eight decisions."""
    one = (code >> (7 - bit)) & 1
    levels = {DEPTH: _level(DEPTH, _key(code, DEPTH, (code & 255) >> (8 - bit)), n * (1 - one), n * one, None)}
    for d in range(DEPTH - 1, TOP - 1, -1):
        levels[d] = _shallower(levels[d + 1], d)
    return levels


def _log10_of(code: np.ndarray, levels: list[dict[int, Level]]) -> np.ndarray:
    """log10 probability of each gram's last byte after its context.

    A context that training never reached at a decision has even odds, and so has all below it."""
    out = np.zeros(len(code))
    for bit in range(8):
        one = np.full(len(code), 0.5)
        for d in range(DEPTH, -1, -1):
            level = levels[bit].get(d)
            if level is None or not len(level.keys):
                continue
            key = _key(code, d, (code & 255) >> (8 - bit))
            at = np.minimum(np.searchsorted(level.keys, key), len(level.keys) - 1)
            stop = level.stop[at]
            one = np.where(level.keys[at] == key, stop * level.kt[at] + (1 - stop) * one, 0.5)
        out += np.log10(np.where((code >> (7 - bit)) & 1, one, 1 - one))
    return out


def gram_logs(grams: DataFrame) -> DataFrame:
    """(code, n, log10) of every gram asked for (m > 0) under the tree of all learned ones (n > 0) of the written
    ``grams`` (code, n, m), written; the result's n is m."""
    trained = grams.where("n > 0")
    groups = max(64, trained.count() // GROUP)
    group = F.pmod(F.xxhash64(F.shiftrightunsigned("code", 8).bitwiseAND((1 << 8 * TOP) - 1)), F.lit(groups)).alias("group")

    def roots(table: pa.Table) -> pa.Table:
        code, n = table.column("code").to_numpy(), table.column("n").to_numpy().astype(np.float64)
        parts = [_subtree(code, n, bit)[TOP] for bit in range(8)]
        return pa.table({"bit": pa.array(np.repeat(np.arange(8, dtype=np.int32), [len(p.keys) for p in parts])),
                         **{k: pa.array(np.concatenate([getattr(p, k) for p in parts])) for k in ("keys", "zeros", "ones", "log_w")}})

    told = trained.select(group, "code", "n").groupBy("group") \
        .applyInArrow(roots, "bit int, keys long, zeros double, ones double, log_w double").toArrow()   # at most 2^24 rows a bit
    cols = [told.column(k).to_numpy() for k in ("bit", "keys", "zeros", "ones", "log_w")]
    top: list[dict[int, Level]] = []
    for bit in range(8):
        keys, zeros, ones, log_w = (c[cols[0] == bit] for c in cols[1:])
        root = Level(keys, zeros, ones, log_w, ones, ones)
        levels: dict[int, Level] = {}
        for d in range(TOP - 1, -1, -1):
            root = levels[d] = _shallower(root, d)
        top.append(levels)
    shared = trained.sparkSession.sparkContext.broadcast(top)

    def logs(table: pa.Table) -> pa.Table:
        code, n, m = (table.column(k).to_numpy() for k in ("code", "n", "m"))
        seen, want = n > 0, m > 0
        levels = [{**_subtree(code[seen], n[seen].astype(np.float64), bit), **shared.value[bit]} for bit in range(8)]
        return pa.table({"code": pa.array(code[want]), "n": pa.array(m[want]), "log10": pa.array(_log10_of(code[want], levels))})

    both = grams.select(group, "code", "n", "m")
    return materialize(both.groupBy("group").applyInArrow(logs, "code long, n long, log10 double"), "lm-gram-logs")


def _frequent(logs: DataFrame) -> pa.Table:
    """The most frequent grams, at most ``TABLE``: eighths of an octave of the count, from above, while they fit."""
    step = F.floor(F.log2("n") * 8)
    sizes = logs.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("k")).orderBy(F.col("step").desc()).collect()
    least, room = None, TABLE
    for r in sizes:
        room -= r["k"]
        if room < 0:
            break
        least = r["step"]
    return logs.where(step >= least if least is not None else F.lit(False)).select("code", "log10").orderBy("code").toArrow()


def tree_counts(counts: DataFrame) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(positions, depth, code, n) of the (context, byte) pairs of all kept contexts; bounded by MIN_SHARE."""
    grams = counts.where(F.col("kind") == GRAMS)
    total = grams.agg(F.sum("n").alias("n")).first()["n"] or 0
    masked = F.array(*[F.struct(F.lit(d).alias("d"), F.col("code").bitwiseAND((1 << 8 * (d + 1)) - 1).alias("code"))
                       for d in range(DEPTH + 1)])
    at_depth = grams.select("n", F.inline(masked)).groupBy("d", "code").agg(F.sum("n").alias("n"))
    pairs = at_depth.withColumn("ctx", F.shiftrightunsigned("code", 8))
    kept = at_depth.withColumn("ctx", F.shiftrightunsigned("code", 8)).groupBy("d", "ctx").agg(F.sum("n").alias("_n")) \
        .where((F.col("_n") >= max(total * MIN_SHARE, 1)) | (F.col("d") == 0)).select("d", "ctx")
    got = pairs.join(F.broadcast(kept), ["d", "ctx"]).select("d", "code", "n").toArrow()  # kept: at most DEPTH / MIN_SHARE rows
    col = lambda c: got.column(c).to_numpy()
    return int(total), col("d").astype(np.int64), col("code").astype(np.int64), col("n").astype(np.float64)


def _lgamma(x: np.ndarray) -> np.ndarray:
    """log-gamma for x >= 0.5: eight steps up, then Stirling's series."""
    up = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        up += np.log(y)
        y += 1
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - up


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _lgamma(a + 0.5) + _lgamma(b + 0.5) - _lgamma(a + b + 1) - math.log(math.pi)


def _log_gamma_table(plus: float) -> np.ndarray:
    return _lgamma(np.arange(1 << 16) + plus)


_HALF, _WHOLE = _log_gamma_table(0.5), _log_gamma_table(1.0)


def _log_kt_counts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``_log_kt`` of whole counts, small ones from a table."""
    small = a + b < len(_WHOLE)
    x, y = np.where(small, a, 0).astype(np.int64), np.where(small, b, 0).astype(np.int64)
    out = _HALF[x] + _HALF[y] - _WHOLE[x + y] - math.log(math.pi)
    out[~small] = _log_kt(a[~small], b[~small])
    return out


def _ctx(code: np.ndarray) -> np.ndarray:
    """The context of a code; a code of eight bytes may be negative as a long."""
    return (code.view(np.uint64) >> np.uint64(8)).view(np.int64)


@dataclass
class ContextTree:
    """An automaton; per context and byte column one 64-bit entry: the byte's log10 probability as a
    float32, and where the next context's row begins.  Row 0 is the empty context."""

    table: np.ndarray
    column: np.ndarray                 # of each byte
    width: int

    def log10(self) -> np.ndarray:
        """By context and byte."""
        return self.table.view(np.float32)[::2].reshape(-1, self.width)[:, self.column]


def _predict(c: np.ndarray, parent: np.ndarray, base: list[int]) -> np.ndarray:
    """Chance of a 1 in every context (rows, by depth) for some binary nodes (columns); c: counts of both bits."""
    r = c.copy()                                    # the rest child: what no kept child has
    np.subtract.at(r, parent[base[1]:], c[base[1]:])
    log_e = _log_kt(c[:, :, 0], c[:, :, 1])
    log_w = _log_kt(r[:, :, 0], r[:, :, 1])         # kept children are added below
    for d in range(DEPTH, -1, -1):
        a, b = base[d], base[d + 1]
        log_w[a:b] = log_e[a:b] if d == DEPTH else np.logaddexp(log_e[a:b], log_w[a:b]) - math.log(2)
        if d:
            np.add.at(log_w, parent[a:b], log_w[a:b])
    stop = np.exp(np.minimum(log_e - math.log(2) - log_w, 0))   # weight of ending at this context
    kt = (c[:, :, 1] + 0.5) / (c.sum(2) + 1)
    one = stop * kt + (1 - stop) * (r[:, :, 1] + 0.5) / (r.sum(2) + 1)
    one[base[DEPTH]:] = kt[base[DEPTH]:]
    for d in range(1, DEPTH + 1):                   # mix upward along each context's own suffixes
        a, b = base[d], base[d + 1]
        up = parent[a:b]
        for _ in range(d):
            one[a:b] = stop[up] * kt[up] + (1 - stop[up]) * one[a:b]
            up = parent[up]
    return one


def build_tree(depth: np.ndarray, code: np.ndarray, n: np.ndarray) -> ContextTree:
    """Weights bottom-up over the kept contexts, then each context's predictive distribution."""
    ids: list[np.ndarray] = []      # sorted contexts by depth
    base = [0]
    for d in range(DEPTH + 1):
        ctx = np.unique(_ctx(code[depth == d]))
        if d == 0 and not len(ctx):
            ctx = np.zeros(1, np.int64)
        ids.append(ctx)
        base.append(base[-1] + len(ctx))
    size = base[-1]
    state = np.empty(len(code), np.int64)
    for d in range(DEPTH + 1):
        at = depth == d
        state[at] = base[d] + np.searchsorted(ids[d], _ctx(code[at]))
    counts = np.zeros((size, 256))
    counts[state, code & 255] = n
    parent = np.zeros(size, np.int64)      # the context without its oldest byte
    for d in range(1, DEPTH + 1):
        parent[base[d]:base[d + 1]] = base[d - 1] + np.searchsorted(ids[d - 1], ids[d] & ((1 << 8 * (d - 1)) - 1))
    # a column of the table for every byte seen in training, and one for each largest subtree of bytes
    # that were not: below it all odds are even, so its bytes share their probability
    column, byte_of = np.zeros(256, np.int64), []
    for byte in range(256):
        if not byte or counts[0, byte]:
            fresh = True
        else:
            width = 1
            while width < 256 and not counts[0, byte // (2 * width) * 2 * width:][:2 * width].any():
                width *= 2
            fresh = byte % width == 0
        if fresh:
            byte_of.append(byte)
        column[byte] = len(byte_of) - 1
    byte_of = np.array(byte_of)

    log10 = np.zeros((size, len(byte_of)), np.float32)
    for bit in range(8):
        width = 256 >> bit                          # bytes below one node
        block = min(1 << bit, 8)                    # nodes don't depend on each other: a few at a time
        for first in range(0, 1 << bit, block):
            at = slice(first * width, (first + block) * width)
            mine = np.flatnonzero((byte_of >= at.start) & (byte_of < at.stop))
            if not counts[0, at].any():             # never reached in training: even odds
                log10[:, mine] += math.log10(0.5)
                continue
            one = _predict(counts[:, at].reshape(size, block, 2, -1).sum(3), parent, base)
            node, high = byte_of[mine] // width - first, byte_of[mine] // (width // 2) % 2
            log10[:, mine] += np.log10(np.where(high == 1, one[:, node], 1 - one[:, node])).astype(np.float32)

    step = np.zeros((size, len(byte_of)), np.int32)
    for d in range(DEPTH + 1):
        a, b = base[d], base[d + 1]
        step[a:b] = step[parent[a:b]] if d else 0
        if d < DEPTH:
            longer = ids[d + 1]
            older = longer >> 8
            j = np.searchsorted(ids[d], older)
            ok = (j < len(ids[d])) & (ids[d][np.minimum(j, len(ids[d]) - 1)] == older)
            step[a + j[ok], column[longer[ok] & 255]] = base[d + 1] + np.flatnonzero(ok)
    table = np.empty((step.size, 2), np.int32)
    table[:, 0] = log10.ravel().view(np.int32)
    table[:, 1] = step.ravel() * len(byte_of)
    return ContextTree(table.view(np.int64).ravel(), column.astype(np.uint8), len(byte_of))


def score_texts(tree: ContextTree, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """log10 probability of each text and its end."""
    buf, at = _streams(data, offsets)
    total = len(buf)
    lanes = int(min(4096, max(1, total // 64)))
    length = -(-total // lanes)
    stream = np.concatenate([np.full(DEPTH, END, np.uint8), buf, np.full(lanes * length - total, END, np.uint8)])
    # lane k reads positions k*length - DEPTH ..: the first DEPTH bytes only find its context
    view = np.lib.stride_tricks.as_strided(stream, (lanes, length + DEPTH), (length, 1))
    columns = tree.column[np.ascontiguousarray(view.T)]
    out = np.empty((length, lanes), np.float32)
    at_t, got = np.zeros(lanes, np.int64), np.empty((lanes, 2), np.int32)
    row = np.zeros(lanes, np.int32)
    for t in range(length + DEPTH):
        np.add(row, columns[t], out=at_t)
        np.take(tree.table, at_t, out=got.view(np.int64).ravel(), mode="clip")
        if t >= DEPTH:
            out[t - DEPTH] = got.view(np.float32)[:, 0]
        row = got[:, 1]
    logs = np.ascontiguousarray(out.T).ravel()[:total]
    for i in range(DEPTH):
        logs[at[:-1] + i] = 0
    return X.segment_any_order_sums(logs, at)


def _looked_up(codes: np.ndarray, at: np.ndarray, known: np.ndarray, logs: np.ndarray):
    """(sum of logs, number found, and the others as lists: offsets, codes, times) per text, whose codes start at ``at``."""
    seen, back = np.unique(codes, return_inverse=True)
    k = np.minimum(np.searchsorted(known, seen), max(len(known) - 1, 0))
    hit = known[k] == seen if len(known) else np.zeros(len(seen), bool)
    value = np.where(hit, logs[k] if len(known) else 0.0, 0.0)
    hit = hit[back]
    miss = np.flatnonzero(~hit)                # counted by text and joined later
    doc = np.searchsorted(at, miss, "right")
    by = np.lexsort((codes[miss], doc))
    doc, rare = doc[by], codes[miss][by]
    new = np.flatnonzero(np.concatenate([np.ones(min(1, len(by)), bool), (doc[1:] != doc[:-1]) | (rare[1:] != rare[:-1])]))
    start = pa.array(np.searchsorted(doc[new], np.arange(1, len(at) + 1)).astype(np.int32))
    times = np.diff(np.append(new, len(by))).astype(np.int32)
    return (X.segment_any_order_sums(value[back], at), X.segment_sums(hit.astype(np.int64), at),
            pa.ListArray.from_arrays(start, pa.array(rare[new].view(np.int64))), pa.ListArray.from_arrays(start, pa.array(times)))


def score_documents(docs: DataFrame, train: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
                    learns: Column | None = None) -> DataFrame:
    """One row per document of ``docs``: doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.
    The model learns from ``train``, or from the ``docs`` where ``learns`` holds (all texts are then counted once)."""
    spark = docs.sparkSession
    counts = count_corpus(docs, text, train, learns)
    grams = gram_logs(counts.where(F.col("kind") == GRAMS).select("code", "n", "m"))
    frequent = _frequent(grams)
    words = counts.where((F.col("kind") == WORDS) & (F.col("n") > 0)).select("code", "n")
    told = words.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = (train if train is not None else docs if learns is None else docs.where(learns)).count()
    tokens, distinct = (told["n"] or 0) + ends, told["v"] + (ends > 0)
    common = words.where(F.col("n") >= max(tokens * COMMON_SHARE, 1)).toArrow()   # at most 1 / COMMON_SHARE rows
    codes = common.column("code").to_numpy().view(np.uint64)
    order = np.argsort(codes)
    below = math.log10(tokens + 0.1 * (distinct + 1))
    shared = spark.sparkContext.broadcast((
        frequent.column("code").to_numpy().view(np.uint64), frequent.column("log10").to_numpy(),
        codes[order], np.log10(common.column("n").to_numpy()[order] + 0.1)))

    def run(batches):
        known, known_logs, codes, logs = shared.value
        end_log = math.log10(ends + 0.1)
        for b in batches:
            for i, j, data, offsets in X.chunks(b.column("text")):
                n = j - i
                ws, at = X.word_codes(data, offsets)
                base, n_hit, rare, times = _looked_up(ws, at, codes, logs)
                score, _, grams, gram_times = _looked_up(_gram_codes(data, offsets), offsets + np.arange(n + 1), known, known_logs)
                yield pa.RecordBatch.from_arrays([
                    b.column("doc_id").slice(i, n), pa.array(np.diff(at) + 1), pa.array(n_hit + int(ends > 0)),
                    pa.array(base + end_log - below * (n_hit + 1)), pa.array(score), pa.array(np.diff(offsets)),
                    rare, times, grams, gram_times],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score", "n_bytes", "rare", "times", "grams", "gram_times"])

    kind = docs.schema[doc_id].dataType.simpleString()
    scored = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double, n_bytes long, "
             "rare array<long>, times array<int>, grams array<long>, gram_times array<int>")
    # written once: row ids stay as they are and texts are scored a single time
    table = materialize(scored.withColumn("_row", F.monotonically_increasing_id()), "lm-scored")
    rare = table.select("_row", F.inline(F.arrays_zip(F.col("rare").alias("code"), F.col("times").alias("k")))) \
        .join(words, "code", "left") \
        .groupBy("_row").agg(F.sum(F.col("k") * (F.log10(F.coalesce("n", F.lit(0)) + 0.1) - below)).alias("_log"),
                             F.sum(F.when(F.col("n").isNotNull(), F.col("k")).otherwise(0)).alias("_known"))
    rest = table.select("_row", F.inline(F.arrays_zip(F.col("grams").alias("code"), F.col("gram_times").alias("k")))) \
        .join(grams.select("code", "log10"), "code") \
        .groupBy("_row").agg(F.sum(F.col("k") * F.col("log10")).alias("_rest"))
    score = F.col("score") + F.coalesce("_rest", F.lit(0.0))
    return table.drop("rare", "times", "grams", "gram_times").join(rare, "_row", "left").join(rest, "_row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_log", F.lit(0.0))).alias("base_score"), score.alias("score"),
        (-score / (math.log10(2) * (F.col("n_bytes") + 1))).alias("bits_per_byte"))


def learned(doc_id: str = "doc_id", mod: int = 10, held: int = 0) -> Column:
    return F.coalesce(remainder(F.col(doc_id), mod) != held, F.lit(False))


def training_rows(docs: DataFrame, mod: int = 10, held: int = 0, doc_id: str = "doc_id") -> DataFrame:
    return docs.where(learned(doc_id, mod, held))
