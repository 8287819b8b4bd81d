"""Numpy kernels on histograms of one task or one driver: best splits, random thresholds, small subtrees."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: The modulus and factors of the seeded draws (whole numbers, the same in any engine).
PRIME = (1 << 31) - 1
FACTORS = (48271, 69621, 16807, 39373, 7919)
#: Poisson(1) cumulative probabilities: a row's copies in a bootstrap are the ones below its draw.
POISSON = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040)])
#: Gains closer than this share of the best are ties; the first feature, then the lowest cut wins.
TIE = 1e-9
#: Nodes of a subtree that hold fewer rows than this on average are split by their rows, not by histograms.
FEW_ROWS = 600


def draw(stream, a, b=0) -> np.ndarray:
    """Uniform numbers in (0, 1) from three whole numbers."""
    h = _modulo(np.asarray(stream, np.int64) % PRIME * FACTORS[0] + np.asarray(a, np.int64) % PRIME * FACTORS[1]
                + np.asarray(b, np.int64) % PRIME * FACTORS[2] + FACTORS[3])
    for _ in range(3):
        h = _modulo(h * h + h * FACTORS[4] + FACTORS[3])
    return (h + 0.5) / PRIME


def _modulo(x):
    """``x % PRIME`` of whole numbers from 0 on: the prime is 2^31 - 1, so the upper bits fold onto the lower."""
    x = (x & PRIME) + (x >> 31)
    x = (x & PRIME) + (x >> 31)
    return np.where(x >= PRIME, x - PRIME, x)


def copies(stream: int, key: np.ndarray) -> np.ndarray:
    """How often each row is in the bootstrap sample ``stream``."""
    return np.searchsorted(POISSON, draw(stream, key), "left")


@dataclass
class Rules:
    """When a node may be split."""
    min_leaf: int = 1
    max_depth: int | None = None
    max_leaves: int | None = None


@dataclass
class Layout:
    """Where each feature's bins stand in a flat histogram."""
    sizes: np.ndarray
    start: np.ndarray = field(init=False)
    feature: np.ndarray = field(init=False)
    two: np.ndarray = field(init=False)        # features of two bins, counted eight at a time
    more: np.ndarray = field(init=False)       # features of more bins
    packed: np.ndarray = field(init=False)     # values of each column that ``pack`` makes

    def __post_init__(self):
        self.start = np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)
        self.feature = np.repeat(np.arange(len(self.sizes)), self.sizes)
        self.two, self.more = np.flatnonzero(self.sizes == 2), np.flatnonzero(self.sizes > 2)
        self.packed = np.array([*self.sizes[self.more], *[256] * -(-len(self.two) // 8)], np.int64)

    @property
    def width(self) -> int:
        return int(self.start[-1])

    @property
    def places(self) -> np.ndarray:
        """[feature, (packed column, shift, mask)] of every feature's bin; a feature of one bin has mask 0."""
        out = np.zeros((len(self.sizes), 3), np.int64)
        out[self.more] = np.stack([np.arange(len(self.more)), np.zeros(len(self.more), int), np.full(len(self.more), 255)], 1)
        i = np.arange(len(self.two))
        out[self.two] = np.stack([len(self.more) + i // 8, i % 8, np.ones(len(i), int)], 1)
        return out

    def pack(self, columns: np.ndarray) -> np.ndarray:
        """Bins [feature, row] in fewer columns: features of more than two bins, then eight of two bins a column."""
        out = np.zeros((len(self.packed), columns.shape[1]), np.uint8)
        out[:len(self.more)] = columns[self.more]
        for i, f in enumerate(self.two):
            out[len(self.more) + i // 8] |= columns[f] << (i % 8)
        return out

    def unpack(self, packed: np.ndarray) -> np.ndarray:
        """Bins [feature, row] of packed columns."""
        columns = np.zeros((len(self.sizes), packed.shape[1]), np.uint8)
        columns[self.more] = packed[:len(self.more)]
        for i, f in enumerate(self.two):
            columns[f] = packed[len(self.more) + i // 8] >> (i % 8) & 1
        return columns


#: [byte, bit]: is the bit set, lowest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def keep_heap() -> None:
    """Let freed arrays stay with the process: the allocator returns less to the system after a large array was
    freed, and fetching pages anew costs more than the counting."""
    spare = np.empty(31 << 20, np.uint8)
    del spare


@dataclass
class Mixed:
    """Features for random thresholds: those whose bins are their values as bins, the others as raw values."""
    values: list
    exact: np.ndarray = field(init=False)
    wide: np.ndarray = field(init=False)
    layout: Layout = field(init=False)         # of the exact features

    def __post_init__(self):
        self.exact = np.array([j for j, v in enumerate(self.values) if v is not None], np.int64)
        self.wide = np.array([j for j, v in enumerate(self.values) if v is None], np.int64)
        self.layout = Layout(np.array([max(len(self.values[j]), 1) for j in self.exact], np.int64))

    @property
    def size(self) -> int:
        """Numbers of a node in ``spreads``."""
        return 2 * self.layout.width + 2 * len(self.wide)

    def split_up(self, told: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Histograms of the exact features, least and largest values of all, from what ``spreads`` gives."""
        m, w = len(told), 2 * self.layout.width
        h = told[:, :w].reshape(m, -1, 2)
        low, high = np.full((m, len(self.values)), np.inf), np.full((m, len(self.values)), -np.inf)
        low[:, self.wide], high[:, self.wide] = told[:, w:w + len(self.wide)], -told[:, w + len(self.wide):]
        for k, j in enumerate(self.exact):
            held = h[:, self.layout.start[k]:self.layout.start[k + 1], 0] > 0
            some = held.any(axis=1)
            if len(self.values[j]):
                low[some, j] = self.values[j][held.argmax(axis=1)[some]]
                high[some, j] = self.values[j][held.shape[1] - 1 - held[:, ::-1].argmax(axis=1)[some]]
        return h, low, high

    def code_cuts(self, features: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Cuts of exact features as bins: the last bin at or below them; others stay."""
        out = np.array(cuts, np.float64)
        for j in np.unique(features):
            if j >= 0 and self.values[j] is not None:
                at = features == j
                out[at] = np.searchsorted(self.values[j], out[at], "right") - 1
        return out

    def left_of(self, h: np.ndarray, cuts: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[node, feature]: rows and sum at or below the cuts; ``below`` [node, 2, wide] has them for the raw ones."""
        n, s = np.zeros(cuts.shape), np.zeros(cuts.shape)
        n[:, self.wide], s[:, self.wide] = below[:, 0], below[:, 1]
        rows = np.arange(len(cuts))
        for k, j in enumerate(self.exact):
            if len(self.values[j]):
                run = h[:, self.layout.start[k]:self.layout.start[k + 1]].cumsum(axis=1)
                at = np.searchsorted(self.values[j], cuts[:, j], "right") - 1
                n[:, j], s[:, j] = np.where(at[:, None] >= 0, run[rows, at], 0.0).T
        return n, s


def spreads(codes: np.ndarray, x: np.ndarray, rows, slot: np.ndarray, w: np.ndarray, g: np.ndarray, slots: int, mixed: Mixed) -> tuple[np.ndarray, np.ndarray]:
    """Per slot the histograms of the exact features, and least and (negative) largest values of the others."""
    h = histograms(codes, slot, w, g, slots, mixed.layout, rows).reshape(slots, -1)
    low, high = np.full((slots, len(x)), np.inf), np.full((slots, len(x)), -np.inf)
    if len(slot) and len(x):
        order = np.argsort(slot.astype(np.uint16) if slots < 1 << 16 else slot, kind="stable")
        of = slot[order]
        at = np.flatnonzero(np.diff(of, prepend=-1))
        from_ = order if rows is None else rows[order]
        for j in range(len(x)):
            v = x[j].take(from_)
            low[of[at], j], high[of[at], j] = np.minimum.reduceat(v, at), np.maximum.reduceat(v, at)
    return h, np.concatenate([low, -high], axis=1)


def sums_below(x: np.ndarray, rows, slot: np.ndarray, w: np.ndarray, g: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """[slot, 2, feature]: rows and sum at or below each slot's cuts; ``x`` [feature, row]."""
    out = np.zeros((len(cuts), 2, len(x)))
    once, wg, two = bool((w == 1).all()), w * g, slot * 2
    cell = np.empty(len(slot), np.int64)
    for j in range(len(x)):
        v = x[j] if rows is None else x[j].take(rows)
        np.add(two, v <= cuts[:, j].take(slot), out=cell)
        out[:, 0, j] = np.bincount(cell, None if once else w, 2 * len(cuts))[1::2]
        out[:, 1, j] = np.bincount(cell, wg, 2 * len(cuts))[1::2]
    return out


def histograms(packed: np.ndarray, slot: np.ndarray, w: np.ndarray, g: np.ndarray, slots: int, layout: Layout, rows=None, into: np.ndarray | None = None) -> np.ndarray:
    """[slot, bin, (rows, sum)] over all features of ``packed`` [column, row]; ``slot`` is each row's node.
    ``rows``: the rows of ``packed`` that ``slot``, ``w`` and ``g`` are of.  ``into``: added to this array."""
    out = np.zeros((slots, layout.width, 2)) if into is None else into
    if not len(slot):
        return out
    once, wg = bool((w == 1).all()), w * g
    total = np.stack([np.bincount(slot, None if once else w, slots), np.bincount(slot, wg, slots)], 1)
    # few rows for many nodes: only the nodes that have some are counted
    some = np.flatnonzero(np.bincount(slot, None, slots)) if slots > 1 else np.zeros(1, np.int64)
    if len(some) < slots:
        place = np.zeros(slots, np.int64)
        place[some] = np.arange(len(some))
        slot, total = place[slot], total[some]
    m = len(some)
    at = slice(None) if m == slots else some
    offset, cell = slot * 256, np.empty(len(slot), np.int64)
    # all rows in the first bin, until told otherwise
    first = np.flatnonzero(layout.sizes < 3)
    out[np.ix_(some, layout.start[first])] += total[:, None]
    for j, size in enumerate(layout.packed):
        np.add(packed[j] if rows is None else packed[j].take(rows), offset, out=cell)
        got = np.stack([np.bincount(cell, None if once else w, m * 256), np.bincount(cell, wg, m * 256)], 1).reshape(m, 256, 2)
        if j < len(layout.more):
            a = layout.start[layout.more[j]]
            out[at, a:a + size] += got[:, :size]
        else:
            a = layout.start[layout.two[8 * (j - len(layout.more)):][:8]]
            hit = (BITS.T @ got)[:, :len(a)]
            out[np.ix_(some, a + 1)] += hit
            out[np.ix_(some, a)] -= hit
    return out


def leaves(tree: dict, n: int, bins: np.ndarray, places: np.ndarray, x: np.ndarray | None = None, wide: np.ndarray | None = None, max_depth: int | None = None) -> np.ndarray:
    """The leaf of each of ``n`` rows (with ``max_depth``, the node that deep); ``bins`` [packed column, row].  Cuts of
    features with ``wide`` >= 0 are compared with that row of ``x``.  Children have higher numbers than their parent."""
    feature, cut, left, right = (np.asarray(tree[k]) for k in ("feature", "cut", "left", "right"))
    inner = np.flatnonzero(feature >= 0)
    if not len(inner):
        return np.zeros(n, np.uint8)
    depth = np.zeros(len(feature), np.int64)
    for i in inner.tolist() if len(inner) <= 4096 else ():
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    if max_depth is None and len(inner) <= 4096 and len(inner) <= 12 * depth.max():
        return _by_columns(feature, cut, left, right, inner, n, bins, places, x, wide)
    column, shift, mask = places.T[0] * n, places.T[1], places.T[2]
    flat, raw = bins.reshape(-1), None if x is None else x.reshape(-1)
    at, rows, step = np.zeros(n, np.int64), None, 0
    feature, left, right = (v.astype(np.int64) for v in (feature, left, right))
    limit = np.floor(cut).astype(np.int64)
    while max_depth is None or step < max_depth:
        i = at if rows is None else at[rows]
        f = feature.take(i)
        go = f >= 0
        if not go.all():
            kept = np.flatnonzero(go)
            rows = kept if rows is None else rows[kept]
            if not len(rows):
                break
            i, f = i[kept], f[kept]
        here = np.arange(n) if rows is None else rows
        v = flat.take(column.take(f) + here) >> shift.take(f) & mask.take(f)
        up = v > limit.take(i)
        if raw is not None:
            own = np.flatnonzero(wide.take(f) >= 0)
            up[own] = raw.take(wide.take(f[own]) * n + here[own]) > cut.take(i[own])
        to = np.where(up, right.take(i), left.take(i))
        if rows is None:
            at = to
        else:
            at[rows] = to
        step += 1
    return at


def _by_columns(feature, cut, left, right, inner, n, bins, places, x, wide) -> np.ndarray:
    """Leaves of a small tree by whole columns, last node first; sums of the smallest type wrap around and come out right."""
    kind = np.uint8 if len(feature) <= 256 else np.uint16
    found: dict = {}
    for i in inner[::-1].tolist():
        low, high = (found.pop(int(c), kind(c)) for c in (left[i], right[i]))
        f = int(feature[i])
        if wide is not None and wide[f] >= 0:
            up = x[wide[f]] > cut[i]
        else:
            column, shift, mask = places[f].tolist()
            limit = int(np.floor(cut[i]))
            up = bins[column] > limit if mask == 255 else (bins[column] & (1 << shift) > 0) if mask and limit < 1 else np.zeros(n, bool)
        with np.errstate(over="ignore"):
            found[i] = up.view(np.uint8) * (high - low) + low
    return found[0]


def settle(tree: dict, columns: np.ndarray, told: np.ndarray) -> np.ndarray:
    """``told`` [node] of every row's leaf.  A node's leaf is chosen between its children's by whole columns,
    last node first, so no row is followed; children have higher numbers than their parent."""
    feature, cut, left, right = (np.asarray(tree[k]).tolist() for k in ("feature", "cut", "left", "right"))
    found: dict = {}
    for i in range(len(feature) - 1, -1, -1):
        if feature[i] >= 0:
            low, high = found.pop(left[i], left[i]), found.pop(right[i], right[i])
            if isinstance(low, int) and isinstance(high, int) and told[low] == told[high]:
                found[i] = low
            else:
                limit = int(cut[i]) if columns.dtype == np.uint8 else cut[i]
                found[i] = low + (columns[feature[i]] > limit).astype(np.int32) * (high - low)
    out = found.get(0, 0)
    return np.full(columns.shape[1], told[out]) if isinstance(out, int) else told[out]


def best_splits(h: np.ndarray, layout: Layout, min_leaf: int) -> dict[str, np.ndarray]:
    """Per histogram: the split of the largest fall in squared error (``gain`` 0: none), and what goes left."""
    if layout.width == 0 or not len(h):
        return {k: np.zeros(len(h), t) for k, t in (("feature", int), ("cut", int), ("gain", float), ("n_left", float), ("s_left", float))}
    total = h[:, layout.start[0]:layout.start[1]].sum(axis=1)
    run = np.cumsum(h, axis=1)
    before = np.concatenate([np.zeros((len(h), 1, 2)), run], axis=1)[:, layout.start[:-1]]
    left = run - np.repeat(before, layout.sizes, axis=1)
    return _named(left, total, layout, min_leaf)


def best_of_few(packed: np.ndarray, rows: np.ndarray, slot: np.ndarray, w: np.ndarray, g: np.ndarray, slots: int, layout: Layout, min_leaf: int) -> dict[str, np.ndarray]:
    """``best_splits`` for nodes of few rows: the cost goes with the rows, not with nodes times bins.  The cuts
    between a node's own bins are tried in the same order, so the same one wins."""
    out = {k: np.zeros(slots, t) for k, t in (("feature", int), ("cut", int), ("gain", float), ("n_left", float), ("s_left", float))}
    if not len(slot):
        return out
    order = np.argsort(slot.astype(np.uint16) if slots < 1 << 16 else slot, kind="stable")
    slot, w, wg, rows = slot[order], w[order], (w * g)[order], rows[order]
    starts = np.flatnonzero(np.diff(slot, prepend=-1))
    ids = slot[starts]
    n, s = np.add.reduceat(w, starts), np.add.reduceat(wg, starts)
    which = np.repeat(np.arange(len(ids)), np.diff(np.append(starts, len(slot))))
    least = max(min_leaf, 1) - 1e-6

    def gain_of(k, nl, sl):
        nr, sr = n[k] - nl, s[k] - sl
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = sl * sl / nl + sr * sr / nr - s[k] * s[k] / n[k]
        return np.where((nl >= least) & (nr >= least), gain, 0.0)

    places = layout.places.tolist()
    tried: list = []                   # per feature: (nodes, cuts, gains, rows left, sum left), nodes and cuts ascending
    for f, size in enumerate(layout.sizes):
        column, shift, mask = places[f]
        if size < 2:
            tried.append(None)
            continue
        v = packed[column].take(rows)
        if mask == 1:                  # two bins: a sum a node
            low = 1.0 - (v >> shift & 1)
            nl, sl = np.add.reduceat(low * w, starts), np.add.reduceat(low * wg, starts)
            k = np.arange(len(ids))
            tried.append((k, np.zeros(len(ids), np.int64), gain_of(k, nl, sl), nl, sl))
            continue
        cell = which * 256 + v
        by = np.argsort(v, kind="stable")
        by = by[np.argsort(which[by].astype(np.uint16) if len(ids) < 1 << 16 else which[by], kind="stable")]
        cell = cell[by]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        k, cut = cell[first] >> 8, cell[first] & 255
        nb, sb = np.add.reduceat(w[by], first), np.add.reduceat(wg[by], first)
        rn, rs = np.cumsum(nb), np.cumsum(sb)
        begin = np.flatnonzero(np.diff(k, prepend=-1))
        nl, sl = rn - (rn[begin] - nb[begin])[k], rs - (rs[begin] - sb[begin])[k]
        tried.append((k, cut, gain_of(k, nl, sl), nl, sl))
    top = np.zeros(len(ids))
    peaks = []
    for t in tried:
        peaks.append(None if t is None else np.maximum.reduceat(t[2], np.flatnonzero(np.diff(t[0], prepend=-1))))
        if t is not None:
            top = np.maximum(top, peaks[-1])
    limit, open_ = top - TIE * np.abs(top), top > 0
    for f, t in enumerate(tried):
        if t is None:
            continue
        win = open_ & (peaks[f] >= limit)
        if not win.any():
            continue
        at = np.flatnonzero(win[t[0]] & (t[2] >= limit[t[0]]))
        at = at[np.diff(t[0][at], prepend=-1) > 0]
        to = ids[t[0][at]]
        out["feature"][to], out["cut"][to], out["gain"][to], out["n_left"][to], out["s_left"][to] = f, t[1][at], t[2][at], t[3][at], t[4][at]
        open_ &= ~win
    return out


def gains(n_left: np.ndarray, s_left: np.ndarray, total: np.ndarray, min_leaf: int) -> np.ndarray:
    n, s = total[:, :1], total[:, 1:]
    n_right, s_right = n - n_left, s - s_left
    least = max(min_leaf, 1) - 1e-6
    ok = (n_left >= least) & (n_right >= least)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = s_left * s_left / n_left + s_right * s_right / n_right - s * s / n
    return np.where(ok, gain, 0.0)


def first_best(gain: np.ndarray) -> np.ndarray:
    top = gain.max(axis=1, keepdims=True)
    return np.argmax(gain >= top - TIE * np.abs(top), axis=1)


def _named(left: np.ndarray, total: np.ndarray, layout: Layout, min_leaf: int) -> dict[str, np.ndarray]:
    gain = gains(left[..., 0], left[..., 1], total, min_leaf)
    at, rows = first_best(gain), np.arange(len(gain))
    feature = layout.feature[at]
    return {"feature": feature, "cut": at - layout.start[feature], "gain": gain[rows, at], "n_left": left[rows, at, 0], "s_left": left[rows, at, 1]}


def worth(gain: np.ndarray, n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Is a gain more than rounding?"""
    return gain > 1e-12 * (np.abs(s) * np.abs(s) / np.maximum(n, 1) + 1.0)


def thresholds(stream: int, keys: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """[node, feature]: one seeded threshold between the node's least and largest value."""
    u = draw(stream, keys[:, None], np.arange(low.shape[1])[None, :])
    cut = low + u * (high - low)
    return np.where(cut >= high, low, cut)


def child_key(key, side: int):
    """A node's name: the same wherever the node is grown."""
    return (key * 2 + side) % PRIME


def _unpacked(packed: np.ndarray, x: np.ndarray, mixed: Mixed) -> np.ndarray:
    """Raw values [feature, row] of all features."""
    out = np.zeros((len(mixed.values), x.shape[1]))
    out[mixed.wide] = x
    for j, codes in zip(mixed.exact, mixed.layout.unpack(packed)):
        if len(mixed.values[j]):
            out[j] = mixed.values[j].take(codes)
    return out


def mixed_places(mixed: Mixed) -> tuple[np.ndarray, np.ndarray]:
    """Where each feature's bin stands in the packed exact features, and its row among the raw ones (-1: none)."""
    places, wide = np.zeros((len(mixed.values), 3), np.int64), np.full(len(mixed.values), -1)
    places[mixed.exact] = mixed.layout.places
    wide[mixed.wide] = np.arange(len(mixed.wide))
    return places, wide


def small_tree(values: np.ndarray | None, y: np.ndarray, w: np.ndarray, rules: Rules, depth: int, key: int, layout: Layout | None, stream: int,
               packed: np.ndarray | None = None, x: np.ndarray | None = None, mixed: Mixed | None = None) -> dict[str, np.ndarray]:
    """A whole subtree of rows that one task holds, level by level: on bins with ``layout``, else on raw
    values with random thresholds.  Node 0 is the root; leaves have feature -1.  Rows come as ``values``
    [row, feature], or as ``packed`` columns and, with ``mixed``, the raw ones ``x`` [feature, row]."""
    # every leaf holds a row, so there are fewer nodes than twice the rows
    nodes = {k: np.zeros(2 * len(y) + 1, np.float64 if k in ("cut", "n", "s", "gain") else np.int64) for k in ("feature", "cut", "left", "right", "n", "s", "key", "depth", "gain")}
    for k in ("feature", "left", "right"):
        nodes[k][:] = -1
    nodes["n"][0], nodes["s"][0], nodes["key"][0], nodes["depth"][0] = w.sum(), (w * y).sum(), key, depth
    count = 1
    at, open_ = np.zeros(len(y), np.int64), np.zeros(1, np.int64)
    if layout:
        packed = layout.pack(np.ascontiguousarray(values.T)) if packed is None else packed
        places, wide, x = layout.places, None, None
    else:
        mixed = mixed or Mixed([None] * values.shape[1])
        x = np.ascontiguousarray(values.T) if x is None else x
        packed = np.zeros((0, len(y)), np.uint8) if packed is None else packed
        places, wide = mixed_places(mixed)
    width = max(layout.width if layout else mixed.layout.width, 1)
    while True:
        able = nodes["n"][open_] >= 2 * max(rules.min_leaf, 1)
        if rules.max_depth is not None:
            able &= nodes["depth"][open_] < rules.max_depth
        open_ = open_[able]
        if not len(open_):
            break
        following = []
        # nodes of few rows one by one by their rows, all of a level at once
        few = len(y) < FEW_ROWS * len(open_)
        if few and not layout and len(x) < len(mixed.values):
            x, packed, mixed = _unpacked(packed, x, mixed), np.zeros((0, len(y)), np.uint8), Mixed([None] * len(mixed.values))
            places, wide = mixed_places(mixed)
        block = len(open_) if few else max(1, int(4e6 // width))
        for a in range(0, len(open_), block):
            own = open_[a:a + block]
            place = np.full(count, -1)
            place[own] = np.arange(len(own))
            slot = place[at]
            rows = np.flatnonzero(slot >= 0)
            slot = slot[rows]
            total = np.stack([nodes["n"][own], nodes["s"][own]], 1)
            if layout:
                if few:
                    found = best_of_few(packed, rows, slot, w[rows], y[rows], len(own), layout, rules.min_leaf)
                else:
                    found = best_splits(histograms(packed, slot, w[rows], y[rows], len(own), layout, rows), layout, rules.min_leaf)
                limit = found["cut"]
            else:
                keys = nodes["key"][own]
                h, low, high = mixed.split_up(np.concatenate(spreads(packed, x, rows, slot, w[rows], y[rows], len(own), mixed), axis=1))
                cuts = thresholds(stream, keys, low, high)
                left = mixed.left_of(h, cuts, sums_below(x, rows, slot, w[rows], y[rows], cuts[:, mixed.wide]))
                found = random_splits(*left, cuts, total, rules.min_leaf, low < high)
                limit = mixed.code_cuts(found["feature"], found["cut"])
            split = worth(found["gain"], total[:, 0], total[:, 1])
            target, k = np.full((len(own), 2), -1, np.int64), np.flatnonzero(split)
            target[k] = count + np.arange(2 * len(k)).reshape(-1, 2)
            count += 2 * len(k)
            i, nl, sl = own[k], found["n_left"][k], found["s_left"][k]
            nodes["feature"][i], nodes["cut"][i], nodes["gain"][i] = found["feature"][k], found["cut"][k], found["gain"][k]
            nodes["left"][i], nodes["right"][i] = target[k].T
            for side, (child, n, s) in enumerate(((target[k, 0], nl, sl), (target[k, 1], total[k, 0] - nl, total[k, 1] - sl))):
                nodes["n"][child], nodes["s"][child], nodes["key"][child], nodes["depth"][child] = n, s, child_key(nodes["key"][i], side), nodes["depth"][i] + 1
            following.append(target[k].ravel())
            move = split[slot]
            k, r = slot[move], rows[move]
            f = found["feature"][k]
            right = (packed[places[f, 0], r] >> places[f, 1] & places[f, 2]) > limit[k] if len(packed) else np.zeros(len(r), bool)
            if wide is not None:
                raw = np.flatnonzero(wide[f] >= 0)
                right[raw] = x[wide[f[raw]], r[raw]] > limit[k[raw]]
            at[r] = target[k, right.astype(int)]
        open_ = np.concatenate(following)
    return {k: v[:count] for k, v in nodes.items()}


def ranges(x: np.ndarray, slot: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """[slot, feature]: least and largest value (inf and -inf without rows)."""
    low, high = np.full((slots, x.shape[1]), np.inf), np.full((slots, x.shape[1]), -np.inf)
    if len(slot):
        order = np.argsort(slot, kind="stable")
        at = np.flatnonzero(np.diff(slot[order], prepend=-1))
        low[slot[order][at]], high[slot[order][at]] = np.minimum.reduceat(x[order], at, axis=0), np.maximum.reduceat(x[order], at, axis=0)
    return low, high


def left_sums(x: np.ndarray, slot: np.ndarray, w: np.ndarray, g: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[slot, feature]: rows and sum at or below each node's threshold."""
    n, s = np.zeros(cuts.shape), np.zeros(cuts.shape)
    if len(slot):
        order = np.argsort(slot, kind="stable")
        at = np.flatnonzero(np.diff(slot[order], prepend=-1))
        below = (x[order] <= cuts[slot[order]]).astype(np.float64)
        n[slot[order][at]] = np.add.reduceat(below * w[order, None], at, axis=0)
        s[slot[order][at]] = np.add.reduceat(below * (w * g)[order, None], at, axis=0)
    return n, s


def random_splits(n_left, s_left, cuts, total, min_leaf: int, varies: np.ndarray) -> dict[str, np.ndarray]:
    gain = np.where(varies, gains(n_left, s_left, total, min_leaf), 0.0)
    at, rows = first_best(gain), np.arange(len(gain))
    return {"feature": at, "cut": cuts[rows, at], "gain": gain[rows, at], "n_left": n_left[rows, at], "s_left": s_left[rows, at]}
