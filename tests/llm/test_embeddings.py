"""Epsilon grid order join against all pairs, and connected components."""

import numpy as np
import pytest

from velorank.llm import embedding_dedup as E
from velorank.llm.components import connected


def brute(rows, t=0.98):
    ids = [r[0] for r in rows]
    ok = [r[0] is not None and r[2] is not None and r[1] is not None and len(r[1]) and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    root, links = list(range(len(rows))), [0] * len(rows)
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(rows):
        for j in range(i):
            b = rows[j]
            if ok[i] and ok[j] and a[2] == b[2] and len(a[1]) == len(b[1]):
                x, y = (np.array(v, float) for v in (a[1], b[1]))
                if x @ y / np.sqrt((x @ x) * (y @ y)) >= t:
                    links[i] += 1
                    links[j] += 1
                    p, q = find(i), find(j)
                    root[p] = q
    comp = {}
    for i in range(len(rows)):
        comp.setdefault(find(i), []).append(ids[i])
    return sorted(str((ids[i], links[i], min((x for x in comp[find(i)] if x is not None), default=None))) for i in range(len(rows)))


@pytest.mark.parametrize("block", [256, 4])
def test_links_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(E, "BLOCK", block)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(size=16) * rng.choice([0, 0.05, 0.12, 0.4])).astype(np.float32).tolist(), i % 3) for i in range(240)]
    rows += [(500 + i, rows[3][1], rows[3][2]) for i in range(20)] + [(900, rows[3][1], 7), (901, [2 * x for x in rows[3][1]], rows[3][2])]
    rows += [(910, None, 1), (911, [0.0] * 16, 1), (912, [float("nan")] + [1.0] * 15, 1), (913, [None] + [1.0] * 15, 1), (914, rows[4][1], None),
             (915, [], 1), (916, rows[4][1][:8], rows[4][2]), (None, rows[4][1], rows[4][2]), (5, rows[9][1], rows[9][2])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got = E.near_duplicates(df).collect()
    assert sorted(str((r["vec_id"], r["n_links"], r["component_id"])) for r in got) == brute(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_connected(spark):
    rng = np.random.default_rng(6)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2000 + i) for i in range(200)]
    root = {}
    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {x: find(x) for x in linked}
