"""DuckDB SQL that grows small tree ensembles split by split, to check the tree families with."""

from __future__ import annotations

from velorank.oracles import REPOS_SQL

P = 2147483647


def _uniform(stream: str, a: str, b: str) -> str:
    """The seeded draw of three whole numbers in (0, 1)."""
    h = f"(({stream}) % {P} * 48271 + ({a}) % {P} * 69621 + ({b}) % {P} * 16807 + 39373) % {P}"
    step = lambda x: f"list_reduce([{x}, 0::BIGINT, 0, 0], lambda h, i: (h * h + h * 7919 + 39373) % {P})"
    return f"(({step(f'({h})::BIGINT')} + 0.5) / {P}.0::DOUBLE)"


def _copies(stream: int) -> str:
    """Poisson(1) copies of a row."""
    total, term, parts = 0.0, 0.36787944117144233, []
    for k in range(8):
        total += term
        parts.append(f"({_uniform(str(stream), 'pos', '0')} > {total!r}::DOUBLE)::INT")
        term /= k + 1
    return f"({' + '.join(parts)})::DOUBLE"


def trees_sql(strata: list[tuple[str, str]], features: list[str], trees: int, splits: int, max_depth: int, min_leaf: int, rate: float,
              boosted: bool, bootstrap: int | None = None, random: int | None = None) -> str:
    """Every row's prediction; ``splits`` splits a tree at most, the best gain of all leaves first."""
    n = len(features)
    fs = ", ".join(f"f{j}" for j in range(n))
    ctes = [("repos", REPOS_SQL), *strata, ("p0", f"""
SELECT s.pos, s.split = 'train' AS tr, ln(1 + r.stargazers_count)::DOUBLE AS y, {', '.join(f'coalesce(r.{c}::INT, 0)::DOUBLE AS f{j}' for j, c in enumerate(features))},
       {"avg(CASE WHEN s.split = 'train' THEN ln(1 + r.stargazers_count)::DOUBLE END) OVER ()" if boosted else "0::DOUBLE"} AS f
FROM split s JOIN repos r ON r.pos = s.pos"""),
            ("cuts", "SELECT j, v, (v + lead(v) OVER (PARTITION BY j ORDER BY v)) / 2 AS cut FROM (" + " UNION ALL ".join(
                f"SELECT DISTINCT {j} AS j, f{j} AS v FROM p0 WHERE tr" for j in range(n)) + ")")]
    for t in range(trees):
        w = "1::DOUBLE" if bootstrap is None else _copies(bootstrap + t)
        ctes.append((f"r{t}_0", f"SELECT *, {w} AS w, {'y - f' if boosted else 'y'} AS g, 0 AS node, 0 AS depth, 1::BIGINT AS key FROM p{t}"))
        for k in range(splits):
            rows, name = f"r{t}_{k}", f"{t}_{k}"
            long = " UNION ALL ".join(f"SELECT node, key, {j} AS j, f{j} AS v, w, g FROM {rows} WHERE tr AND w > 0 AND depth < {max_depth}" for j in range(n))
            if random is None:
                ctes.append((f"c{name}", f"""
SELECT node, h.j, cut, sum(n) OVER o AS nl, sum(s) OVER o AS sl, sum(n) OVER a AS nt, sum(s) OVER a AS st
FROM (SELECT node, j, v, sum(w) AS n, sum(w * g) AS s FROM ({long}) GROUP BY node, j, v) h JOIN cuts ON cuts.j = h.j AND cuts.v = h.v
WINDOW o AS (PARTITION BY node, h.j ORDER BY h.v), a AS (PARTITION BY node, h.j)"""))
            else:
                ctes.append((f"l{name}", long))
                ctes.append((f"t{name}", f"""
SELECT node, j, CASE WHEN lo + u * (hi - lo) >= hi THEN lo ELSE lo + u * (hi - lo) END AS cut
FROM (SELECT node, j, min(v) AS lo, max(v) AS hi, {_uniform(str(random + t), 'min(key)', 'j')} AS u FROM l{name} GROUP BY node, j) WHERE lo < hi"""))
                ctes.append((f"c{name}", f"""
SELECT node, j, cut, sum(CASE WHEN v <= cut THEN w ELSE 0 END) AS nl, sum(CASE WHEN v <= cut THEN w * g ELSE 0 END) AS sl, sum(w) AS nt, sum(w * g) AS st
FROM l{name} JOIN t{name} USING (node, j) GROUP BY node, j, cut"""))
            ctes.append((f"g{name}", f"""
SELECT node, j, cut, sl * sl / nl + (st - sl) * (st - sl) / (nt - nl) - st * st / nt AS gain FROM c{name}
WHERE nl >= {min_leaf} AND nt - nl >= {min_leaf}"""))
            ctes.append((f"b{name}", f"""
SELECT node AS b_node, j AS b_j, cut AS b_cut FROM g{name}
WHERE gain > 1e-9 AND gain >= (SELECT max(gain) FROM g{name}) * (1 - 1e-9) ORDER BY node, j, cut LIMIT 1"""))
            value = "CASE b_j " + " ".join(f"WHEN {j} THEN f{j}" for j in range(n)) + " END"
            ctes.append((f"r{t}_{k + 1}", f"""
SELECT pos, tr, y, {fs}, f, w, g, CASE WHEN b_node IS NULL THEN node WHEN {value} <= b_cut THEN {2 * k + 1} ELSE {2 * k + 2} END AS node,
       CASE WHEN b_node IS NULL THEN depth ELSE depth + 1 END AS depth,
       CASE WHEN b_node IS NULL THEN key ELSE (key * 2 + (NOT {value} <= b_cut)::INT) % {P} END AS key
FROM {rows} LEFT JOIN b{name} ON b_node = node"""))
        ctes.append((f"p{t + 1}", f"""
SELECT pos, tr, y, {fs}, f + {rate!r}::DOUBLE * val AS f
FROM r{t}_{splits} JOIN (SELECT node, sum(w * g) / sum(w) AS val FROM r{t}_{splits} WHERE tr AND w > 0 GROUP BY node) USING (node)"""))
    with_ = "WITH " + ",\n".join(f"{name} AS MATERIALIZED ({body})" for name, body in ctes)
    return with_ + f"\nSELECT pos, round(f, 6) + 0 AS log_pred FROM p{trees}"
