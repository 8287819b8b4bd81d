"""DuckDB SQL oracles: for every registered query, an independent ANSI-SQL
statement over the driver's base tables.

Only base tables are registered in the oracle session, so the ``repos``
view (FIXTURES.md F-4) and its derived inputs are inlined as CTEs.  Doubles
are rounded to 6 places on both sides; DuckDB has no log1p/expm1, so
``ln(1 + x)`` / ``exp(x) - 1`` are used.
"""

from __future__ import annotations

AS_OF_SQL = "epoch(strptime('2002-01-01T00:00:00Z', '%Y-%m-%dT%H:%M:%SZ'))"


def _ts(e: str) -> str:
    return f"strftime(make_timestamp(({e}) * 1000000), '%Y-%m-%dT%H:%M:%SZ')"


REPOS_SQL = f"""
SELECT o_orderkey AS pos,
       concat('user', cast(o_custkey AS varchar), '/repo', cast(o_orderkey AS varchar)) AS full_name,
       stars AS stargazers_count,
       stars // (3 + o_custkey % 17) AS forks_count,
       stars // (20 + cents % 31) AS watchers,
       stars // 50 AS open_issues_count,
       stars // 50 + stars // (5 + cents % 7) AS total_issues_count,
       cents % 51 AS open_pulls_count,
       CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE cents % 61 END AS release_count,
       qty % 11 AS topics_count,
       1 + stars // 2 + coalesce(qty, 0) AS commit_count,
       100 + cents % 500000 AS disk_usage,
       CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE n_name END AS language,
       CASE WHEN o_orderstatus = 'P' AND c_mktsegment = 'FURNITURE' THEN NULL
            ELSE lower(concat(c_mktsegment, '-', substr(o_orderpriority, 1, 1), o_orderstatus)) END AS license_key,
       {_ts("day_s + cents % 86400")} AS created_at,
       {_ts("day_s + cents % 86400 + 864000")} AS updated_at,
       CASE WHEN o_orderkey % 13 = 5 THEN NULL ELSE {_ts("day_s + cents % 8640000")} END AS pushed_at,
       o_orderkey % 20 = 0 AS is_archived, false AS is_fork, false AS is_disabled, false AS is_mirror,
       true AS has_issues, o_orderkey % 10 < 7 AS has_wiki, o_orderkey % 2 = 0 AS has_projects,
       o_orderkey % 10 < 3 AS has_discussions,
       repeat('x', cast(cents % 121 AS int)) AS description,
       CASE WHEN o_custkey % 3 = 0 THEN 'Organization' ELSE 'User' END AS owner_type
FROM (
  SELECT *, band_lo + cents % band_lo AS stars FROM (
    SELECT o.*, li.n_lines, li.qty, c.c_mktsegment, n.n_name,
           50 * cast(pow(2, o.o_orderkey % 13) AS bigint) AS band_lo,
           cast(round(o.o_totalprice * 100) AS bigint) AS cents,
           cast(epoch(o.o_orderdate) AS bigint) AS day_s
    FROM orders o
    LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, max(l_partkey) AS partkey,
                      cast(sum(l_quantity) AS bigint) AS qty
               FROM lineitem GROUP BY l_orderkey) li ON li.l_orderkey = o.o_orderkey
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey) base) s
"""


def _days(ts: str) -> str:
    return f"cast(floor(({AS_OF_SQL} - epoch(strptime({ts}, '%Y-%m-%dT%H:%M:%SZ'))) / 86400.0) AS bigint)"


def r6(x: str) -> str:
    return f"round(cast({x} AS double), 6)"


# Feature table columns (P10) as SQL over ``repos``, one expression each.
FEATURES_SQL = f"""
SELECT pos, full_name, stargazers_count,
  coalesce(forks_count, 0) AS forks_count, coalesce(watchers, 0) AS watchers,
  coalesce(open_issues_count, 0) AS open_issues_count, coalesce(total_issues_count, 0) AS total_issues_count,
  coalesce(open_pulls_count, 0) AS open_pulls_count, coalesce(release_count, 0) AS release_count,
  coalesce(commit_count, 0) AS commit_count, coalesce(topics_count, 0) AS topics_count,
  coalesce(disk_usage, 0) AS disk_usage,
  cast(length(coalesce(description, '')) AS bigint) AS description_length,
  cast(length(coalesce(full_name, '')) AS bigint) AS name_length,
  cast(0 AS bigint) AS contributor_count,
  cast(coalesce(is_archived, false) AS int) AS is_archived, cast(coalesce(is_fork, false) AS int) AS is_fork,
  cast(coalesce(is_disabled, false) AS int) AS is_disabled, cast(coalesce(is_mirror, false) AS int) AS is_mirror,
  cast(coalesce(has_issues, false) AS int) AS has_issues, cast(coalesce(has_wiki, false) AS int) AS has_wiki,
  cast(coalesce(has_projects, false) AS int) AS has_projects,
  cast(coalesce(has_discussions, false) AS int) AS has_discussions,
  cast(coalesce(license_key, '') <> '' AS int) AS has_license,
  cast(coalesce(owner_type = 'Organization', false) AS int) AS owner_is_org,
  {_days("created_at")} AS age_days,
  {_days("coalesce(nullif(pushed_at, ''), created_at)")} AS days_since_push,
  {_days("coalesce(nullif(updated_at, ''), created_at)")} AS days_since_update,
  coalesce(nullif(language, ''), 'unknown') AS language,
  coalesce(nullif(license_key, ''), 'none') AS license_key
FROM repos
"""

RATES_SQL = """
SELECT *,
  commit_count / greatest(age_days, 1) AS commits_per_day,
  commit_count / greatest(age_days / 365.0, 1 / 365.0) AS commits_per_year,
  total_issues_count / greatest(age_days, 1) AS issues_per_day,
  open_issues_count / greatest(total_issues_count, 1) AS open_issue_ratio,
  forks_count / greatest(age_days, 1) AS forks_per_day,
  release_count / greatest(age_days / 365.0, 1 / 365.0) AS releases_per_year,
  ln(1 + forks_count) AS log_forks_count, ln(1 + commit_count) AS log_commit_count,
  ln(1 + open_issues_count) AS log_open_issues_count, ln(1 + total_issues_count) AS log_total_issues_count,
  ln(1 + disk_usage) AS log_disk_usage
FROM feats0
"""

INT_FEATURES = [
    "forks_count", "watchers", "open_issues_count", "total_issues_count", "open_pulls_count",
    "release_count", "commit_count", "topics_count", "disk_usage", "description_length", "name_length",
    "contributor_count", "is_archived", "is_fork", "is_disabled", "is_mirror", "has_issues", "has_wiki",
    "has_projects", "has_discussions", "has_license", "owner_is_org", "age_days", "days_since_push",
    "days_since_update",
]
DOUBLE_FEATURES = [
    "commits_per_day", "commits_per_year", "issues_per_day", "open_issue_ratio", "forks_per_day",
    "releases_per_year", "log_forks_count", "log_commit_count", "log_open_issues_count",
    "log_total_issues_count", "log_disk_usage",
]


def with_ctes(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ctes)


BASE_CTES = [("repos", REPOS_SQL), ("feats0", FEATURES_SQL), ("feats", RATES_SQL)]


def base(*more: tuple[str, str]) -> str:
    return with_ctes(*BASE_CTES, *more)


def feature_select(prefix: str = "") -> str:
    p = prefix
    return ", ".join([f"{p}{c} AS {c}" for c in INT_FEATURES] + [f"{r6(p + c)} AS {c}" for c in DOUBLE_FEATURES])
