"""Oracle SQL per registered query (see ``velorank.oracles`` for the CTEs)."""

from __future__ import annotations

from velorank.oracle_trees import trees_sql
from velorank.oracles import base, feature_select

ORACLES: dict[str, str] = {}

ORACLES["feature_table"] = base() + f"""
SELECT pos, full_name, stargazers_count, {feature_select()}, language, license_key FROM feats
"""

from velorank.oracles import DOUBLE_FEATURES, INT_FEATURES, REPOS_SQL, r6, with_ctes  # noqa: E402
from velorank.sources.schema import REPO_COLUMNS  # noqa: E402


def _subset(cols):
    parts = [f"{r6(c)} AS {c}" if c in DOUBLE_FEATURES else c for c in cols]
    return base() + f"SELECT pos, {', '.join(parts)} FROM feats"


_NUM, _BOOL = INT_FEATURES[:12], INT_FEATURES[12:22]

ORACLES["text_lengths"] = _subset(["description_length", "name_length"])
ORACLES["flags"] = _subset(_BOOL)
ORACLES["numeric_defaults"] = _subset(_NUM)
ORACLES["days_since"] = _subset(["age_days", "days_since_push", "days_since_update"])
ORACLES["rates"] = _subset(["commits_per_day", "commits_per_year", "issues_per_day", "open_issue_ratio",
                            "forks_per_day", "releases_per_year"])
ORACLES["log_features"] = _subset(["log_forks_count", "log_commit_count", "log_open_issues_count",
                                   "log_total_issues_count", "log_disk_usage"])

ORACLES["target_transform"] = with_ctes(("repos", REPOS_SQL)) + f"""
SELECT pos, {r6("ln(1 + stargazers_count)")} AS log_target,
       {r6("greatest(exp(ln(1 + stargazers_count)) - 1, 0)")} AS star_back FROM repos"""

ORACLES["last_page_number"] = """
SELECT page_id,
       coalesce(try_cast(nullif(regexp_extract(regexp_replace(url, '#.*$', ''), '.*page=([^&]*)', 1), '')
                         AS BIGINT), 1) AS last_page
FROM pages"""

ORACLES["enrich_counts"] = with_ctes(("repos", REPOS_SQL)) + """
SELECT r.pos, coalesce(c.n, 0) AS contributor_count
FROM repos r LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) c
  ON c.l_orderkey = r.pos"""

def _align_sql():
    return base(*BUCKET_CTES) + f"""
SELECT f.pos, f.commit_count, f.forks_count,
       CASE WHEN b.language = 'NATION_0' THEN 1 ELSE 0 END AS language_NATION_0,
       CASE WHEN b.language = 'NATION_1' THEN 1 ELSE 0 END AS language_NATION_1,
       0 AS language_NATION_99,
       {r6("f.log_forks_count")} AS log_forks_count
FROM feats f JOIN bl b ON b.pos = f.pos"""

_TS = "'%Y-%m-%dT%H:%M:%SZ'"
ORACLES["quarantine"] = with_ctes(("repos", REPOS_SQL), ("broken", """
SELECT pos, CASE WHEN pos % 19 = 0 THEN NULL ELSE full_name END AS full_name, stargazers_count,
       CASE WHEN pos % 17 = 0 THEN replace(created_at, 'T', ' ') ELSE created_at END AS created_at,
       updated_at,
       CASE WHEN pos % 29 = 0 THEN 'not-a-date' ELSE pushed_at END AS pushed_at
FROM repos""")) + f"""
SELECT pos, CASE
  WHEN full_name IS NULL OR full_name = '' THEN 'missing full_name'
  WHEN stargazers_count IS NULL THEN 'missing stargazers_count'
  WHEN created_at IS NULL THEN 'missing created_at'
  WHEN try_strptime(created_at, {_TS}) IS NULL THEN 'bad created_at'
  WHEN updated_at IS NOT NULL AND updated_at <> '' AND try_strptime(updated_at, {_TS}) IS NULL THEN 'bad updated_at'
  WHEN pushed_at IS NOT NULL AND pushed_at <> '' AND try_strptime(pushed_at, {_TS}) IS NULL THEN 'bad pushed_at'
  ELSE 'ok' END AS reason
FROM broken"""

ORACLES["missing_cells"] = with_ctes(("repos", REPOS_SQL)) + "SELECT cast(" + " + ".join(
    f"sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)" for c in ["pos", *REPO_COLUMNS]) + " AS BIGINT) AS n_missing FROM repos"


def _top(col: str, k: int) -> str:
    return f"""SELECT {col}, n, row_number() OVER (ORDER BY n DESC, first_pos) AS rnk
FROM (SELECT {col}, count(*) AS n, min(pos) AS first_pos FROM feats GROUP BY {col})
ORDER BY n DESC, first_pos LIMIT {k}"""


ORACLES["top_languages"] = base() + _top("language", 20)
ORACLES["top_licenses"] = base() + _top("license_key", 15)

BUCKET_CTES = [
    ("tl", _top("language", 20)),
    ("tlic", _top("license_key", 15)),
    ("bl", """SELECT pos,
  CASE WHEN language IN (SELECT language FROM tl) THEN language ELSE 'other' END AS language,
  CASE WHEN license_key IN (SELECT license_key FROM tlic) THEN license_key ELSE 'other' END AS license_key
FROM feats"""),
]

ORACLES["rare_bucket"] = base(*BUCKET_CTES) + "SELECT pos, language, license_key FROM bl"

ORACLES["one_hot"] = base(*BUCKET_CTES, ("vocab", """
SELECT DISTINCT 'language' AS col, language AS v FROM bl
UNION ALL SELECT DISTINCT 'license_key' AS col, license_key AS v FROM bl""")) + """
SELECT b.pos, concat(vocab.col, '_', vocab.v) AS feature,
       CASE WHEN (vocab.col = 'language' AND b.language = vocab.v)
              OR (vocab.col = 'license_key' AND b.license_key = vocab.v) THEN 1 ELSE 0 END AS value
FROM bl b CROSS JOIN vocab"""

BANDS_SQL = """
SELECT cast(i AS INTEGER) AS band, 50 * cast(pow(2, i) AS BIGINT) AS lo,
       CASE WHEN i < 11 THEN 50 * cast(pow(2, i + 1) AS BIGINT) - 1 END AS hi,
       concat(cast(50 * cast(pow(2, i) AS BIGINT) AS VARCHAR), '_',
              CASE WHEN i < 11 THEN cast(50 * cast(pow(2, i + 1) AS BIGINT) - 1 AS VARCHAR) ELSE 'max' END) AS label
FROM range(12) t(i)"""

BANDED_SQL = """SELECT r.*, b.band, b.lo, b.hi, b.label FROM repos r
JOIN bands b ON r.stargazers_count >= b.lo AND (b.hi IS NULL OR r.stargazers_count <= b.hi)"""

ORACLES["band_join"] = with_ctes(("repos", REPOS_SQL), ("bands", BANDS_SQL), ("banded", BANDED_SQL)) + \
    "SELECT pos, stargazers_count, band, lo, hi, label FROM banded"

ORACLES["band_intervals"] = with_ctes(("repos", REPOS_SQL), ("b", """
SELECT c_custkey AS band, cast(floor(abs(c_acctbal) * 7) AS BIGINT) AS lo,
       CASE WHEN c_custkey % 500 <> 0 THEN cast(floor(abs(c_acctbal) * 7) AS BIGINT) + (c_custkey % 20) * (c_custkey % 20) END AS hi
FROM customer""")) + """
SELECT b.band, b.lo, cast(b.hi AS BIGINT) AS hi, count(r.pos) AS n, cast(coalesce(sum(r.stargazers_count), 0) AS BIGINT) AS stars
FROM b LEFT JOIN repos r ON r.stargazers_count >= b.lo AND r.stargazers_count <= coalesce(b.hi, 9223372036854775807)
GROUP BY b.band, b.lo, b.hi"""

ORACLES["band_filter"] = with_ctes(("repos", REPOS_SQL)) + \
    "SELECT pos, stargazers_count FROM repos WHERE stargazers_count BETWEEN 1600 AND 3199"

ORACLES["band_quota"] = with_ctes(("repos", REPOS_SQL), ("bands", BANDS_SQL), ("banded", BANDED_SQL)) + """
SELECT pos, stargazers_count, band, rank_in_band FROM (
  SELECT pos, stargazers_count, band,
         row_number() OVER (PARTITION BY band ORDER BY stargazers_count DESC, pos) AS rank_in_band
  FROM banded) WHERE rank_in_band <= 416"""

ORACLES["band_counts"] = with_ctes(("repos", REPOS_SQL), ("bands", BANDS_SQL), ("banded", BANDED_SQL)) + """
SELECT b.band, b.lo, b.hi, b.label, coalesce(c.n, 0) AS n
FROM bands b LEFT JOIN (SELECT band, count(*) AS n FROM banded GROUP BY band) c ON c.band = b.band"""

DUPS_SQL = """
SELECT * FROM repos
UNION ALL
SELECT pos + 1000000000 AS pos, full_name, stargazers_count * 2 + 1 AS stargazers_count,
       forks_count + 1 AS forks_count, watchers, open_issues_count, total_issues_count, open_pulls_count,
       release_count, topics_count, commit_count, disk_usage, language, license_key, created_at,
       updated_at, pushed_at, is_archived, is_fork, is_disabled, is_mirror, has_issues, has_wiki,
       has_projects, has_discussions, description, owner_type
FROM repos WHERE pos % 10 = 0"""

SHARDED_SQL = """SELECT d.*, concat('repos_', b.label, '.jsonl') AS shard FROM dups d
JOIN bands b ON d.stargazers_count >= b.lo AND (b.hi IS NULL OR d.stargazers_count <= b.hi)"""

SHARD_CTES = [("repos", REPOS_SQL), ("bands", BANDS_SQL), ("dups", DUPS_SQL), ("sharded", SHARDED_SQL)]

ORACLES["dedupe_first"] = with_ctes(*SHARD_CTES) + """
SELECT pos, full_name, stargazers_count, forks_count FROM (
  SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY shard, pos) AS rn FROM sharded) WHERE rn = 1"""

ORACLES["scan_shards"] = with_ctes(*SHARD_CTES) + """
SELECT pos, full_name, shard, row_number() OVER (ORDER BY shard, pos) AS line_no FROM sharded"""

ORACLES["merge_shards"] = with_ctes(*SHARD_CTES, ("a", """
SELECT r.pos, r.full_name, r.stargazers_count, c.n AS contributor_count, 0 AS src,
       concat('repos_', b.label, '.jsonl') AS shard
FROM repos r
JOIN bands b ON r.stargazers_count >= b.lo AND (b.hi IS NULL OR r.stargazers_count <= b.hi)
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) c ON c.l_orderkey = r.pos
WHERE r.pos % 3 = 0"""), ("allrows", """
SELECT pos, full_name, stargazers_count, contributor_count, src, shard FROM a
UNION ALL
SELECT pos, full_name, stargazers_count, NULL AS contributor_count, 1 AS src, shard FROM sharded""")) + """
SELECT pos, full_name, stargazers_count, contributor_count FROM (
  SELECT *, row_number() OVER (PARTITION BY full_name ORDER BY src, shard, pos) AS rn FROM allrows) WHERE rn = 1"""

ORACLES["scan_jsonl"] = with_ctes(("repos", REPOS_SQL)) + f"SELECT pos, {', '.join(REPO_COLUMNS)} FROM repos"

FLAT_SQL = """SELECT pos, full_name, stargazers_count, forks_count, watchers, open_issues_count,
  total_issues_count, open_pulls_count, release_count, topics_count,
  CASE WHEN pos % 7 = 0 THEN 0 ELSE commit_count END AS commit_count,
  CASE WHEN pos % 5 = 0 THEN 0 ELSE coalesce(disk_usage, 0) END AS disk_usage,
  language, license_key, created_at, updated_at,
  coalesce(nullif(pushed_at, ''), nullif(updated_at, ''), created_at) AS pushed_at,
  is_archived, is_fork, is_disabled, is_mirror, has_issues, has_wiki, has_projects, has_discussions,
  coalesce(description, '') AS description, owner_type
FROM repos"""

ORACLES["flatten_nodes"] = with_ctes(("repos", REPOS_SQL)) + FLAT_SQL

ORACLES["pages_to_rows"] = with_ctes(("repos", REPOS_SQL), ("bands", BANDS_SQL), ("flat", FLAT_SQL)) + f"""
SELECT query, {', '.join(REPO_COLUMNS)} FROM (
  SELECT f.*, CASE WHEN b.hi IS NULL THEN concat('stars:>=', cast(b.lo AS VARCHAR))
                   ELSE concat('stars:', cast(b.lo AS VARCHAR), '..', cast(b.hi AS VARCHAR)) END AS query,
         row_number() OVER (PARTITION BY b.band ORDER BY f.stargazers_count DESC, f.pos) AS rn
  FROM flat f
  JOIN bands b ON f.stargazers_count >= b.lo AND (b.hi IS NULL OR f.stargazers_count <= b.hi)
  WHERE f.pos % 23 <> 0) WHERE rn <= 416"""

# ------------------------------------------------------------ rank / split
STRATA_CTES = [
    ("ranked", """SELECT pos, full_name, stargazers_count,
       row_number() OVER (ORDER BY stargazers_count, pos) AS r, count(*) OVER () AS n FROM repos"""),
    ("strata", """SELECT pos, full_name, stargazers_count,
       cast(CASE WHEN n < 2 THEN 0 ELSE greatest((5 * (r - 1) + (n - 2)) // (n - 1) - 1, 0) END AS INTEGER) AS bucket
FROM ranked"""),
    ("cnt", "SELECT bucket, count(*) AS c FROM strata GROUP BY bucket"),
    ("tot", "SELECT sum(c) AS n, sum(c) - cast(ceil(0.2::DOUBLE * sum(c)) AS BIGINT) AS n_train FROM cnt"),
    ("q0", "SELECT bucket, c / n * n_train AS cont, floor(c / n * n_train) AS fl, n_train FROM cnt, tot"),
    ("q1", """SELECT bucket, fl, row_number() OVER (ORDER BY cont - fl DESC, bucket) AS rr,
       n_train - sum(fl) OVER () AS need FROM q0"""),
    ("quota", "SELECT bucket, cast(fl AS BIGINT) + CASE WHEN rr <= need THEN 1 ELSE 0 END AS quota FROM q1"),
    ("split", """SELECT s.pos, s.full_name, s.stargazers_count, s.bucket,
       CASE WHEN row_number() OVER (PARTITION BY s.bucket ORDER BY md5(concat(s.full_name, ':0')), s.full_name)
                 <= q.quota THEN 'train' ELSE 'test' END AS split
FROM strata s JOIN quota q ON q.bucket = s.bucket"""),
]

ORACLES["global_rank"] = with_ctes(("repos", REPOS_SQL)) + \
    "SELECT pos, stargazers_count, row_number() OVER (ORDER BY stargazers_count, pos) AS rank FROM repos"
ORACLES["rank_buckets"] = with_ctes(("repos", REPOS_SQL), *STRATA_CTES[:2]) + "SELECT pos, bucket FROM strata"
ORACLES["stratified_split"] = with_ctes(("repos", REPOS_SQL), *STRATA_CTES) + "SELECT pos, bucket, split FROM split"
ORACLES["fold_ids"] = with_ctes(("repos", REPOS_SQL), *STRATA_CTES, ("tr", """
SELECT pos, row_number() OVER (ORDER BY md5(concat(full_name, ':0')), full_name) - 1 AS r0, count(*) OVER () AS n
FROM split WHERE split = 'train'""")) + """
SELECT pos, cast(CASE WHEN r0 < (n % 5) * (n // 5 + 1) THEN r0 // (n // 5 + 1)
                      ELSE (n % 5) + (r0 - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold
FROM tr"""
ORACLES["stride_sample"] = with_ctes(("repos", REPOS_SQL), ("r", """
SELECT pos, full_name, row_number() OVER (ORDER BY pos) - 1 AS r0 FROM repos"""),
    ("cnt", "SELECT count(*) AS n FROM repos"), ("idx", """
SELECT DISTINCT cast(floor(i * (cnt.n::DOUBLE / 1000)) AS BIGINT) AS r0 FROM range(1000) t(i), cnt""")) + """
SELECT pos, full_name FROM r WHERE (SELECT n FROM cnt) <= 1000 OR r0 IN (SELECT r0 FROM idx)"""

# ------------------------------------------------------------------ dataset

_NUMERIC_NAMES = ",".join(INT_FEATURES + DOUBLE_FEATURES)

ORACLES["build_dataset"] = base(*BUCKET_CTES, *STRATA_CTES) + f"""
SELECT f.pos, f.full_name, sp.split, sp.bucket, f.stargazers_count, {feature_select('f.')},
       concat('language_', bl.language) AS language_col, concat('license_key_', bl.license_key) AS license_col
FROM feats f JOIN split sp ON sp.pos = f.pos JOIN bl ON bl.pos = f.pos"""

ORACLES["dataset_roundtrip"] = with_ctes(("repos", REPOS_SQL), *STRATA_CTES) + \
    "SELECT pos, full_name, split, bucket, stargazers_count FROM split WHERE split = 'test'"

ORACLES["feature_schema"] = base(*BUCKET_CTES, *STRATA_CTES) + f"""
SELECT 'stargazers_count' AS target,
  cast(36 + (SELECT count(DISTINCT language) FROM bl) + (SELECT count(DISTINCT license_key) FROM bl) AS BIGINT)
    AS n_columns,
  concat('{_NUMERIC_NAMES}', ',',
         (SELECT string_agg(concat('language_', v), ',' ORDER BY v) FROM (SELECT DISTINCT language AS v FROM bl)),
         ',',
         (SELECT string_agg(concat('license_key_', v), ',' ORDER BY v)
          FROM (SELECT DISTINCT license_key AS v FROM bl))) AS feature_columns,
  concat((SELECT string_agg(language, ',' ORDER BY rnk) FROM tl), ',other') AS top_langs,
  concat((SELECT string_agg(license_key, ',' ORDER BY rnk) FROM tlic), ',other') AS top_licenses,
  false AS uses_contributors,
  (SELECT cast(count(*) FILTER (WHERE split = 'train') AS BIGINT) FROM split) AS n_train,
  (SELECT cast(count(*) FILTER (WHERE split = 'test') AS BIGINT) FROM split) AS n_test"""

# ---------------------------------------------------------------- metrics
def _r2(ssr: str, sst: str) -> str:
    return f"CASE WHEN {sst} = 0 THEN CASE WHEN {ssr} = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - {ssr} / {sst} END"


ORACLES["metrics"] = with_ctes(("repos", REPOS_SQL), ("p", """
SELECT pos, stargazers_count::DOUBLE AS y, ln(1 + forks_count * 10.0::DOUBLE) AS lp FROM repos"""),
    ("q", "SELECT *, greatest(exp(lp) - 1, 0) AS sp, ln(1 + y) AS lt FROM p"),
    ("e", "SELECT *, abs(sp - y) / greatest(y, 1) * 100 AS ape FROM q"),
    ("a", """SELECT sum(pow(lt - lp, 2)) AS ssr_log, var_pop(lt) * count(*) AS sst_log,
       sum(pow(y - sp, 2)) AS ssr_star, var_pop(y) * count(*) AS sst_star,
       avg(abs(sp - y)) AS mae_star, sqrt(avg(pow(sp - y, 2))) AS rmse_star,
       quantile_cont(ape, 0.5) AS median_ape FROM e""")) + f"""
SELECT {r6(_r2("ssr_log", "sst_log"))} AS r2_log, {r6(_r2("ssr_star", "sst_star"))} AS r2_star,
       {r6("mae_star")} AS mae_star, {r6("rmse_star")} AS rmse_star, {r6("median_ape")} AS median_ape FROM a"""

TRIALS_SQL = """
SELECT ['LinearRegression', 'Ridge', 'RandomForest', 'ExtraTrees', 'GradientBoosting',
        'HistGradientBoosting'][pos % 6 + 1] AS model_name,
       concat(['LinearRegression', 'Ridge', 'RandomForest', 'ExtraTrees', 'GradientBoosting',
               'HistGradientBoosting'][pos % 6 + 1], '_', substr(sha1(full_name), 1, 12)) AS config_id,
       CASE WHEN pos % 97 = 0 THEN 'NaN'::DOUBLE
            ELSE (stargazers_count % 1000)::DOUBLE / 1000.0::DOUBLE END AS cv_r2
FROM repos"""

ORACLES["best_per_model"] = with_ctes(("repos", REPOS_SQL), ("t", TRIALS_SQL)) + f"""
SELECT model_name, config_id, {r6("cv_r2")} AS cv_r2 FROM (
  SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY isnan(cv_r2), cv_r2 DESC, config_id) AS rn
  FROM t) WHERE rn = 1"""

ORACLES["best_overall"] = with_ctes(("repos", REPOS_SQL), ("t", TRIALS_SQL)) + f"""
SELECT model_name, config_id, {r6("cv_r2")} AS cv_r2 FROM t
ORDER BY isnan(cv_r2), cv_r2 DESC, config_id LIMIT 1"""

ORACLES["cv_mean"] = with_ctes(("repos", REPOS_SQL), ("f", r"""
SELECT concat('cfg_', regexp_extract(full_name, '^user(\d+)/', 1)) AS config_id,
       (stargazers_count % 1000)::DOUBLE / 1000.0::DOUBLE AS r2_fold FROM repos""")) + f"""
SELECT config_id, {r6("avg(r2_fold)")} AS cv_r2, count(*) AS n_folds FROM f GROUP BY config_id"""

ORACLES["relative_to_first"] = with_ctes(("y", """
SELECT cast(year(l_shipdate) AS BIGINT) AS ship_year, count(*) AS n_lines, sum(l_quantity) AS quantity
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1""")) + f"""
SELECT ship_year, n_lines, {r6("quantity")} AS quantity,
       {r6("first_value(quantity * n_lines) OVER (ORDER BY ship_year ROWS BETWEEN UNBOUNDED PRECEDING "
           "AND UNBOUNDED FOLLOWING) / quantity")} AS ratio
FROM y"""

ORACLES["ranked_report"] = with_ctes(("repos", REPOS_SQL), ("inp", """
SELECT pos, concat_ws('-', full_name, coalesce(language, 'unknown'), coalesce(license_key, 'none')) AS name,
       forks_count * 10.5::DOUBLE AS pred_stars FROM repos"""),
    ("st", "SELECT least(max(length(name)), 40) AS w, max(pred_stars) AS top FROM inp")) + """
SELECT row_number() OVER (ORDER BY pred_stars DESC, pos) AS rank, pos,
       CASE WHEN length(name) <= w THEN name ELSE concat(substr(name, 1, w - 1), '…') END AS name,
       format('{:,}', cast(trunc(pred_stars) AS BIGINT)) AS value_str,
       repeat('█', cast(greatest(1, round_even(18.0::DOUBLE * pred_stars /
                                               (CASE WHEN top = 0 THEN 1 ELSE top END), 0)) AS INTEGER)) AS bar
FROM inp, st"""

ORACLES["pred_vs_actual"] = with_ctes(("repos", REPOS_SQL), ("p", """
SELECT pos, stargazers_count, ln(1 + forks_count * 10.0::DOUBLE) AS lp FROM repos"""), ("q", """
SELECT pos, stargazers_count, greatest(exp(lp) - 1, 1) AS pred_stars,
       greatest(stargazers_count::DOUBLE, 1) AS actual_stars FROM p""")) + f"""
SELECT pos, stargazers_count, {r6("pred_stars")} AS pred_stars, {r6("actual_stars")} AS actual_stars,
       {r6("greatest((SELECT max(pred_stars) FROM q), (SELECT max(stargazers_count) FROM q))")} AS axis_max
FROM q"""

ORACLES["content_key"] = with_ctes(("repos", REPOS_SQL)) + """
SELECT pos, concat('repo_', substr(sha1(concat('{"full_name": "', full_name, '", "model_name": "repo", ',
                                                '"stargazers_count": ', cast(stargazers_count AS VARCHAR), '}')),
                                   1, 12)) AS content_key
FROM repos"""

_STD = ["forks_count", "commit_count", "disk_usage", "is_fork"]
ORACLES["standardize"] = base(("st", "SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _STD) + " FROM feats")) + "SELECT pos, " + ", ".join(
    r6(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1 ELSE s_{c} END") + f" AS {c}" for c in _STD
) + " FROM feats, st"

ORACLES["incremental_ingest"] = ORACLES["dedupe_first"]
ORACLES["incremental_ingest_batches"] = ORACLES["dedupe_first"]

# ------------------------------------------------- rank, ingest and artifacts
ORACLES["top_n_by_language"] = with_ctes(("repos", REPOS_SQL)) + """
SELECT pos, language, stargazers_count, rank_in_language FROM (
  SELECT pos, language, stargazers_count,
         row_number() OVER (PARTITION BY language ORDER BY stargazers_count DESC, pos) AS rank_in_language
  FROM repos) WHERE rank_in_language <= 1500"""

ORACLES["rank_in_group"] = with_ctes(("repos", REPOS_SQL), ("g", """
SELECT pos, stargazers_count,
       CASE WHEN pos % 10 <> 0 THEN split_part(full_name, '/', 1) END AS owner FROM repos""")) + """
SELECT pos, owner, row_number() OVER (PARTITION BY owner ORDER BY stargazers_count DESC, pos) AS rank FROM g"""

ORACLES["trials_latest"] = with_ctes(("repos", REPOS_SQL), ("t", TRIALS_SQL)) + \
    f"SELECT model_name, config_id, {r6('cv_r2')} AS cv_r2 FROM t"

ORACLES["page_chain"] = with_ctes(("repos", REPOS_SQL), ("bands", BANDS_SQL), ("c", """
SELECT b.lo, b.hi, count(*) AS n FROM repos r
JOIN bands b ON r.stargazers_count >= b.lo AND (b.hi IS NULL OR r.stargazers_count <= b.hi) GROUP BY b.lo, b.hi"""),
    ("every", """
SELECT CASE WHEN hi IS NULL THEN concat('stars:>=', cast(lo AS VARCHAR))
            ELSE concat('stars:', cast(lo AS VARCHAR), '..', cast(hi AS VARCHAR)) END AS query,
       (n + 39) // 40 - 1 AS last_page, unnest(range((n + 39) // 40)) AS page_no FROM c"""),
    ("p", """
SELECT query, page_no, page_no < last_page AND page_no % 11 <> 7 AS has_next, page_no % 10 = 2 AS twice,
       CASE WHEN page_no % 11 <> 7 AND page_no % 8 >= 6 THEN 'stuck' ELSE cast(page_no AS VARCHAR) END AS cursor
FROM every WHERE page_no % 9 <> 4"""),
    ("j", """
SELECT p.*, prev.page_no IS NOT NULL AS has_prev, prev.has_next AS prev_next, prev.cursor AS prev_cursor,
       nxt.page_no IS NOT NULL AS has_nxt
FROM p LEFT JOIN p prev ON prev.query = p.query AND prev.page_no = p.page_no - 1
       LEFT JOIN p nxt ON nxt.query = p.query AND nxt.page_no = p.page_no + 1""")) + """
SELECT query, page_no, 'repeated' AS fault FROM j WHERE twice
UNION ALL SELECT query, page_no, 'no successor' FROM j WHERE has_next AND NOT has_nxt
UNION ALL SELECT query, page_no, 'no predecessor' FROM j WHERE page_no > 0 AND NOT has_prev
UNION ALL SELECT query, page_no, 'after the end' FROM j WHERE has_prev AND NOT prev_next
UNION ALL SELECT query, page_no, 'same cursor' FROM j WHERE has_next AND cursor = prev_cursor"""

ORACLES["pages_quarantine"] = with_ctes(("repos", REPOS_SQL), ("bands", BANDS_SQL), ("c", """
SELECT b.lo, b.hi, count(*) AS n FROM repos r
JOIN bands b ON r.stargazers_count >= b.lo AND (b.hi IS NULL OR r.stargazers_count <= b.hi) GROUP BY b.lo, b.hi"""),
    ("p", """
SELECT CASE WHEN hi IS NULL THEN concat('stars:>=', cast(lo AS VARCHAR))
            ELSE concat('stars:', cast(lo AS VARCHAR), '..', cast(hi AS VARCHAR)) END AS query,
       cast(unnest(range((n + 39) // 40)) AS INTEGER) AS page_no FROM c""")) + """
SELECT query, page_no, CASE WHEN page_no % 7 = 3 THEN 'unreadable page' WHEN page_no % 11 = 5 THEN 'errors: timeout'
                            ELSE 'empty page' END AS reason
FROM p WHERE page_no % 7 = 3 OR page_no % 11 = 5 OR page_no % 13 = 6"""

ORACLES["null_fill"] = with_ctes(("repos", REPOS_SQL)) + """
SELECT pos, coalesce(CASE WHEN pos % 3 <> 0 THEN forks_count END, 0) AS forks_count,
       coalesce(CASE WHEN pos % 5 <> 0 THEN watchers END, 0) AS watchers, coalesce(release_count, 0) AS release_count
FROM repos"""

ORACLES["timing_ratio"] = with_ctes(("y", """
SELECT cast(year(l_shipdate) AS DOUBLE) AS workers, sum(l_quantity)::DOUBLE AS seconds
FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1""")) + f"""
SELECT workers, {r6("seconds")} AS seconds,
       {r6("first_value(seconds * workers) OVER (ORDER BY workers ROWS BETWEEN UNBOUNDED PRECEDING "
           "AND UNBOUNDED FOLLOWING) / seconds")} AS ratio FROM y"""

ORACLES["guarded_write"] = with_ctes(("repos", REPOS_SQL)) + """
SELECT kind, cast(n AS BIGINT) AS n_lines, refused FROM (
  SELECT 'marked' AS kind, count(*) FILTER (WHERE pos % 2 = 0) AS n, false AS refused FROM repos
  UNION ALL SELECT 'plain', count(*) FILTER (WHERE pos % 2 = 1), true FROM repos)"""

# ------------------------------------------------------------------ models
# One feature x = ln(1 + forks), label y = ln(1 + stars): the scaled ridge fit in closed form.
_XY = ("xy", """SELECT s.pos, s.full_name, s.split, ln(1 + r.forks_count)::DOUBLE AS x, ln(1 + s.stargazers_count)::DOUBLE AS y,
       s.stargazers_count FROM split s JOIN repos r ON r.pos = s.pos""")
_FOLDED = ("folded", """
SELECT *, CASE WHEN r0 < (n % 5) * (n // 5 + 1) THEN r0 // (n // 5 + 1)
               ELSE (n % 5) + (r0 - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold
FROM (SELECT *, row_number() OVER (ORDER BY md5(concat(full_name, ':0')), full_name) - 1 AS r0, count(*) OVER () AS n
      FROM xy WHERE split = 'train')""")
_MODEL_BASE = [("repos", REPOS_SQL), *STRATA_CTES, _XY]


def _coef(where: str, alpha: str) -> str:
    """n, mean x, slope and intercept of the fit on some rows."""
    return (f"SELECT avg(x) AS mx, var_pop(x) AS vx, avg(y) AS my, count(*) * covar_pop(x, y) / "
            f"(CASE WHEN {alpha} = 0 THEN count(*) * var_pop(x) ELSE (count(*) + {alpha}) * var_pop(x) END) AS beta "
            f"FROM {where}")


def _one_feature(alpha: str) -> str:
    return with_ctes(*_MODEL_BASE, ("tr", "SELECT * FROM xy WHERE split = 'train'"), ("fit", _coef("tr", alpha))) + f"""
SELECT pos, {r6("my + beta * (x - mx)")} AS log_pred, round(greatest(exp(my + beta * (x - mx)) - 1, 0)::DOUBLE, 2) AS predicted_stars
FROM xy, fit"""


ORACLES["linear_one_feature"] = _one_feature("0")
ORACLES["ridge_one_feature"] = _one_feature("1.0")


def _configs() -> str:
    """The linear families' grid as rows (config id from the stated format)."""
    import hashlib
    import json
    rows = []
    for name, alpha in [("LinearRegression", None)] + [("Ridge", a) for a in (0.01, 0.1, 1.0, 10.0, 100.0)]:
        cfg = {"model_name": name} | ({} if alpha is None else {"alpha": alpha})
        key = hashlib.sha1(json.dumps(cfg, sort_keys=True).encode()).hexdigest()[:12]
        rows.append(f"('{name}', '{name}_{key}', {alpha or 0.0}::DOUBLE)")
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ") t(model_name, config_id, alpha)"


_CV_CTES = [*_MODEL_BASE, _FOLDED, ("cfg", _configs()), ("fits", """
SELECT c.model_name, c.config_id, k.fold, avg(f.x) AS mx, avg(f.y) AS my,
       count(*) * covar_pop(f.x, f.y) / ((count(*) + c.alpha) * var_pop(f.x)) AS beta
FROM cfg c, (SELECT DISTINCT fold FROM folded) k JOIN folded f ON f.fold <> k.fold
GROUP BY c.model_name, c.config_id, c.alpha, k.fold"""), ("r2", """
SELECT t.model_name, t.config_id, t.fold,
       1 - sum(pow(f.y - (my + beta * (f.x - mx)), 2)) / (var_pop(f.y) * count(*)) AS r2
FROM fits t JOIN folded f ON f.fold = t.fold GROUP BY t.model_name, t.config_id, t.fold"""), ("cv", """
SELECT model_name, config_id, avg(r2) AS cv_r2 FROM r2 GROUP BY model_name, config_id""")]
ORACLES["linear_cv_scores"] = with_ctes(*_CV_CTES) + f"SELECT model_name, config_id, {r6('cv_r2')} AS cv_r2 FROM cv"
ORACLES["accuracy_table"] = with_ctes(*_CV_CTES, ("best", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_name ORDER BY round(cv_r2, 12) DESC, config_id) AS rn FROM cv) WHERE rn = 1"""),
    ("refit", """
SELECT b.model_name, b.cv_r2, avg(f.x) AS mx, avg(f.y) AS my,
       count(*) * covar_pop(f.x, f.y) / ((count(*) + c.alpha) * var_pop(f.x)) AS beta
FROM best b JOIN cfg c ON c.config_id = b.config_id, folded f GROUP BY b.model_name, b.cv_r2, c.alpha"""),
    ("scored", "SELECT model_name, cv_r2, y, my + beta * (x - mx) AS p FROM refit, xy WHERE split = 'test'")) + f"""
SELECT model_name, {r6("max(cv_r2)")} AS cv_r2, {r6("1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*))")} AS r2_log
FROM scored GROUP BY model_name"""
ORACLES["ranked_scores"] = with_ctes(*_MODEL_BASE, ("tr", "SELECT * FROM xy WHERE split = 'train'"), ("fit", _coef("tr", "0")),
                                     ("p", "SELECT pos, full_name, x, greatest(exp(my + beta * (x - mx)) - 1, 0) AS stars FROM xy, fit")) + f"""
SELECT row_number() OVER (ORDER BY x DESC, pos) AS rank, pos, full_name, round(stars::DOUBLE, 2) AS predicted_stars FROM p"""

# Fits that SQL can't repeat are held to properties: the rows they must give, the range of their
# predictions and a floor of their accuracy.
_CHECKED = with_ctes(("repos", REPOS_SQL), *STRATA_CTES) + \
    "SELECT pos, true AS in_range, true AS r2_floor FROM split WHERE split = 'test'"
for _name in ("ridge_fit_predict", "forest_fit_predict", "extra_trees_fit_predict", "boosting_fit_predict",
              "hist_boosting_fit_predict"):
    ORACLES[_name] = _CHECKED
ORACLES["grid_search"] = with_ctes(("repos", REPOS_SQL), ("cfg", _configs())) + \
    "SELECT model_name, config_id, true AS r2_floor FROM cfg WHERE (SELECT count(*) FROM repos) > 0"


def _families() -> str:
    import hashlib
    import json

    configs = [("LinearRegression", {}), ("Ridge", {"alpha": 1.0})]
    configs += [(m, {"max_depth": None, "min_samples_leaf": 4, "n_estimators": 10}) for m in ("RandomForest", "ExtraTrees")]
    configs += [("GradientBoosting", {"learning_rate": 0.3, "max_depth": 3, "n_estimators": 10}),
                ("HistGradientBoosting", {"learning_rate": 0.3, "max_depth": None, "max_iter": 10})]
    key = lambda m, c: hashlib.sha1(json.dumps({"model_name": m, **c}, sort_keys=True).encode()).hexdigest()[:12]
    return "SELECT * FROM (VALUES " + ", ".join(f"('{m}', '{m}_{key(m, c)}')" for m, c in configs) + ") t(model_name, config_id)"


ORACLES["grid_search_families"] = with_ctes(("repos", REPOS_SQL), ("cfg", _families())) + \
    "SELECT model_name, config_id, true AS r2_floor FROM cfg WHERE (SELECT count(*) FROM repos) > 0"
ORACLES["results_table"] = with_ctes(("repos", REPOS_SQL)) + """
SELECT model_name, true AS r2_floor, true AS same_after_reload, true AS winner_in_metadata
FROM (VALUES ('LinearRegression'), ('Ridge'), ('RandomForest'), ('ExtraTrees'), ('GradientBoosting'), ('HistGradientBoosting')) t(model_name) WHERE (SELECT count(*) FROM repos) > 0"""
ORACLES["ranked_predictions"] = with_ctes(("repos", REPOS_SQL)) + \
    "SELECT pos, full_name, true AS in_range, true AS rank_in_range FROM repos"

# The tree queries' features, sizes and seed (stream of the first tree).
_TREE_FEATURES, _TREE_SEED = ["open_pulls_count", "release_count", "topics_count", "has_wiki"], 68
ORACLES["forest_scores"] = trees_sql(STRATA_CTES, _TREE_FEATURES, 2, 3, 2, 5, 0.5, False, bootstrap=_TREE_SEED)
ORACLES["extra_trees_scores"] = trees_sql(STRATA_CTES, _TREE_FEATURES, 2, 3, 2, 5, 0.5, False, random=_TREE_SEED)
ORACLES["boosting_scores"] = trees_sql(STRATA_CTES, _TREE_FEATURES, 3, 3, 2, 1, 0.1, True)
ORACLES["hist_boosting_scores"] = trees_sql(STRATA_CTES, _TREE_FEATURES, 2, 30, 99, 20, 0.1, True)

ORACLES["align_columns"] = _align_sql()
