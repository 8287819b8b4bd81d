"""Explicit schemas: raw entity rows, nested API pages and the small tables.

Raw data is always read with one of these ``StructType``s — never inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The raw entity row's fields in flatten order (26 fields) —
# name and target, the counts, language / license / three timestamps, the
# booleans, description and owner type.
COUNT_FIELDS = [
    "forks_count", "watchers", "open_issues_count", "total_issues_count",
    "open_pulls_count", "release_count", "topics_count", "commit_count", "disk_usage",
]
BOOL_FIELDS_RAW = [
    "is_archived", "is_fork", "is_disabled", "is_mirror",
    "has_issues", "has_wiki", "has_projects", "has_discussions",
]

REPO_FIELDS: list[tuple[str, T.DataType]] = (
    [("full_name", T.StringType()), ("stargazers_count", T.LongType())]
    + [(c, T.LongType()) for c in COUNT_FIELDS]
    + [("language", T.StringType()), ("license_key", T.StringType()),
       ("created_at", T.StringType()), ("updated_at", T.StringType()),
       ("pushed_at", T.StringType())]
    + [(c, T.BooleanType()) for c in BOOL_FIELDS_RAW]
    + [("description", T.StringType()), ("owner_type", T.StringType())]
)
REPO_COLUMNS = [n for n, _ in REPO_FIELDS]

REPO_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in REPO_FIELDS])
# Optional keys some shards carry (contributor enrichment, synthetic marker).
REPO_SCHEMA_FULL = T.StructType(
    REPO_SCHEMA.fields
    + [T.StructField("contributor_count", T.LongType(), True),
       T.StructField("_synthetic", T.BooleanType(), True)]
)

# The nested API node's field names (the wire format of one
# search result), in the order below.
_TOTAL = T.StructType([T.StructField("totalCount", T.LongType(), True)])

NODE_SCHEMA = T.StructType([
    T.StructField("nameWithOwner", T.StringType(), True),
    T.StructField("stargazerCount", T.LongType(), True),
    T.StructField("forkCount", T.LongType(), True),
    T.StructField("watchers", _TOTAL, True),
    T.StructField("issues", _TOTAL, True),
    T.StructField("allIssues", _TOTAL, True),
    T.StructField("pullRequests", _TOTAL, True),
    T.StructField("releases", _TOTAL, True),
    T.StructField("repositoryTopics", _TOTAL, True),
    T.StructField("defaultBranchRef", T.StructType([
        T.StructField("target", T.StructType([
            T.StructField("history", _TOTAL, True)]), True)]), True),
    T.StructField("primaryLanguage", T.StructType([T.StructField("name", T.StringType(), True)]), True),
    T.StructField("licenseInfo", T.StructType([T.StructField("key", T.StringType(), True)]), True),
    T.StructField("createdAt", T.StringType(), True),
    T.StructField("updatedAt", T.StringType(), True),
    T.StructField("pushedAt", T.StringType(), True),
    T.StructField("isArchived", T.BooleanType(), True),
    T.StructField("isFork", T.BooleanType(), True),
    T.StructField("isDisabled", T.BooleanType(), True),
    T.StructField("isMirror", T.BooleanType(), True),
    T.StructField("hasIssuesEnabled", T.BooleanType(), True),
    T.StructField("hasWikiEnabled", T.BooleanType(), True),
    T.StructField("hasProjectsEnabled", T.BooleanType(), True),
    T.StructField("hasDiscussionsEnabled", T.BooleanType(), True),
    T.StructField("diskUsage", T.LongType(), True),
    T.StructField("description", T.StringType(), True),
    T.StructField("owner", T.StructType([T.StructField("__typename", T.StringType(), True)]), True),
])

PAGE_SCHEMA = T.StructType([
    T.StructField("data", T.StructType([
        T.StructField("search", T.StructType([
            T.StructField("repositoryCount", T.LongType(), True),
            T.StructField("pageInfo", T.StructType([
                T.StructField("hasNextPage", T.BooleanType(), True),
                T.StructField("endCursor", T.StringType(), True)]), True),
            T.StructField("nodes", T.ArrayType(NODE_SCHEMA, True), True),
        ]), True)]), True),
])

TRIAL_SCHEMA = T.StructType([
    T.StructField("model_name", T.StringType(), False),
    T.StructField("config_id", T.StringType(), False),
    T.StructField("config", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("cv_r2", T.DoubleType(), True),
])

TIMING_SCHEMA = "workers double, seconds double"

# Fixed value: the timestamp format, UTC wall clock with a literal 'Z'.
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"

# The six model families, in grid order.
MODELS = ["LinearRegression", "Ridge", "RandomForest", "ExtraTrees", "GradientBoosting", "HistGradientBoosting"]
