"""Scalar feature expressions.

All are built-in Column expressions, so a whole feature row is one
whole-stage-codegen projection; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from velorank.sources.schema import TS_FORMAT

# Feature column groups and their order (the trained column order).
NUM_FIELDS = [
    "forks_count", "watchers", "open_issues_count", "total_issues_count",
    "open_pulls_count", "release_count", "commit_count", "topics_count",
    "disk_usage", "description_length", "name_length", "contributor_count",
]
BOOL_FIELDS = [
    "is_archived", "is_fork", "is_disabled", "is_mirror", "has_issues",
    "has_wiki", "has_projects", "has_discussions", "has_license", "owner_is_org",
]
DAY_FIELDS = ["age_days", "days_since_push", "days_since_update"]
RATE_FIELDS = [
    "commits_per_day", "commits_per_year", "issues_per_day",
    "open_issue_ratio", "forks_per_day", "releases_per_year",
]
LOG_SOURCE_FIELDS = ["forks_count", "commit_count", "open_issues_count", "total_issues_count", "disk_usage"]
LOG_FIELDS = [f"log_{c}" for c in LOG_SOURCE_FIELDS]
NUMERIC_FEATURES = NUM_FIELDS + BOOL_FIELDS + DAY_FIELDS + RATE_FIELDS + LOG_FIELDS
CATEGORICALS = ["language", "license_key"]
# Defaults of the two categoricals when null or empty.
CATEGORY_DEFAULTS = {"language": "unknown", "license_key": "none"}

SECONDS_PER_DAY = 86400


def col_or_zero(df: DataFrame, name: str) -> Column:
    """A count column defaulted to 0; an absent optional column is 0."""
    if name in df.columns:
        return F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long"))
    return F.lit(0).cast("long")


def text_length(c: Column) -> Column:
    """Code-point length, null -> 0."""
    return F.length(F.coalesce(c, F.lit(""))).cast("long")


def is_present(c: Column) -> Column:
    """1 when non-null and non-empty."""
    return (F.coalesce(c, F.lit("")) != F.lit("")).cast("int")


def equals_flag(c: Column, value: str) -> Column:
    """Exact string equality as 0/1, null -> 0."""
    return F.coalesce(c == F.lit(value), F.lit(False)).cast("int")


def bool01(c: Column) -> Column:
    """P5: boolean to 0/1, null -> 0."""
    return F.coalesce(c.cast("boolean"), F.lit(False)).cast("int")


def epoch_seconds(ts_str: Column, strict: bool = True) -> Column:
    """Seconds since epoch of a ``yyyy-MM-ddTHH:mm:ssZ`` string (UTC).

    strict: ANSI ``to_timestamp`` raises on a malformed value, like the
    reference; otherwise ``try_to_timestamp`` gives null (quarantine path, T10).
    """
    ts = F.to_timestamp(ts_str, TS_FORMAT) if strict else F.try_to_timestamp(ts_str, F.lit(TS_FORMAT))
    return F.unix_seconds(ts)


def whole_days_since(ts_str: Column, as_of: str, strict: bool = True) -> Column:
    """floor((as_of - t) / 1 day); future -> negative; not datediff (T4);
    ``as_of`` is a parameter, never the clock (T6)."""
    now = F.unix_seconds(F.to_timestamp(F.lit(as_of), TS_FORMAT))
    return F.floor((now - epoch_seconds(ts_str, strict)) / F.lit(SECONDS_PER_DAY)).cast("long")


def non_empty_or(c: Column, fallback: Column) -> Column:
    """``c or fallback`` for strings: null and '' fall through."""
    return F.coalesce(F.nullif(c, F.lit("")), fallback)


def category_or_default(c: Column, default: str) -> Column:
    """Categorical default when null or ''."""
    return non_empty_or(c, F.lit(default))


def log1p_col(c: Column) -> Column:
    """log(1+x)."""
    return F.log1p(c.cast("double"))


def log_target(y: Column) -> Column:
    """Train on log1p(y)."""
    return F.log1p(y.cast("double"))


def star_space(log_pred: Column, floor: float = 0.0) -> Column:
    """P13 inverse: expm1 with a floor (0 for predictions, 1 for plots)."""
    return F.greatest(F.expm1(log_pred), F.lit(float(floor)))


def last_page_number(url: Column, fallback: Column) -> Column:
    """The value after the last ``page=`` up to ``&`` (fragment cut);
    no such value -> fallback."""
    no_fragment = F.regexp_replace(url, "#.*$", "")
    raw = F.regexp_extract(no_fragment, r".*page=([^&]*)", 1)
    return F.coalesce(F.nullif(raw, F.lit("")).try_cast("long"), fallback)


def feature_columns(df: DataFrame, as_of: str, strict: bool = True) -> list[Column]:
    """P10: the 36 numeric features + 2 categoricals, in reference order."""
    counts = {c: col_or_zero(df, c) for c in NUM_FIELDS
              if c not in ("description_length", "name_length")}
    counts["description_length"] = text_length(F.col("description"))
    counts["name_length"] = text_length(F.col("full_name"))
    flags = {c: bool01(F.col(c)) if c in df.columns else F.lit(0)
             for c in BOOL_FIELDS if c not in ("has_license", "owner_is_org")}
    flags["has_license"] = is_present(F.col("license_key"))
    flags["owner_is_org"] = equals_flag(F.col("owner_type"), "Organization")

    created = F.col("created_at")
    age = whole_days_since(created, as_of, strict)
    days = {
        "age_days": age,
        "days_since_push": whole_days_since(non_empty_or(F.col("pushed_at"), created), as_of, strict),
        "days_since_update": whole_days_since(non_empty_or(F.col("updated_at"), created), as_of, strict),
    }
    years = F.greatest(age / F.lit(365.0), F.lit(1 / 365.0))
    per_day = F.greatest(age, F.lit(1))
    rates = {
        "commits_per_day": counts["commit_count"] / per_day,
        "commits_per_year": counts["commit_count"] / years,
        "issues_per_day": counts["total_issues_count"] / per_day,
        "open_issue_ratio": counts["open_issues_count"] / F.greatest(counts["total_issues_count"], F.lit(1)),
        "forks_per_day": counts["forks_count"] / per_day,
        "releases_per_year": counts["release_count"] / years,
    }
    logs = {f"log_{c}": log1p_col(counts[c]) for c in LOG_SOURCE_FIELDS}
    exprs = {**counts, **flags, **days, **rates, **logs}
    cols = [exprs[c].cast("double" if c in RATE_FIELDS or c in LOG_FIELDS else
                          ("int" if c in BOOL_FIELDS else "long")).alias(c)
            for c in NUMERIC_FEATURES]
    cols += [category_or_default(F.col(c), CATEGORY_DEFAULTS[c]).alias(c) for c in CATEGORICALS]
    return cols


def make_features(df: DataFrame, as_of: str, keep: tuple[str, ...] = ("pos", "full_name", "stargazers_count"),
                  strict: bool = True) -> DataFrame:
    """P10: the feature table — one projection over the raw entity rows."""
    kept = [F.col(c) for c in keep if c in df.columns]
    return df.select(*kept, *feature_columns(df, as_of, strict))
