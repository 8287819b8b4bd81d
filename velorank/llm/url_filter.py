"""URL filter (native): pattern rules behind an index on their rarest literal token.

A rule is a regular expression over ``host || path`` together with literal tokens (runs of
``a-z0-9``) that stand whole in every text it matches.  Tokens are counted over all URLs, each
rule is filed under its rarest one, the URLs' tokens fetch candidate rules with an equi-join, and
only those candidates run their regular expression.  The best matching rule decides: host rules
before patterns, the longest first; among patterns, a later one in the list wins.

A URL that is null or has no ``://`` has an empty host and path; no rule fits it and the default
verdict holds.  Repeated URLs are judged alike.  An empty table gives an empty result.  Columns named like
the new ones are replaced; all others pass through, whatever their names.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from velorank.llm.common import ascii_lower, private

#: (host, path, verdict): fits the host and its subdomains when the URL's path starts with the path.
HOST_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
#: (name, literal tokens, pattern, verdict): the method's own rules, over the lower-cased host and the path.
PATTERN_RULES = [
    ("bets", ["bets"], r"^[^/]*(free|live|best)-bets\.", "block"),
    ("casino", ["casino"], r"^([^/]*[.-])?casino[.-]", "block"),
    ("pills", ["cheap", "pills"], r"^[^/]*cheap-pills\.", "block"),
    ("spam-farm", ["spam", "farm"], r"^([^/]*[.-])?spam-farm\.", "block"),
    ("adult", ["adult"], r"^([^/]*[.-])?adult[.-]", "block"),
    ("tracker", ["ads", "track"], r"^([^/]*[.-])?ads-track\.", "block"),
    ("wp-login", ["wp", "login", "php"], r"^[^/]*/(.*/)?wp-login\.php$", "block"),
    ("feed-xml", ["feed", "xml"], r"^[^/]*/(.*/)?feed\.xml$", "block"),
]
DEFAULT = "allow"
MAX_BROADCAST_RULES = 20_000       # a larger index is joined by a shuffle instead


def _tokens(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text)


def rule_table(spark: SparkSession, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """(rank, label, tokens, pattern, verdict); the highest rank wins.  A rule without a literal token can't be indexed."""
    rules = [(2, len(h + p), h + p, _tokens(h + p.lower()), "^(?:[^/]*\\.)?" + re.escape(h + p).replace("/", "/"), v)
             for h, p, v in host_rules]
    rules += [(1, i, n, list(t), p, v) for i, (n, t, p, v) in enumerate(pattern_rules)]
    if bad := [r[2] for r in rules if not r[3]]:
        raise ValueError(f"rules without a literal token: {bad}")
    rules.sort(key=lambda r: (r[0], r[1], r[2]))
    rows = [F.struct(F.lit(i).cast("long").alias("rank"), F.lit(r[2]).alias("label"), F.lit(r[0] == 2).alias("is_host"),
                     F.array(*map(F.lit, r[3])).alias("tokens"), F.lit(r[4]).alias("pattern"), F.lit(r[5]).alias("verdict"))
            for i, r in enumerate(rules)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda k: F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def judge_urls(df: DataFrame, url: str = "url", host_rules=HOST_RULES, pattern_rules=PATTERN_RULES) -> DataFrame:
    """``df`` with host, path, rule (the winning host rule), pattern_rule and verdict."""
    judged, told_by = private(df, "_judged", "_best")
    spark, n_rules = df.sparkSession, len(host_rules) + len(pattern_rules)
    small = F.broadcast if n_rules <= MAX_BROADCAST_RULES else (lambda x: x)
    rules = rule_table(spark, host_rules, pattern_rules)
    host, path = host_and_path(F.col("_url"))
    urls = df.select(F.col(url).alias("_url")).where(F.col("_url").isNotNull()) \
        .select("_url", F.concat(host, path).alias("_subject"))
    told = urls.select("_url", "_subject", F.explode(F.array_distinct(
        F.split(F.lower("_subject"), "[^a-z0-9]+"))).alias("token")).where("token <> ''")
    # how many URLs hold each token of the rules; tokens that occur nowhere are the rarest
    wanted = rules.select(F.explode("tokens").alias("token")).distinct()
    counts = told.select("token").join(small(wanted), "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    index = (rules.withColumn("token", F.explode("tokens")).join(counts, "token", "left")
             .withColumn("_r", F.row_number().over(W.partitionBy("rank").orderBy(F.coalesce("n", F.lit(0)), "token")))
             .where("_r = 1").select("token", "rank", "pattern"))
    matched = (told.join(small(index), "token").where(F.expr("regexp_like(_subject, pattern)"))
               .groupBy("_url").agg(F.max("rank").alias("rank")))
    best = matched.join(small(rules.select("rank", "label", "is_host", "verdict")), "rank").select(
        F.col("_url").alias(judged), F.struct("label", "is_host", "verdict").alias(told_by))
    host, path = host_and_path(F.col(url))
    joined = df.join(best, F.col(url) == F.col(judged), "left")
    return joined.withColumns({
        "host": host, "path": path,
        "rule": F.when(F.col(f"{told_by}.is_host"), F.col(f"{told_by}.label")),
        "pattern_rule": F.when(~F.col(f"{told_by}.is_host"), F.col(f"{told_by}.label")),
        "verdict": F.coalesce(f"{told_by}.verdict", F.lit(DEFAULT))}).drop(judged, told_by)
