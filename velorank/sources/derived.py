"""Inputs derived by Spark from the ``repos`` table (no made-up data):
nested API nodes and pages, trial records and fold scores.

Each derivation is deterministic in the row's own columns, so the SQL
oracle can state the expected result directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from velorank.functions.arith import idiv

from velorank.operators.bands import assign_band, search_text
from velorank.operators.ingest import PAGE_SIZE
from velorank.operators.rank import null_safe_join, rank_within
from velorank.session import materialize
from velorank.sources.schema import MODELS as MODEL_NAMES


def _total(c) -> F.Column:
    return F.struct(c.alias("totalCount"))


def node_struct() -> F.Column:
    """Inverse of flatten for a ``repos`` row: some sub-objects absent
    (no default branch every 7th, disk usage unknown every 5th, no
    description when empty) so every null path of P1 is exercised."""
    pos = F.col("pos")
    return F.struct(
        F.col("full_name").alias("nameWithOwner"),
        F.col("stargazers_count").alias("stargazerCount"),
        F.col("forks_count").alias("forkCount"),
        _total(F.col("watchers")).alias("watchers"),
        _total(F.col("open_issues_count")).alias("issues"),
        _total(F.col("total_issues_count")).alias("allIssues"),
        _total(F.col("open_pulls_count")).alias("pullRequests"),
        _total(F.col("release_count")).alias("releases"),
        _total(F.col("topics_count")).alias("repositoryTopics"),
        F.when(pos % 7 == 0, F.lit(None)).otherwise(
            F.struct(F.struct(_total(F.col("commit_count")).alias("history")).alias("target"))
        ).alias("defaultBranchRef"),
        F.when(F.col("language").isNull(), F.lit(None)).otherwise(
            F.struct(F.col("language").alias("name"))).alias("primaryLanguage"),
        F.when(F.col("license_key").isNull(), F.lit(None)).otherwise(
            F.struct(F.col("license_key").alias("key"))).alias("licenseInfo"),
        F.col("created_at").alias("createdAt"),
        F.col("updated_at").alias("updatedAt"),
        F.col("pushed_at").alias("pushedAt"),
        F.col("is_archived").alias("isArchived"),
        F.col("is_fork").alias("isFork"),
        F.col("is_disabled").alias("isDisabled"),
        F.col("is_mirror").alias("isMirror"),
        F.col("has_issues").alias("hasIssuesEnabled"),
        F.col("has_wiki").alias("hasWikiEnabled"),
        F.col("has_projects").alias("hasProjectsEnabled"),
        F.col("has_discussions").alias("hasDiscussionsEnabled"),
        F.when(pos % 5 == 0, F.lit(None)).otherwise(F.col("disk_usage")).alias("diskUsage"),
        F.nullif(F.col("description"), F.lit("")).alias("description"),
        F.struct(F.col("owner_type").alias("__typename")).alias("owner"),
    )


def node_json(repos: DataFrame) -> DataFrame:
    """(pos, node JSON text) — the wire form of one API node."""
    return repos.select("pos", F.to_json(node_struct()).alias("node_json"))


def search_pages(repos: DataFrame) -> DataFrame:
    """Captured search responses: per band query, nodes sorted by stars
    desc (ties by pos), ``PAGE_SIZE`` per page, every 23rd node null.

    Columns: query, page_no, body (JSON text)."""
    with_band = assign_band(repos).where(F.col("band").isNotNull())
    with_band = with_band.withColumn("query", search_text(F.col("lo"), F.col("hi"))).drop("lo", "hi", "label")
    ranked = rank_within(with_band, ["query"], [F.desc("stargazers_count"), F.asc("pos")], "r")
    # written, so that the planner knows its size: a row per band query is broadcast
    sizes = materialize(ranked.groupBy("query").agg(F.count(F.lit(1)).alias("repository_count")), "query-sizes")
    nodes = ranked.select(
        "query", (idiv((F.col("r") - 1), PAGE_SIZE)).cast("int").alias("page_no"),
        F.col("r"),
        F.when(F.col("pos") % 23 == 0, F.lit(None)).otherwise(node_struct()).alias("node"))
    # one page = at most PAGE_SIZE nodes: a bounded collect per group
    pages = (nodes.groupBy("query", "page_no")
             .agg(F.array_sort(F.collect_list(F.struct("r", "node"))).alias("items")))
    pages = null_safe_join(pages, sizes, ["query"])
    last_page = idiv((F.col("repository_count") - 1), PAGE_SIZE)
    body = F.to_json(F.struct(F.struct(F.struct(
        F.col("repository_count").alias("repositoryCount"),
        F.struct((F.col("page_no") < F.col("last_page")).alias("hasNextPage"),
                 F.concat(F.lit("cursor:"), F.col("page_no").cast("string")).alias("endCursor")
                 ).alias("pageInfo"),
        F.transform("items", lambda it: it["node"]).alias("nodes"),
    ).alias("search")).alias("data")))
    return pages.withColumn("last_page", last_page).select("query", "page_no", body.alias("body"))


def trials_from_repos(repos: DataFrame) -> DataFrame:
    """Trial records: model family by position, a content-derived config id,
    ``cv_r2 = (stars % 1000) / 1000`` and NaN for every 97th record."""
    names = F.array(*[F.lit(n) for n in MODEL_NAMES])
    model = F.element_at(names, (F.col("pos") % len(MODEL_NAMES)).cast("int") + 1)
    return repos.select(
        model.alias("model_name"),
        F.concat(model, F.lit("_"), F.substring(F.sha1(F.col("full_name")), 1, 12)).alias("config_id"),
        F.create_map(F.lit("source"), F.col("full_name")).alias("config"),
        F.when(F.col("pos") % 97 == 0, F.lit(float("nan")))
         .otherwise((F.col("stargazers_count") % 1000) / F.lit(1000.0)).alias("cv_r2"),
    )


def fold_scores_from_repos(repos: DataFrame, folds: int = 5) -> DataFrame:
    """Fold-level scores: config = customer of the entity, fold = pos % k."""
    return repos.select(
        F.concat(F.lit("cfg_"), F.regexp_extract("full_name", r"^user(\d+)/", 1)).alias("config_id"),
        (F.col("pos") % folds).cast("int").alias("fold"),
        ((F.col("stargazers_count") % 1000) / F.lit(1000.0)).alias("r2_fold"),
    )
