"""Ingest operators: flatten API nodes (P1), API pages to rows (S3/F1/O2),
contributor enrichment (P11) and the invalid-row quarantine (F4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from velorank.functions.features import epoch_seconds, non_empty_or
from velorank.operators.rank import null_safe_join
from velorank.session import materialize
from velorank.sources.schema import PAGE_SCHEMA

# Fixed value: nodes per API page.
PAGE_SIZE = 40


def flatten_node(node: Column) -> list[Column]:
    """Nested node -> the 26 flat entity fields, in flatten order."""
    hist = node["defaultBranchRef"]["target"]["history"]
    created = node["createdAt"]
    return [
        node["nameWithOwner"].alias("full_name"),
        node["stargazerCount"].alias("stargazers_count"),
        node["forkCount"].alias("forks_count"),
        node["watchers"]["totalCount"].alias("watchers"),
        node["issues"]["totalCount"].alias("open_issues_count"),
        node["allIssues"]["totalCount"].alias("total_issues_count"),
        node["pullRequests"]["totalCount"].alias("open_pulls_count"),
        node["releases"]["totalCount"].alias("release_count"),
        node["repositoryTopics"]["totalCount"].alias("topics_count"),
        # commit count only when ref, target and history are all present
        F.when(hist.isNotNull(), hist["totalCount"]).otherwise(F.lit(0)).cast("long").alias("commit_count"),
        F.coalesce(node["diskUsage"], F.lit(0)).cast("long").alias("disk_usage"),
        node["primaryLanguage"]["name"].alias("language"),
        node["licenseInfo"]["key"].alias("license_key"),
        created.alias("created_at"),
        node["updatedAt"].alias("updated_at"),
        non_empty_or(node["pushedAt"], non_empty_or(node["updatedAt"], created)).alias("pushed_at"),
        node["isArchived"].alias("is_archived"),
        node["isFork"].alias("is_fork"),
        node["isDisabled"].alias("is_disabled"),
        node["isMirror"].alias("is_mirror"),
        node["hasIssuesEnabled"].alias("has_issues"),
        node["hasWikiEnabled"].alias("has_wiki"),
        node["hasProjectsEnabled"].alias("has_projects"),
        node["hasDiscussionsEnabled"].alias("has_discussions"),
        F.coalesce(node["description"], F.lit("")).alias("description"),
        node["owner"]["__typename"].alias("owner_type"),
    ]


def flatten_nodes(df: DataFrame, node_col: str = "node", keep: Sequence[str] = ()) -> DataFrame:
    """P1 over a frame with a node struct column."""
    return df.select(*[F.col(c) for c in keep], *flatten_node(F.col(node_col)))


# What flatten needs; a counted object may hold a null count, but the object must be there.
REQUIRED_PATHS = ["nameWithOwner", "createdAt", "watchers", "issues", "allIssues", "pullRequests", "releases",
                  "repositoryTopics", "owner"]


def node_problem(node: Column) -> Column:
    """F4 for P1: the first required path a node lacks, else null."""
    out = F.lit(None).cast("string")
    for path in reversed(REQUIRED_PATHS):
        out = F.when(node[path].isNull(), F.lit(f"missing {path}")).otherwise(out)
    return out


def read_pages(pages: DataFrame, body_col: str = "body") -> DataFrame:
    """``pages`` with ``nodes`` and ``page_problem``: why a response holds no readable nodes, else null."""
    schema = T.StructType([*PAGE_SCHEMA.fields, T.StructField("_bad", T.StringType())])
    body = F.col(body_col)
    errors = F.get_json_object(body, "$.errors[0].message")
    parsed = pages.withColumn("_p", F.from_json(body, schema, {"columnNameOfCorruptRecord": "_bad"}))
    nodes = F.col("_p.data.search.nodes")
    problem = (F.when(body.isNull() | (F.trim(body) == ""), F.lit("empty page"))
               .when(F.col("_p._bad").isNotNull() | F.col("_p").isNull(), F.lit("unreadable page"))
               .when(errors.isNotNull(), F.concat(F.lit("errors: "), errors))
               .when(nodes.isNull(), F.lit("no nodes")))
    return parsed.withColumns({"nodes": nodes, "page_problem": problem}).drop("_p")


def pages_quarantine(pages: DataFrame, query_col: str = "query", page_col: str = "page_no",
                     body_col: str = "body") -> DataFrame:
    """F4 for S3: (query, page, node_idx, reason) of every page that can't be read (node_idx null) and
    every non-null node that lacks a required path."""
    read = read_pages(pages, body_col)
    whole = read.where(F.col("page_problem").isNotNull()).select(
        query_col, page_col, F.lit(None).cast("int").alias("node_idx"), F.col("page_problem").alias("reason"))
    nodes = read.where(F.col("page_problem").isNull()).select(query_col, page_col, F.posexplode("nodes").alias("node_idx", "node"))
    lacking = nodes.where(F.col("node").isNotNull()).select(query_col, page_col, "node_idx", node_problem(F.col("node")).alias("reason"))
    return whole.unionByName(lacking.where(F.col("reason").isNotNull()))


def page_chain(pages: DataFrame, query_col: str = "query", page_col: str = "page_no", body_col: str = "body") -> DataFrame:
    """S3: (query, page, fault) of every break in the captured page chains; a whole chain gives no row.

    ``repeated``: the page was captured more than once.  ``no successor``: it says that there is a next
    page, which is not there (the last page of a truncated chain, or the page before a gap).  ``no
    predecessor``: a page above 0 whose predecessor is not there.  ``after the end``: its predecessor says
    that it is the last.  ``no cursor``: it has a next page but no cursor to it.  ``same cursor``: its
    cursor is its predecessor's, so following it would loop.

    A page that can't be read has no next page and no cursor; a null page number is left out; of a
    repeated page, a capture with a next page counts before one without, then the smallest cursor hash.

    Every page is sent to its own place and to its neighbours' and one hash aggregate over fixed-width
    values meets them: no window, so a query with a third of all pages is spread over all tasks."""
    info = F.from_json(body_col, "data struct<search: struct<pageInfo: struct<hasNextPage: boolean, endCursor: string>>>")["data"]["search"]["pageInfo"]
    page = F.col(page_col).cast("long")
    narrow = pages.where(page.isNotNull()).select(
        F.col(query_col), page.alias("_page"), F.coalesce(info["hasNextPage"], F.lit(False)).alias("_next"),
        F.when(info["endCursor"].isNotNull(), F.xxhash64(info["endCursor"])).alias("_cursor"))
    places = F.array(*[F.struct(F.lit(d).alias("_from"), (F.col("_page") - d).alias("_at")) for d in (-1, 0, 1)])
    spread = narrow.select(query_col, "_next", "_cursor", F.inline(places))
    own, before = F.col("_from") == 0, F.col("_from") == -1
    met = spread.groupBy(query_col, "_at").agg(
        F.count(F.when(own, 1)).alias("_n"), F.count(F.when(before, 1)).alias("_before"), F.count(F.when(F.col("_from") == 1, 1)).alias("_after"),
        F.max(F.when(own, F.col("_next"))).alias("_own_next"), F.min(F.when(own, F.col("_cursor"))).alias("_own_cursor"),
        F.max(F.when(before, F.col("_next"))).alias("_before_next"), F.min(F.when(before, F.col("_cursor"))).alias("_before_cursor"))
    c = F.col
    faults = {
        "repeated": c("_n") > 1,
        "no successor": c("_own_next") & (c("_after") == 0),
        "no predecessor": (c("_at") > 0) & (c("_before") == 0),
        "after the end": (c("_before") > 0) & ~c("_before_next"),
        "no cursor": c("_own_next") & c("_own_cursor").isNull(),
        "same cursor": c("_own_next") & (c("_own_cursor") == c("_before_cursor")),
    }
    listed = F.filter(F.array(*[F.when(when, F.lit(name)) for name, when in faults.items()]), lambda x: x.isNotNull())
    return met.where(c("_n") > 0).select(query_col, c("_at").alias(page_col), F.explode(listed).alias("fault"))


def pages_to_rows(pages: DataFrame, max_repos: int | None = None, query_col: str = "query",
                  page_col: str = "page_no", body_col: str = "body", strict: bool = True) -> DataFrame:
    """S3: captured search pages (JSON text) -> one flat row per non-null
    node; per query the first ``max_repos`` in (page, position) order.

    A page that can't be read or holds errors, or a node that lacks a
    required path, fails the job when ``strict``; otherwise it is left out
    here and ``pages_quarantine`` lists it.

    Which nodes are wanted is found from per-page counts of non-null nodes
    and a running sum over a query's pages; only wanted nodes are exploded.
    With ``max_repos`` the parsed pages are written once (under the shared
    checkpoint folder) and the counts read from there, so no body is parsed
    twice and a page that fails does so here."""
    read = read_pages(pages, body_col)
    if strict:
        bad = F.col("page_problem")
        read = read.withColumn("nodes", F.when(bad.isNull(), F.col("nodes")).otherwise(
            F.raise_error(F.concat(F.lit("page "), F.col(page_col).cast("string"), F.lit(": "), bad)).cast(read.schema["nodes"].dataType)))
    else:
        read = read.where(F.col("page_problem").isNull())
    usable = F.filter(F.transform("nodes", lambda n, i: F.struct(i.alias("node_idx"), n.alias("node"))),
                      lambda x: x["node"].isNotNull() if strict else x["node"].isNotNull() & node_problem(x["node"]).isNull())
    read = read.select(query_col, page_col, usable.alias("nodes"))
    if max_repos:
        read = materialize(read.withColumn("_n", F.size("nodes").cast("long")), "parsed-pages")
        counts = read.select(query_col, page_col, F.col("_n").alias("n"))
        read = read.drop("_n")
        before = W.partitionBy(query_col).orderBy(page_col).rowsBetween(W.unboundedPreceding, -1)
        counts = counts.withColumn("_left", F.lit(max_repos) - F.coalesce(F.sum("n").over(before), F.lit(0))) \
            .where(F.col("_left") > 0).drop("n")
        read = null_safe_join(read, counts, [query_col, page_col]).withColumn(
            "nodes", F.slice("nodes", 1, F.greatest(F.lit(0), F.col("_left")).cast("int"))).drop("_left")
    nodes = read.select(query_col, page_col, F.inline("nodes"))
    if strict:
        lack = node_problem(F.col("node"))
        nodes = nodes.where(F.when(lack.isNull(), F.lit(True)).otherwise(F.raise_error(lack).cast("boolean")))
    return flatten_nodes(nodes, "node", keep=[query_col, page_col, "node_idx"])


def enrich_counts(df: DataFrame, counts: DataFrame, key: str, count_col: str,
                  out_col: str = "contributor_count") -> DataFrame:
    """Attach a per-entity count from another source, missing -> 0.

    A left equi-join; Spark picks broadcast only when the count table's
    runtime size is under the threshold, else a shuffle join (AQE splits
    skewed keys)."""
    c = counts.select(F.col(key), F.col(count_col).alias("_vr_cnt"))
    return (df.join(c, key, "left")
            .withColumn(out_col, F.coalesce(F.col("_vr_cnt"), F.lit(0)).cast("long"))
            .drop("_vr_cnt"))


def invalid_reason(df: DataFrame, target: str | None = "stargazers_count") -> Column:
    """the first reason a raw row cannot be featurised, else null.  A
    line that could not be parsed says so; ``target=None`` asks for no label
    (it is needed for training only)."""
    def bad_ts(c: str) -> Column:
        return F.col(c).isNotNull() & (F.col(c) != "") & epoch_seconds(F.col(c), strict=False).isNull()
    reason = F.when(F.col("_corrupt_record").isNotNull(), F.lit("unreadable line")) \
        if "_corrupt_record" in df.columns else F.when(F.lit(False), F.lit(""))
    reason = reason.when(F.col("full_name").isNull() | (F.col("full_name") == ""), F.lit("missing full_name"))
    if target:
        reason = reason.when(F.col(target).isNull(), F.lit(f"missing {target}"))
    return (reason.when(F.col("created_at").isNull(), F.lit("missing created_at"))
            .when(epoch_seconds(F.col("created_at"), strict=False).isNull(), F.lit("bad created_at"))
            .when(bad_ts("updated_at"), F.lit("bad updated_at"))
            .when(bad_ts("pushed_at"), F.lit("bad pushed_at")))


def quarantine(df: DataFrame, reason_col: str = "reason",
               target: str | None = "stargazers_count") -> tuple[DataFrame, DataFrame]:
    """split into (valid, quarantined-with-reason)."""
    tagged = df.withColumn(reason_col, invalid_reason(df, target))
    return tagged.where(F.col(reason_col).isNull()).drop(reason_col, "_corrupt_record"), tagged.where(F.col(reason_col).isNotNull())


def require_rows(df: DataFrame, what: str = "no valid rows") -> DataFrame:
    """Raise when a frame is empty (one-row probe, not a count)."""
    if not df.take(1):
        raise RuntimeError(what)
    return df


