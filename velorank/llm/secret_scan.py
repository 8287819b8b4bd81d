"""Secrets in texts, with corpus-wide ownership of every candidate (native).

Four patterns find candidates: assignments to a password-like name, access key ids, long hex numbers and
long runs that mix both letter cases with digits.  The hashes of all candidates' values are aggregated by
distinct repositories and owners: a value that many owners' repositories hold is a copied example, one
that stays with its owner looks live.  The first three patterns' spans are reported whatever their
verdict; a mixed run outside of them is reported (kind ``owned``) only if its value is live-looking.

Positions count code points, the end is exclusive.  A pattern's matches are leftmost and do not
overlap; those too short are dropped afterwards, so they may hide what begins inside them.  Null texts are
empty.  A null repository or owner is one unknown one.  Repeated rows are documents of their own but
not further owners.  Null ids stay null.  Only the named columns are read, whatever else there is.
An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from velorank.llm.common import match_keys
from velorank.session import materialize

#: Names whose assigned values are secrets, and the patterns' least lengths.
NAMES = ["password", "passwd", "secret", "token", "api_?key"]
MIN_VALUE, MIN_ACCESS, MIN_HEX, MIN_MIXED = 6, 20, 24, 20
KINDS = ["assign", "access", "hex", "owned"]
MIN_REPOS, MIN_OWNERS = 3, 2       # a value in so many repositories of so many owners is an example


def either_case(name: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name)


PATTERNS = [
    "(" + "|".join(map(either_case, NAMES)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "AKIA[A-Z0-9]+",
    f"[0-9a-f]{{{MIN_HEX},}}",       # a whole run of hex digits or none of it
    f"[A-Za-z0-9+/_=-]{{{MIN_MIXED},}}",
]


def matches(text: Column, kind: int) -> Column:
    """(kind, i, gap, value): a pattern's matches in order; ``gap`` counts the characters before each, after the last."""
    found, between = F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0)), F.split(text, PATTERNS[kind], -1)
    zipped = F.arrays_zip(found.alias("value"), F.transform(between, lambda g: F.length(g).cast("long")).alias("gap"))
    rows = F.transform(F.filter(zipped, lambda x: x["value"].isNotNull()), lambda x, i: F.struct(
        F.lit(kind).alias("_kind"), i.alias("_i"), x["gap"].alias("_gap"), x["value"].alias("_match")))
    return F.when(text.rlike(PATTERNS[kind]), rows).otherwise(F.array().cast("array<struct<_kind:int,_i:int,_gap:bigint,_match:string>>"))


def candidates(docs: DataFrame, doc_id: str, text: str, repo: Column, owner: Column) -> DataFrame:
    """(_row, doc_id, _repo, _owner, _found): one row per document; texts are read here only."""
    t = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(repo.cast("string"), F.lit("")).alias("_repo"),
                      F.coalesce(owner.cast("string"), F.lit("")).alias("_owner"), t.alias("_t"))
    return own.select(F.monotonically_increasing_id().alias("_row"), "doc_id", "_repo", "_owner",
                      F.concat(*[matches(F.col("_t"), k) for k in range(len(PATTERNS))]).alias("_found"))


def place(found: DataFrame) -> DataFrame:
    """(_row, _repo, _owner, _kind, start, end, _digest): candidates long enough, mixed runs only outside of the others."""
    # dealt out by document once; both windows keep to it
    one = found.where(F.size("_found") > 0).select("_row", "_repo", "_owner", F.explode("_found").alias("x")) \
        .select("_row", "_repo", "_owner", "x.*").repartition("_row")
    so_far = W.partitionBy("_row", "_kind").orderBy("_i").rowsBetween(W.unboundedPreceding, 0)
    size = F.length("_match").cast("long")
    value = F.when(F.col("_kind") == 0, F.regexp_extract("_match", PATTERNS[0], 2)).otherwise(F.col("_match"))
    enough = F.when(F.col("_kind") == 0, F.length("_value") >= MIN_VALUE).when(F.col("_kind") == 1, F.length("_value") >= MIN_ACCESS) \
        .when(F.col("_kind") == 3, F.col("_value").rlike("[A-Z]") & F.col("_value").rlike("[a-z]") & F.col("_value").rlike("[0-9]")).otherwise(True)
    spans = (one.withColumn("end", F.sum(F.col("_gap") + size).over(so_far)).withColumn("start", F.col("end") - size)
             .withColumn("_value", value).where(enough))
    by_place = W.partitionBy("_row").orderBy("start", "_kind")
    told = F.col("_kind") < 3
    before = F.max(F.when(told, F.col("end"))).over(by_place.rowsBetween(W.unboundedPreceding, 0))
    after = F.min(F.when(told, F.col("start"))).over(by_place.rowsBetween(0, W.unboundedFollowing))
    free = (F.coalesce(F.col("_before"), F.lit(0)) <= F.col("start")) & (F.coalesce(F.col("_after"), F.col("end")) >= F.col("end"))
    return (spans.withColumns({"_before": before, "_after": after}).where(told | free)
            .select("_row", "_repo", "_owner", "_kind", "start", "end",
                    F.unhex(F.substring(F.sha2(F.col("_value").cast("binary"), 256), 1, 32)).alias("_digest")))


def ownership(spans: DataFrame) -> DataFrame:
    """(_digest, _n, n_repos, n_owners): how widely every candidate value is held."""
    return spans.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"), F.count_distinct("_repo").alias("n_repos"),
                                        F.count_distinct("_owner").alias("n_owners"))


def find_secrets(found: DataFrame) -> DataFrame:
    """One row per reported span of the written ``candidates``: _row, kind, start, end, n_repos, n_owners, verdict
    (``example`` or ``live``)."""
    spans = materialize(place(found), "secret-spans")
    held = match_keys(spans, materialize(ownership(spans), "secret-owners"), "_digest", "_n", spans.count())
    copied = (F.col("n_repos") >= MIN_REPOS) & (F.col("n_owners") >= MIN_OWNERS)
    return (held.where((F.col("_kind") < 3) | ~copied)
            .select("_row", "_kind", F.get(F.array(*map(F.lit, KINDS)), F.col("_kind")).alias("kind"), "start", "end", "n_repos", "n_owners",
                    F.when(copied, "example").otherwise("live").alias("verdict")))


def scan(docs: DataFrame, owner: Column, doc_id: str = "doc_id", text: str = "text", repo: str = "source") -> DataFrame:
    """One row per document: counts by kind, the digest of the fixed patterns' spans, all spans, verdicts."""
    found = materialize(candidates(docs, doc_id, text, F.col(repo), owner), "secret-candidates")
    told = find_secrets(found).withColumn("_s", F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")))
    by_doc = told.groupBy("_row").agg(
        *[F.count_if(F.col("_kind") == k).alias(f"n_{KINDS[k]}") for k in range(4)],
        F.count_if(F.col("verdict") == "live").alias("n_live"),
        F.array_sort(F.collect_list(F.struct("start", "_kind", "_s"))).alias("_all"))
    every = F.coalesce(F.col("_all"), F.array().cast("array<struct<start:bigint,_kind:int,_s:string>>"))
    text_of = lambda xs: F.array_join(F.transform(xs, lambda x: x["_s"]), ",")
    base = text_of(F.filter(every, lambda x: x["_kind"] < 3))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return found.select("_row", "doc_id").join(by_doc, "_row", "left").select(
        "doc_id", count("n_assign"), count("n_access"), count("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), text_of(every).alias("spans"), count("n_owned"), count("n_live"))
