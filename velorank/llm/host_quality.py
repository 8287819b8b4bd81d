"""Quality rules with host-level verdicts (native).

Every document is measured by built-in expressions and checked against document rules; the
failures of each rule are summed by host, every host's failure rate is shrunk towards the corpus
by an empirical beta prior, and a host takes its documents with it if its rate of some rule is surely (``SURE`` deviations of its
posterior) above what ``HOST_ODDS`` times the corpus's odds come to.

A document is kept unless it fails a rule itself or its host's verdict is bad.  Texts that are
null or blank have no words and fail the first rule.  A null host is a host of its own for the
counts but never judged bad.  An empty table gives an empty result.  Repeated rows count each; a host
exactly at its limit is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from velorank.llm.common import let, words
from velorank.session import materialize

MIN_WORDS = 50                     # fewer words: the document fails
MAX_REPEAT_PERCENT = 50            # of the words stand in repeated three-word windows
SYMBOLS = "#*$%&|<>"
MAX_SYMBOLS_PER_100_WORDS = 10
MAX_DUP_LINE_PERCENT = 30
MEAN_WORD = (2, 15)                # characters
HOST_ODDS = 10                     # a bad host's odds of failing one rule, in odds of the corpus
HOST_RATE = (0.2, 0.5)             # the limit that follows from them lies between these
SURE = 2                           # standard deviations of the posterior that a bad host lies above its limit
BLANKS = " \t\n\x0b\x0c\r"

RULES = ["fail_short", "fail_repeats", "fail_symbols", "fail_dup_lines", "fail_word_length"]
STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeat_words(ws: Column) -> Column:
    """Words that stand in a three-word window found twice or more: sort the windows' hashes with
    their places, keep places whose neighbour has the same hash, and count what they cover."""
    n = F.size(ws)
    windows = F.when(n >= 4, F.transform(
        F.sequence(F.lit(0), F.greatest(n - 3, F.lit(0))),
        lambda i: F.struct(F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)).alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        hits = F.filter(s, lambda x, j: same(x, j - 1) | same(x, j + 1))
        return F.size(F.array_distinct(F.flatten(
            F.transform(hits, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return F.when(n >= 4, let(F.array_sort(windows), covered)).otherwise(0).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the columns of ``STATS``."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    ws = let(words(F.col(text)), lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    counted = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    return (docs.withColumns({
        "_w": ws, "_l": counted,
        "word_chars": F.length(F.translate(t, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long")})
        .withColumns({"n_words": F.col("_w.n"), "n_repeat_words": F.col("_w.r"),
                      "n_lines": F.col("_l.n"), "n_dup_lines": F.col("_l.d")})
        .drop("_w", "_l"))


def rule_failures() -> dict[str, Column]:
    """Document rules over the columns of ``measure``; integer arithmetic only."""
    c = F.col
    return {
        "fail_short": c("n_words") < MIN_WORDS,
        "fail_repeats": 100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * c("n_words"),
        "fail_symbols": 100 * c("n_symbols") > MAX_SYMBOLS_PER_100_WORDS * c("n_words"),
        "fail_dup_lines": 100 * c("n_dup_lines") > MAX_DUP_LINE_PERCENT * c("n_lines"),
        "fail_word_length": (c("word_chars") < MEAN_WORD[0] * c("n_words")) | (c("word_chars") > MEAN_WORD[1] * c("n_words")),
    }


def host_verdicts(measured: DataFrame, host: str) -> DataFrame:
    """One row per host: documents, failures and shrunk rate of every rule, ``host_bad``.

    Prior of a rule: the beta distribution with the mean and the variance of the hosts' rates."""
    hosts = measured.groupBy(host).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(F.col(r).cast("long")).alias(r) for r in RULES])
    prior = hosts.agg(*[x for r in RULES for x in (
        (F.sum(r) / F.sum("_n")).alias(f"{r}_m"), F.var_pop(F.col(r) / F.col("_n")).alias(f"{r}_v"))])
    p = prior.first()                          # one row: the corpus's mean and variance of every rule

    def mean_and_strength(r: str) -> tuple[float, float]:
        mean, var = p[f"{r}_m"] or 0.0, p[f"{r}_v"] or 0.0
        return mean, min(1e6, max(1.0, mean * (1 - mean) / var - 1 if var > 0 else 1e6))

    def rate(r: str) -> Column:
        mean, strength = mean_and_strength(r)
        return (F.col(r) + F.lit(mean * strength)) / (F.col("_n") + F.lit(strength))

    def bad(r: str) -> Column:
        mean, strength = mean_and_strength(r)
        limit = min(HOST_RATE[1], max(HOST_RATE[0], HOST_ODDS * mean / (1 + (HOST_ODDS - 1) * mean)))
        own = F.col(r.replace("fail", "rate"))
        return own - SURE * F.sqrt(own * (1 - own) / (F.col("host_docs") + F.lit(strength) + 1)) > limit

    rated = hosts.select(host, F.col("_n").alias("host_docs"), *[rate(r).alias(r.replace("fail", "rate")) for r in RULES])
    any_bad = F.lit(False)
    for r in RULES:
        any_bad = any_bad | bad(r)
    return rated.withColumn("host_rate", F.greatest(*[F.col(r.replace("fail", "rate")) for r in RULES])).withColumn(
        "host_bad", F.col(host).isNotNull() & any_bad)


def judge_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: id, host, measures, rule failures, host rate, ``base_failed``, ``kept``.

    Texts are read once; the narrow measures are written and serve both the host counts and the join."""
    measured = measure(docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text")))
    table = materialize(measured.drop("text").withColumns(rule_failures()), "host-quality")
    hosts = host_verdicts(table, "host")
    own = F.lit(False)
    for r in RULES:
        own = own | F.col(r)
    return (table.join(hosts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
            .withColumn("base_failed", F.col("fail_short") | F.col("fail_repeats"))
            .withColumn("kept", ~(own | F.col("host_bad"))))
