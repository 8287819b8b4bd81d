"""Packing into length buckets that minimise padding.

A document is cut into sequences of at most ``SEQUENCE`` tokens; every sequence is padded to the
bound of its bucket.  A global histogram of sequence lengths (at most ``SEQUENCE`` entries) goes to
the driver, where dynamic programming finds the bounds with the least padding in all.  Inside a
bucket, sequences in a seeded order form batches of as many as the token budget holds.

Tokens are words unless a token-count column is given.  Documents without tokens give no sequence.
An empty table gives no buckets.  Null ids and repeated rows are packed like others.  Only the id and
the text (or the token count) are read; other columns don't matter.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, functions as F

from velorank.llm.common import running_sum, seeded_order, words
from velorank.session import materialize

SEQUENCE = 2048
BUCKETS = 16
BATCH_TOKENS = 65_536
SEED = 42


def bucket_bounds(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least sum of (bound - length) * count.

    best[j] is the least padding of the first j lengths with the buckets so far; the last bucket
    holds lengths i..j-1 and costs lengths[j-1] * (C[j] - C[i]) - (S[j] - S[i])."""
    n = len(lengths)
    if not n:
        return []
    c = np.concatenate([[0], np.cumsum(counts)]).astype(float)
    s = np.concatenate([[0], np.cumsum(lengths * counts)]).astype(float)
    best = np.full(n + 1, np.inf)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, n)):
        new, cut = best.copy(), np.full(n + 1, -1)
        for j in range(1, n + 1):
            cost = best[:j] + lengths[j - 1] * (c[j] - c[:j]) - (s[j] - s[:j])
            i = int(cost.argmin())
            if cost[i] < new[j]:
                new[j], cut[j] = cost[i], i
        best = new
        cuts.append(cut)
    bounds, j = [], n
    for cut in reversed(cuts):
        if cut[j] >= 0:
            bounds.append(int(lengths[j - 1]))
            j = int(cut[j])
        if j == 0:
            break
    return bounds[::-1]


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokens: str | None = None, sequence: int = SEQUENCE,
         buckets: int = BUCKETS, batch_tokens: int = BATCH_TOKENS, seed: int | str = SEED) -> DataFrame:
    """One row per sequence: doc_id, seq, start (first token), n_tokens, bucket, padded, batch, slot."""
    n = F.col(tokens).cast("long") if tokens else F.size(words(F.col(text))).cast("long")
    counted = docs.select(F.col(doc_id).alias("doc_id"), n.alias("_n")).where("_n > 0")
    rows = counted.select("doc_id", "_n", F.explode(F.expr(f"sequence(0L, (_n - 1) div {sequence})")).alias("seq")).select(
        "doc_id", "seq", (F.col("seq") * sequence).alias("start"), F.least(F.lit(sequence), F.col("_n") - F.col("seq") * sequence).alias("n_tokens"))
    rows = materialize(rows.withColumn("_u", seeded_order(seed, F.col("doc_id"), F.col("seq"))), "sequences")
    histogram = rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).orderBy("n_tokens").collect()   # at most `sequence` rows
    bounds = bucket_bounds(np.array([r["n_tokens"] for r in histogram], np.int64), np.array([r["n"] for r in histogram], np.int64), buckets)
    # the bounds a length exceeds give its bucket
    bucket = sum(((F.col("n_tokens") > b).cast("int") for b in bounds), F.lit(0))
    named = rows.withColumn("bucket", bucket).withColumn("padded", F.element_at(F.array(*[F.lit(b).cast("long") for b in bounds or [sequence]]), F.col("bucket") + 1)) \
        .withColumn("_1", F.lit(1).cast("long"))
    named = materialize(named, "bucketed")
    ranked = running_sum(named, ["bucket"], "_u", ["doc_id", "seq"], "_1", "_rank")
    room = F.greatest(F.lit(1).cast("long"), F.floor(F.lit(batch_tokens) / F.col("padded")))
    return ranked.withColumn("batch", F.floor(F.col("_rank") / room)).withColumn("slot", F.col("_rank") % room) \
        .select("doc_id", "seq", "start", "n_tokens", "bucket", "padded", "batch", "slot")
