"""Importance resampling against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from velorank.llm import importance


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    ws = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    return ws, [zlib.crc32(f.encode()) % 10000 for f in ws + [" ".join(p) for p in zip(ws, ws[1:])]]


def brute(docs, target, share, min_words):
    s, t = Counter(), Counter()
    for _, x in docs:
        s.update(features(x)[1])
    for x in target:
        t.update(features(x)[1])
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for i, (d, x) in enumerate(docs):
        ws, fs = features(x)
        g = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in fs]
        w = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append((d, len(ws), len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), i))
    able = sorted((r for r in rows if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[5]))
    drawn = able[:share[0] * len(able) // share[1]]
    rank = {r[5]: k + 1 for k, r in enumerate(drawn)}
    return sorted(str((*r[:5], rank.get(r[5]))) for r in rows)


def got(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_whole_result(spark):
    rng = np.random.default_rng(5)
    vocab = ["Alpha", "beta", "ñandú", "x" * 64, "y" * 65, "z" * 200, "w" * 129, "a1", "ÉCOLE", "中文", "it's", "\x00q", "\x80"]
    docs = [(int(i), " ".join(rng.choice(vocab, int(rng.integers(0, 60))))) for i in range(120)]
    docs += [(1, docs[1][1]), (1, docs[1][1]), (None, docs[2][1]), (None, None), (200, None), (201, ""), (202, "?! "), (203, "word " * 30000)]
    target = ["alpha beta alpha beta", None, "école a1 ñandú"]
    df = spark.createDataFrame([(*d, 1, 2, 3.0) for d in docs], "doc_id long, text string, _row long, rank long, score double").repartition(5)
    tdf = spark.createDataFrame([(x,) for x in target], "text string")
    for share, least in (((25, 100), 20), ((1, 1), 0), ((1, 1000), 20)):
        assert got(importance.resample(df.coalesce(1), tdf, share, least)) == brute(docs, target, share, least)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "text string")
    assert importance.resample(docs.limit(0), none).count() == 0
    assert got(importance.resample(docs, none, min_words=0, share=(1, 1))) == brute([(1, "a b"), (2, None)], [], (1, 1), 0)


def test_bracket_with_massive_ties(spark):
    df = spark.range(5000).select(F.when(F.col("id") < 4000, F.lit(7)).otherwise(F.col("id")).cast("long").alias("score"))
    for wanted in (1, 999, 1000, 1001, 2500, 5000):
        low, high, above = importance.bracket(df, "score", 5000, wanted, accuracy=100)
        value = sorted([7] * 4000 + list(range(4000, 5000)), reverse=True)[wanted - 1]
        assert low <= value <= high and above == df.where(F.col("score") > high).count() < wanted
    wide = importance.bracket(spark.range(100000).withColumnRenamed("id", "score"), "score", 100000, 25000)
    assert wide[1] - wide[0] < 1000
