"""Secret scan against Python's regular expressions."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from velorank.llm import secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(docs):
    held, out = {}, []
    for d, text, source, owner in docs:
        t = text or ""
        base = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
        base += [(m.start(), 1, m.end(), m[0]) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        base += [(m.start(), 2, m.end(), m[0]) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
        more = [(m.start(), 3, m.end(), m[0]) for m in re.finditer("[A-Za-z0-9+/_=-]{20,}", t)
                if all(re.search(c, m[0]) for c in ("[A-Z]", "[a-z]", "[0-9]"))
                and not any(a < m.end() and z > m.start() for a, _, z, _ in base)]
        out.append((d, sorted(base + more)))
        for s in base + more:
            held.setdefault(s[3], []).append((source or "", owner or ""))
    names = ["assign", "access", "hex", "owned"]
    copied = {v for v, o in held.items() if len({x for x, _ in o}) >= 3 and len({x for _, x in o}) >= 2}
    rows = []
    for d, spans in out:
        spans = [s for s in spans if s[1] < 3 or s[3] not in copied]
        text = lambda xs: ",".join(f"{names[k]}:{a}:{z}" for a, k, z, _ in xs)
        n = [sum(s[1] == k for s in spans) for k in range(4)]
        rows.append(str((d, *n[:3], hashlib.sha256(text([s for s in spans if s[1] < 3]).encode()).hexdigest(), text(spans), n[3],
                         sum(s[3] not in copied for s in spans))))
    return sorted(rows)


@pytest.fixture(scope="module")
def docs():
    widely, own = "Abcdefghijklmnop1234567", "Zbcdefghijklmnop1234567"
    texts = ["", None, "no secrets", "password=hunter22", "PASSWORD : 'abc'", "api_key=\"abc.def/123\" apikey:x secret=token: abcdef",
             "é😀 token =  'aaaaaa' ſecret=abcdef toKen:abcdef", "AKIA" + "Z9" * 8, "AKIA" + "Z9" * 7 + "a" + "AKIAAKIA" + "Q" * 14, "f" * 23 + " " + "0a" * 12,
             "token=" + "0a" * 20, f"x {own} y {own}", f"{widely}", "token=abc " * 3000 + "secret=abcdefg", "passwd==abcdef\npasswd=\nabcdef",
             "d" * 100000, "password='" + "x" * 50000, "Ab1" * 10 + "AKIA" + "Z9" * 8]
    rows = [(i, t, "r1", "o1") for i, t in enumerate(texts)]
    rows += [(100 + i, f"{widely} here", f"r{i}", f"o{i % 3}") for i in range(5)] + [(200, widely, None, None), (None, own, "r1", "o1")]
    return rows + [rows[3], rows[3], rows[11]]


def test_whole_result(spark, docs):
    df = spark.createDataFrame([(*d, 1, "k", [1]) for d in docs], "doc_id long, text string, source string, owner string, _row int, _kind string, _found array<int>")
    got = secret_scan.scan(df, F.col("owner")).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(docs)


def test_verdicts_need_owners(spark):
    value = "token=abcdefgh"
    same_owner = [(i, value, f"r{i}", "o") for i in range(9)]
    df = spark.createDataFrame(same_owner, "doc_id long, text string, source string, owner string")
    assert {r["n_live"] for r in secret_scan.scan(df, F.col("owner")).collect()} == {1}
    more = df.union(spark.createDataFrame([(20, value, "q", "p")], df.schema))
    assert {r["n_live"] for r in secret_scan.scan(more, F.col("owner")).collect()} == {0}


def test_empty_table(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, owner string").limit(0)
    assert secret_scan.scan(df, F.col("owner")).count() == 0
