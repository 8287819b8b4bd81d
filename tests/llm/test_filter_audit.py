"""Filter audit against a plain count over all orders."""

import re
from itertools import permutations

import pytest

from velorank.llm import filter_audit

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    fails = []
    for d, text, lang in docs:
        t = text or ""
        ws = re.findall("[^\x20\x09-\x0d]+", t)
        f = {"A": len(ws) < 100, "B": 100 * len(set(ws)) < 80 * len(ws), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
             "D": bool(re.search("[#$%&*|]", t)),
             "E": d is not None and any(e is not None and e < d and (u or "") == t for e, u, _ in docs)}
        own = [x for x in labels if d is not None and x[0] == d]
        fails.append((lang or "", {k for k, v in f.items() if v}, any(q == 1 for _, q, _ in own), any(x == 1 for _, _, x in own)))
    out = {}
    for part in {p for p, *_ in fails}:
        rows = [x[1:] for x in fails if x[0] == part]
        for order in permutations("ABCDE"):
            left = rows
            for i, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                out[part, "".join(order), i + 1] = [len(left), len(gone), sum(f in x[0] for x in rows) - len(gone), sum(x[0] == {f} for x in rows),
                                                   sum(x[1] for x in gone), sum(x[2] for x in gone)]
        for f in "ABCDE":
            total = sum(v[1] for (p, o, i), v in out.items() if p == part and o[i - 1] == f)
            for (p, o, i), v in out.items():
                if p == part and o[i - 1] == f:
                    v.append(total)
    return out


@pytest.fixture(scope="module")
def docs():
    words = [f"w{i}" for i in range(130)]
    clean = " ".join(words)
    return [(1, clean, "en"), (2, clean, "en"), (2, clean, "en"), (3, clean + " #", "en"), (4, "SHOUT " * 120, "de"), (5, "a b", None),
            (6, None, "de"), (7, "", "en"), (None, clean, "en"), (None, "", None), (8, "a b", "de"), (9, "A B C & d", "en"),
            (10, "\n".join(words[:99]) + " é😀", ""), (11, "x" * 70000, "en"), (12, " ".join(words) + " " + "y" * 5000, "de"), (0, "A B C & d", "fr")]


def test_all_orders_and_counts(spark, docs):
    labels = [(1, 1, 0), (2, 1, None), (2, None, 1), (3, 1, 1), (9, 0, 1), (None, 1, 1), (0, 1, 0), (77, 1, 1)]
    df = spark.createDataFrame([(*d, 7, "x", True, "y", "z", 1) for d in docs],
                               "doc_id long, text string, lang string, _row int, filter string, A boolean, _part string, before string, quality int")
    got = filter_audit.audit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    want = brute(docs, labels)
    assert {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in got} == want and len(got) == len(want)


def test_empty_tables(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(df.limit(0), labels).count() == 0
    got = filter_audit.audit(df, labels).where("step = 5").collect()
    assert sum(r["good_lost"] + r["toxic_lost"] for r in got) == 0 and {r["part"] for r in got} == {"en", "de", "fr", ""}


def test_hot_text_is_whole(spark):
    rows = [(i, "same text", "en") for i in range(3000)] + [(9000 + i, f"t {i // 2}", "en") for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = filter_audit.audit(df, spark.createDataFrame([], "doc_id long, quality int, toxic int")).where("filter_order = 'EABCD' and step = 1").collect()
    assert [r["removed"] for r in got] == [2999 + 1000]
