"""The pipeline against a brute-force version of its stages on a few documents."""

import random

import corpus_pipeline as P
from test_text import brute_lines, classes, shingle_set, words

from velorank.llm import line_dedup

WORDS = "the and of ing tion er that this with from are was for on it by be as or an".split()


def make(spark, tmp_path):
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "ed", "er", "ly"]) for _ in range(n))
    shared = text(60)
    docs = [(i, "\n".join([text(40), *([shared] if i % 6 == 0 else []), text(30)])) for i in range(60)]
    docs += [(100 + i, docs[i][1]) for i in range(5)]
    docs += [(200 + i, docs[20 + i][1].replace("\n", " ") + " extra") for i in range(4)]
    docs += [(300, None), (301, ""), (302, "123 456")]
    rows = [(d, t, "en", f"src{d % 3}", len(t or "")) for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    return docs


def test_pipeline(spark, tmp_path):
    docs = make(spark, tmp_path)
    got = P.run(spark, str(tmp_path)).collect()
    left = [(d, t) for d, t in docs if t and any(c.isalpha() for c in t)]
    gone = brute_lines(left, line_dedup.MIN_WORDS)
    lined = [(d, "\n".join(s for k, s in enumerate(t.split("\n")) if k not in gone[d])) for d, t in left]
    lined = [(d, t) for d, t in lined if words(t)]
    groups = classes({d: shingle_set(t, 5) for d, t in lined})
    kept = {d: len(words(t)) for d, t in lined if groups[d] == d}
    packed = {}
    for r in got:
        packed[r["doc_id"]] = packed.get(r["doc_id"], 0) + r["n_tokens"]
    assert set(packed) <= set(kept) and all(packed[d] == kept[d] for d in packed)
    budget = sum(kept.values()) * 9 // 10
    assert budget - 3 * max(kept.values()) <= sum(packed.values()) <= budget
    assert 0 in packed or 0 in kept and not {100, 101, 102, 103, 104} & set(packed)


def test_stages_keep_columns_and_take_empty_tables(spark, tmp_path):
    make(spark, tmp_path)
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_repeated_rows_null_ids_and_clashing_columns(spark, tmp_path):
    rnd = random.Random(4)
    text = lambda n: " ".join(rnd.choice(WORDS) + rnd.choice(["", "s", "ed", "er", "ly"]) for _ in range(n))
    base, other, lone, again = text(80), text(80), text(80), text(80)
    docs = [(None, base), (None, base + " more"), (None, base), (None, other), (4, other), (5, lone), (5, lone), (5, again), (6, again)]
    docs += [(100 + i, text(80)) for i in range(12)]                # to learn from
    extra = {c: f"x{i}" for i, c in enumerate(["_row", "_kept", "_picked", "_lang", "_score", "_d", "deleted", "N_deleted", "_letter"])}
    df = spark.createDataFrame([(d, t, "en", "s", len(t), *extra.values()) for d, t in docs],
                               "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    seen = {}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.columns == df.columns
        rows = out.collect()
        assert all(tuple(r[c] for c in extra) == tuple(extra.values()) for r in rows), name
        seen[name] = sorted((str(r["doc_id"]), r["text"]) for r in rows)
    assert len(seen["language_id"]) == len(docs)
    left = seen["minhash_dedup"]
    assert [d for d, _ in left].count("None") == 1 and ("4", other) in left
    assert left.count(("5", lone)) == 1 and left.count(("5", again)) == 1 and ("6", again) not in left and len(left) == 4 + 12
    assert set(seen["source_mixing"]) < {(str(d), t) for d, t in docs}
