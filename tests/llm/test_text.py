"""Language ID, line deduplication, MinHash deduplication, LM scoring and HTML extraction against brute force."""

import collections
import html
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from velorank.llm import html_extract, language_id, line_dedup, lm_score, minhash_dedup, textcodes

SMOKE = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMOKE}/documents.parquet")


def words(t):
    return WORD.findall((t or "").translate(LOWER))


# ---- codes ----
def test_word_codes_name_words():
    texts = ["The cat\tthe\x0bCAT", "", None, "ünï the", "  ", "a" * 3_000_000 + " the"]
    seen = {}
    for i, j, data, offsets in textcodes.chunks(pa.array(texts)):
        codes, at = textcodes.word_codes(data, offsets)
        for d in range(i, j):
            own = codes[at[d - i]:at[d - i + 1]].tolist()
            assert len(own) == len(words(texts[d]))
            for w, c in zip(words(texts[d]), own):
                assert seen.setdefault(w, c) == c
    assert len(set(seen.values())) == len(seen) == 4 + 0


# ---- language ID ----
def test_language_held_out_accuracy(spark, documents):
    model = language_id.fit(language_id.training_rows(documents))
    got = language_id.classify(documents, model).where(language_id.held_out(F.col("doc_id"))).collect()
    assert len(got) > 40 and sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["lang_score"] <= 1 for r in got)


def test_language_cases(spark, documents):
    model = language_id.fit(documents)
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "12 !?", "x"), (4, "a", "x"), (5, "日本語 日本語", "x"), (6, "the and of " * 200_000, "x")],
                               "doc_id long, text string, lang_pred string")
    got = {r["doc_id"]: r for r in language_id.classify(df, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3 and [got[i]["lang_score"] for i in (1, 2, 3)] == [0.0] * 3
    assert got[4]["lang_pred"] == got[5]["lang_pred"] == "en" and got[5]["lang_score"] < 0.2 and got[6]["lang_pred"] == "en"
    empty = language_id.fit(documents.limit(0))
    assert {r["lang_pred"] for r in language_id.classify(df, empty).collect()} == {"und"}
    assert language_id.classify(df.limit(0), model).count() == 0


def test_more_than_64_languages(spark):
    rng = random.Random(3)
    vocab = {f"l{i:03d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)] for i in range(130)}
    df = spark.createDataFrame([(i, " ".join(vocab[lang] * 3), lang) for i, lang in enumerate(vocab)], "doc_id long, text string, lang string")
    got = language_id.classify(df, language_id.fit(df)).collect()
    assert len(got) == 130 and all(r["lang"] == r["lang_pred"] for r in got)


def test_language_clashing_columns(spark, documents):
    df = spark.createDataFrame([(1, "the house", "a", True, "b")], "doc_id long, text string, _letter string, __letter boolean, lang_pred string")
    got = language_id.classify(df, language_id.fit(documents)).first()
    assert (got["_letter"], got["__letter"]) == ("a", True) and got["lang_pred"] != "b"


# ---- line dedup ----
def brute_lines(docs, least):
    """Lines of maximal repeated runs that have an earlier copy, pair by pair."""
    lines = {d: [(k, s) for k, s in enumerate((t or "").split("\n")) if WORD.search(s)] for d, t in docs}
    place = [(d, j) for d, _ in docs for j in range(len(lines[d]))]
    gone = collections.defaultdict(set)
    for y, (d2, j2) in enumerate(place):
        for d1, j1 in place[:y]:
            n, w = 0, 0
            while j1 + n < len(lines[d1]) and j2 + n < len(lines[d2]) and lines[d1][j1 + n][1] == lines[d2][j2 + n][1]:
                w += len(WORD.findall(lines[d2][j2 + n][1]))
                n += 1
            if w >= least:
                gone[d2].update(lines[d2][j2 + m][0] for m in range(n))
    return gone


def test_line_dedup_against_brute_force(spark):
    rnd = random.Random(3)
    pool = [" ".join(f"w{rnd.randrange(40)}" for _ in range(rnd.choice([1, 4, 9, 30]))) for _ in range(14)]
    docs = [(d, "\n".join(rnd.choice(["", " ", *pool]) for _ in range(rnd.randrange(1, 14)))) for d in range(40)]
    docs += [(50, docs[3][1]), (51, "\n".join(["a b"] * 40)), (52, pool[0]), (53, ""), (54, None)]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, deleted long")
    want = brute_lines(docs, line_dedup.MIN_WORDS)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df.withColumnRenamed("deleted", "extra")).collect()}
    assert len(got) == len(docs) and any(want.values())
    for d, t in docs:
        assert set(got[d]["deleted_lines"]) == want[d], d
        if t is not None:
            assert got[d]["text"] == (t if not want[d] else "\n".join(s for k, s in enumerate(t.split("\n")) if k not in want[d]))
    assert got[51]["n_deleted"] > 30 and got[54]["text"] is None
    assert line_dedup.dedup_lines(df.limit(0).drop("deleted")).count() == 0


# ---- MinHash ----
def shingle_set(t, size=2):
    w = words(t)
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def classes(sets):
    root = {d: d for d in sets}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def variant(rnd, w, changes):
    w = list(w)
    for _ in range(changes):
        w[rnd.randrange(len(w))] = f"v{rnd.randrange(10**6)}"
    return " ".join(w)


def test_line_dedup_clashing_columns(spark):
    run = " ".join(f"w{i}" for i in range(30))
    rows = [(1, run, "p", 5, "q", "r"), (2, f"x\n{run}", "s", 6, "t", "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, deleted string, _d int, _H string, _deleted string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    assert (got[1]["text"], got[2]["text"], got[2]["n_deleted"]) == (run, "x", 1)
    assert [tuple(got[d][c] for c in ("deleted", "_d", "_H", "_deleted")) for d in (1, 2)] == [r[2:] for r in rows]


@pytest.fixture(scope="module")
def copies():
    rnd = random.Random(5)
    out = []
    for g in range(25):
        w = [f"g{rnd.randrange(3000)}" for _ in range(rnd.choice([3, 12, 60, 200]))]
        out += [variant(rnd, w, rnd.randrange(0, max(1, len(w) // 12) + 1)) for _ in range(rnd.randrange(1, 9))]
    return list(enumerate([*out, "", None, "one", "ONE", "one two", " "]))


@pytest.mark.parametrize("size", [2, 5])
def test_minhash_against_brute_force(spark, copies, size):
    sets = {d: shingle_set(t, size) for d, t in copies}
    want = classes(sets)
    df = spark.createDataFrame(copies, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in minhash_dedup.near_duplicates(df, size=size).collect()}
    assert len(got) == len(copies) and len(set(want.values())) < len(want)
    for d, _ in copies:
        assert (got[d]["n_shingles"], got[d]["component_id"], got[d]["kept"]) == (len(sets[d]), want[d], want[d] == d), d


def test_minhash_large_nodes_and_clusters(spark, copies, monkeypatch):
    """Tiny limits send everything through pivots and blocks; the classes stay."""
    for name, value in (("SMALL", 2), ("DEEPEST", 3), ("BLOCK_DOCS", 2)):
        monkeypatch.setattr(minhash_dedup, name, value)
    want = classes({d: shingle_set(t) for d, t in copies})
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(spark.createDataFrame(copies, "doc_id long, text string"), size=2).collect()}
    assert got == want


@pytest.mark.parametrize("changes", [18, 28])
def test_minhash_recall_in_deep_trees(spark, monkeypatch, changes):
    """One template group whose documents are half or a third alike: its tree nodes stay large and mixed for many
    levels.  Each document has one partner just above the limit."""
    monkeypatch.setattr(minhash_dedup, "SMALL", 2)
    rnd = random.Random(9)
    template = [f"t{i}" for i in range(100)]

    def fresh(w, changes):
        w = list(w)
        for i in rnd.sample(range(len(w)), changes):
            w[i] = f"v{rnd.randrange(10**9)}"
        return w

    docs = []
    for i in range(400):
        one = fresh(template, changes)
        docs += [(2 * i, " ".join(one)), (2 * i + 1, " ".join(fresh(one, 10)))]     # 90 of 110 words: 0.818
    got = {r["doc_id"]: r["component_id"] for r in minhash_dedup.near_duplicates(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), size=1).collect()}
    found = sum(got[2 * i] == got[2 * i + 1] == 2 * i for i in range(400))
    assert found >= 392 and all(got[d] in (d, d - d % 2) for d, _ in docs)


def test_minhash_cases(spark):
    df = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (7, "a b c"), (7, "x y z"), (8, "q r"), (9, None)], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"])) for r in minhash_dedup.near_duplicates(df).collect())
    assert got == sorted([("None", "7"), ("None", "7"), ("7", "7"), ("7", "7"), ("8", "8"), ("9", "9")])
    assert minhash_dedup.near_duplicates(df.limit(0)).count() == 0


# ---- LM ----
def brute_tree(texts, score, depth, share):
    """Context-tree weighting by recursion over a dictionary of counts; scores bytes one at a time."""
    counts = collections.defaultdict(collections.Counter)
    total = 0
    for t in texts:
        s = bytes([0xFF] * depth) + (t or "").encode().lower() + b"\xff"
        for i in range(depth, len(s)):
            total += 1
            for d in range(depth + 1):
                counts[s[i - d:i]][s[i]] += 1
    kept = {c for c, n in counts.items() if not c or sum(n.values()) >= max(total * share, 1)} | {b""}
    children = collections.defaultdict(list)
    for c in kept:
        if c:
            children[c[1:]].append(c)

    def bits(counter, node, bit):
        """Counts of both next bits below a node (its leading bits as a number)."""
        a = sum(n for s, n in counter.items() if s >> (8 - bit) == node and not s >> (7 - bit) & 1)
        return a, sum(n for s, n in counter.items() if s >> (8 - bit) == node) - a

    def log_kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def rest(c):
        out = collections.Counter(counts[c])
        for x in children[c]:
            out.subtract(counts[x])
        return out

    memo = {}

    def log_w(c, node, bit):
        if (c, node, bit) not in memo:
            e = log_kt(*bits(counts[c], node, bit))
            if len(c) == depth:
                memo[c, node, bit] = e
            else:
                p = log_kt(*bits(rest(c), node, bit)) + sum(log_w(x, node, bit) for x in children[c])
                memo[c, node, bit] = math.log(.5) + max(e, p) + math.log1p(math.exp(-abs(e - p)))
        return memo[c, node, bit]

    def predict(context, node, bit):
        path = [context[len(context) - d:] for d in range(depth + 1) if context[len(context) - d:] in kept]
        path = path[:next((i for i, c in enumerate(path) if len(c) != i), len(path))]
        q = None
        for c in reversed(path):
            a, b = bits(counts[c], node, bit)
            kt = (b + .5) / (a + b + 1)
            if len(c) == depth:
                q = kt
                continue
            if q is None:
                x, y = bits(rest(c), node, bit)
                q = (y + .5) / (x + y + 1)
            w = math.exp(math.log(.5) + log_kt(a, b) - log_w(c, node, bit))
            q = w * kt + (1 - w) * q
        return q

    out = []
    for t in score:
        s = bytes([0xFF] * depth) + (t or "").encode().lower() + b"\xff"
        lp = 0
        for i in range(depth, len(s)):
            for bit in range(8):
                one = predict(s[i - depth:i], s[i] >> (8 - bit), bit)
                lp += math.log10(one if s[i] >> (7 - bit) & 1 else 1 - one)
        out.append(lp)
    return out


def test_context_tree_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "DEPTH", 3)
    monkeypatch.setattr(lm_score, "MIN_SHARE", 0.02)
    train = ["abab abac", "the cat the hat", "abba", "", None, "hat cat é"]
    score = ["abac the", "zzz", None, "é\n~cat"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(train)], "doc_id long, text string")
    tree = lm_score.build_tree(*lm_score.tree_counts(lm_score.count_corpus(df))[1:])
    got = np.concatenate([lm_score.score_texts(tree, data, offsets) for _, _, data, offsets in textcodes.chunks(pa.array(score))])
    assert np.allclose(got, brute_tree(train, score, 3, 0.02), rtol=1e-5)
    assert np.allclose((10.0 ** tree.log10().astype(float)).sum(1), 1, atol=1e-4)


def test_lm_scores(spark, documents, monkeypatch):
    monkeypatch.setattr(lm_score, "COMMON_SHARE", 0.001)      # most words take the joined way
    docs = documents.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(10**6, None), (10**6 + 1, ""), (10**6 + 1, "zzzz zzzz the"), (None, "the of")], "doc_id long, text string"))
    got = lm_score.score_documents(docs, lm_score.training_rows(docs)).collect()
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    count = collections.Counter()
    for i, t in data:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            count.update([*words(t), None])
    n, v = sum(count.values()), len(count)
    want = sorted((str(i), len(words(t)) + 1, sum(count[w] > 0 for w in [*words(t), None]), n,
                   round(sum(math.log10((count[w] + .1) / (n + .1 * (v + 1))) for w in [*words(t), None]), 6)) for i, t in data)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == want
    assert all(r["score"] < 0 and r["bits_per_byte"] > 0 for r in got)
    assert lm_score.score_documents(docs.limit(0), docs).count() == 0
    assert lm_score.score_documents(docs, docs.limit(0)).count() == len(data)


@pytest.mark.parametrize("table", [1 << 21, 300, 0])
def test_lm_keeps_every_context(spark, monkeypatch, table):
    """More positions than 2^16, so a context of one occurrence is below every share; looked-up and joined grams."""
    monkeypatch.setattr(lm_score, "TABLE", table, raising=False)
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdet") for _ in range(rng.randint(2, 5))) for _ in range(60)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(250)) for _ in range(90)] + ["a singular quirk", None, ""]
    train = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = [texts[0], "a singular quirk", "singular quiz", "ZZZ ünseen", None, "", "abc quirk " * 50, "abc quirk " * 50]
    docs = spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm_score.score_documents(docs, train).collect()}
    monkeypatch.setattr(lm_score, "MIN_SHARE", 0)
    total, *counts = lm_score.tree_counts(lm_score.count_corpus(train))
    assert total > 1 << 16
    tree = lm_score.build_tree(*counts)
    want = np.concatenate([lm_score.score_texts(tree, data, offsets) for _, _, data, offsets in textcodes.chunks(pa.array(asked))])
    assert np.allclose([got[i] for i in range(len(asked))], want, rtol=1e-5)


# ---- HTML ----
def test_article_text_of_all_pages(spark):
    pages = spark.read.parquet(f"{SMOKE}/pages.parquet")
    got = {r["page_id"]: r for r in html_extract.extract(pages).collect()}
    for r in pages.collect():
        m = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        text = re.sub(r"\s+", " ", html.unescape(re.sub("</?b>", "", re.sub(r"</?(p|h1)>|<br>", " ", m)))).strip()
        assert got[r["page_id"]]["text"] == text and got[r["page_id"]]["n_chars"] == len(text)


PAGES = [
    ("<article><h1>T &amp; x</h1><p>one <b>two</b>th\nree<aside>side</aside><p>four</article><div class='comments'><article>no</article></div>", "T & x one twoth ree four"),
    ("<body><div class=cookie-notice>cookies</div><main><p>in&nbsp;main<script>if (a < b) '</p>'</script></p><form>f</form></main><footer>foot", "in main"),
    ("<div id='sidebar'>s</div><div class='content'>the <i>text</i><br>more<ul><li>a<li>b</ul></div><p>outside", "the text more a b"),
    ("<article>cut off <a href='x", "cut off"),
    ("<div class=ad>ad<article><p>in an unclosed advert</p></article>", "in an unclosed advert"),
    ("", ""), (None, ""), ("just text", "just text"), ("<p>a<!-- b --><style>c", "a"),
    ("<table><tr><td>x<td>y</table>", "x y"), ("<nav>n</nav><p>&lt;p&gt; 5 < 6", "<p> 5 < 6"),
]


def test_html_cases(spark):
    df = spark.createDataFrame([(i, f"http://h{i}.org/", p) for i, (p, _) in enumerate(PAGES)], "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert [got[i] for i in range(len(PAGES))] == [t for _, t in PAGES]
    assert html_extract.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ("<article class='post category-news comments-open'><p>kept</article>", "kept"), ("<body>x<article class='ad-free'>kept</article>", "kept"),
    ("<article class='related'><p>outermost</p><article class='related'>teaser</article></article>", "outermost"),
    ("<article><h2 id='social-impact'>a</h2><h3 id=legal>b</h3><p class='notice'>c<section id='legal-status'>d</section></article>", "a b c d"),
    ("<article>a<p class='notice-period'>b<div class='search-results'>c</div><div class='search'>no</div></article>", "a b c"),
    ("<article><p>the sum <math><mi>x</mi><mo>+</mo><mn>1</mn></math> is</article>", "the sum x+1 is"),
    ("<article><p>a <svg width='1'/> b</p><p>c<svg><text>no</text></svg></p></article>", "a b c"),
    ("<article><p>a <script src='x'/> b</p><p>c<script>no</script></p></article>", "a b c"),
    ("<article><div>a<button>no</div><p>b<span><video>no <i>no</i></span> c</p><div>d<object>no<div>no</div></div>e</article>", "a b c d e"),
    ("<article><p>a<button>no <b>no</b></button> b<textarea></p>no</textarea> c</p></article>", "a b c"),
    ("<head><title>no<body><article>kept</article>", "kept"),
    ("<article><p>a<select><option>no<option>no</select> b</p><p>c<title>no</p><p>d</p></article>", "a b c d"),
])
def test_html_keeps_article_text(page, text):
    stream, texts = html_extract.parse(page)
    top = [t for t, level in zip(texts, (int(k[1:]) for k in stream if k[0] == "#"), strict=True) if level == 4]
    assert " ".join(top) == text


def test_wrapper_finds_a_hosts_fixed_text(spark):
    page = "<div><b>My Site</b></div><div><p>story {0} here</p>{1}</div><div>All rights reserved</div>"
    df = spark.createDataFrame([(i, "http://plain.org/%d" % i, page.format(i, "<p>more %d</p>" % i * (i % 4))) for i in range(12)] + [(99, None, "<p>x")],
                               "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert all(got[i] == " ".join([f"story {i} here"] + [f"more {i}"] * (i % 4)) for i in range(12)) and got[99] == "x"


def test_wrapper_drops_fixed_text_inside_articles(spark):
    page = "<body><article><h1>{0}</h1><p>story {0}</p><div><b>Get our letter</b></div><p>more {0}</p></article></body>"
    copy = "<article><h1>one</h1><p>two</p></article>"
    df = spark.createDataFrame([(i, "http://a/", page.format(i)) for i in range(5)] + [(10 + i, "http://b/", copy) for i in range(5)],
                               "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert got == {**{i: f"{i} story {i} more {i}" for i in range(5)}, **{10 + i: "one two" for i in range(5)}}


def test_wrapper_is_a_union_free_expression():
    a, b = (html_extract.fold(html_extract.parse(p)[0]) for p in ("<h1>t</h1><ul><li>a</li></ul>", "<h1>t</h1><ul><li>a</li><li>b</li><li>c</li></ul><hr>"))
    w = html_extract.merge(*[[{"k": k, "opt": False, "n": 1 if s else 0, "same": None} for k, s in x] for x in (a, b)])
    assert ("+", ("li", "#1", "/li")) in [x["k"] for x in w] and [x["k"] for x in w if x["opt"]] == ["hr"]


def test_lm_counts_in_one_pass_equal_two(spark, documents):
    docs = documents.select("doc_id", "text").limit(60)
    once = lm_score.score_documents(docs, learns=lm_score.learned()).collect()
    twice = lm_score.score_documents(docs, lm_score.training_rows(docs)).collect()
    told = lambda rows: {r["doc_id"]: (r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows}
    assert told(once) == told(twice) and len(once) == docs.count()
