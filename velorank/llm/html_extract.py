"""HTML extraction with wrappers inferred per host as union-free regular expressions.

A page becomes a stream of block tags and text blocks; equal neighbours fold into repeated groups
``( ... )+``, which makes the streams of one template alike however long the page.  The distinct
streams of a host are aligned one after the other: what matches stays, what does not becomes an
optional group, so the result is a regular expression without unions whose text slots hold the
pages' data.  A slot's level says where the markup puts it (article, main, content, body, outside),
and the wrapper knows on how many pages a slot was filled and whether always with the same text.

A page's text is what its host's wrapper calls main.  The main part is the ``article`` (else
``main``, else a block named as content, else the body) without menus, headers, footers, sidebars,
notices, adverts, forms, scripts, styles and comments: tags and class names say where it is.  Slots
of one text that hold the same on all of several pages are boilerplate at every level, also inside an
article, unless the main part has no other slots (all pages are copies).  Which level is the main
part is the host's decision; a page without any text at that level falls back on its own highest one.

Null or blank html gives an empty text; a null or strange URL has the empty host.  Repeated rows give
equal results.  Nothing else inside the main part is dropped or cut.
"""

from __future__ import annotations

import html as H
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from velorank.llm.common import ascii_lower
from velorank.session import materialize

INLINE = set("a abbr acronym b bdi bdo big cite code del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr label data math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mstyle mfenced mover munder munderover mtable mtr mtd semantics annotation".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = set("script style template noscript iframe svg textarea select title object audio video canvas button".split())
OUTSIDE_TAGS = set("head nav header footer aside form menu dialog".split())
OUTSIDE_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner nav navbar navigation menu breadcrumb breadcrumbs sidebar footer masthead cookie cookies consent notice notices alert popup modal newsletter subscribe signup login search form share sharing social related recommended comment comments reply replies respond disqus widget toolbar pagination pager copyright legal topbar".split())
OUTSIDE_NAMES |= set("cookie-notice cookie-banner cookie-bar cookie-consent ad-banner ad-container ad-slot site-header site-footer page-footer site-nav main-nav main-menu nav-menu share-buttons social-share social-links related-posts related-articles comment-list comments-area comment-form newsletter-signup login-form search-form".split())
ADVERT_NAMES = set("ad ads advert adverts advertisement advertising sponsor sponsored promo promoted banner".split())
ARTICLE_OUTSIDE = set("ad ads advert advertisement promo sponsored related comment comments reply".split())
MAIN_NAMES = set("article content post entry story main article-body article-content post-content post-body entry-content story-body main-content page-content".split())
_MARKUP = re.compile(
    r"<!--.*?(?:-->|$)|<(script|style)\b[^>]*(?<!/)>.*?(?:</\1\s*>|$)|<(textarea|title|iframe)\b[^>]*(?<!/)>(?:(?!<\2\b).)*?</\2\s*>|<[!?][^>]*(?:>|$)|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|</?[a-z][^>]*(?:>|$)|</[^>]*>",
    re.I | re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPACE = re.compile(r"\s+")
OUTSIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form"}
SELF_CLOSING = set("p li tr td th dt dd option".split())
CLOSES_P = set("p div ul ol dl table section article aside nav footer header form main blockquote pre hr h1 h2 h3 h4 h5 h6".split())
NAMELESS = set("p h1 h2 h3 h4 h5 h6".split())               # text, whatever its class or id says
MAX_PERIOD = 12                    # tokens in a repeated group before it is folded


def parse(page: str) -> tuple[list[str], list[str]]:
    """(stream, texts): block tags, and for each text block ``#`` with its level: 0 outside the main
    part, 1 body, 2 a block named as content, 3 main, 4 article."""
    stream: list[str] = []
    texts: list[str] = []
    stack: list[tuple[str, int, int]] = [("", 0, 1)]         # tag, outside (1: advert, 2: other, 3: skipped), level
    held: list[str] = []

    def flush() -> None:
        while stack[-1][1] == 3:
            stack.pop()                                      # a skipped element ends with its parent
        if held:
            got = _SPACE.sub(" ", H.unescape("".join(held))).strip()
            held.clear()
            if got:
                stream.append(f"#{0 if stack[-1][1] else stack[-1][2]}")
                texts.append(got)

    at = 0
    for m in _MARKUP.finditer(page):
        if m.start() > at and stack[-1][1] != 3:
            held.append(page[at:m.start()])
        at = m.end()
        tag = (m.group(4) or "").lower()
        if tag == "body" and not m.group(3):
            flush()                                          # nothing of the head goes on
            stack[1:] = [x for x in stack[1:] if x[0] != "head"]
        if tag and (stack[-1][1] == 3 or tag in SKIPPED):
            empty = tag in VOID or tag not in INLINE and m.group(5).endswith("/")
            if not m.group(3):
                if not empty:
                    stack.append((tag, 3, stack[-1][2]))
                continue
            own = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][1] != 3 or stack[i][0] == tag), 0)
            if stack[own][1] == 3:
                del stack[own:]
                continue
            if tag in SKIPPED:
                continue                                     # closes nothing
            if tag in INLINE or any(x[0] == tag for x in stack):
                while stack[-1][1] == 3:
                    stack.pop()                              # the end of what is around it
            else:
                continue
        if not tag or tag in INLINE:
            continue
        flush()
        if m.group(3):                                       # a closing tag
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    stream.append("/" + tag)
                    break
                if stack[i][0] in ("article", "main", "body") and tag not in ("article", "main", "body", "html"):
                    break
            continue
        if tag in VOID:
            if tag != "br":
                stream.append(tag)
            continue
        names, role = set(), ""
        for k, *v in _ATTR.findall(m.group(5)) if "=" in m.group(5) else ():
            value = (v[0] or v[1] or v[2]).lower()
            if tag not in NAMELESS:
                names.update(value.replace("_", "-").split())
            role = value if k.lower() == "role" else role
        if stack[-1][0] == tag and tag in SELF_CLOSING or stack[-1][0] == "p" and tag in CLOSES_P:
            stack.pop()                                      # HTML closes these by itself
        _, outside, level = stack[-1]
        if tag == "body":
            outside, level, names = 0, 1, set()
        elif tag == "article":
            # an article inside an advert left open is still one; inside the others it is a teaser or a comment
            inside = any(o == 2 or o and t == "article" for t, o, _ in stack)
            nested = any(t == "article" for t, _, _ in stack)
            outside, level = 2 * (inside or nested and bool(names & ARTICLE_OUTSIDE)), 4
        elif tag == "main" or role == "main":
            outside, level = 0, max(level, 3)
        elif tag == "header" and level >= 3:
            pass                                             # an article's own heading
        elif tag in OUTSIDE_TAGS or names & OUTSIDE_NAMES or role in OUTSIDE_ROLES:
            outside = max(outside, 1 if tag not in OUTSIDE_TAGS and names & ADVERT_NAMES and not role else 2)
        elif names & MAIN_NAMES and level == 1:
            level = 2
        stack.append((tag, outside, level))
        mark = sorted(names & (OUTSIDE_NAMES | MAIN_NAMES))
        stream.append(".".join([tag, *mark]))
    if at < len(page):
        cut = re.search(r"<[/a-zA-Z!][^<]*$", page[at:])     # a tag cut off at the end
        if stack[-1][1] != 3:
            held.append(page[at:at + cut.start()] if cut else page[at:])
    flush()
    return stream, texts


Item = str | tuple


def fold(stream: list[str]) -> list[tuple[Item, list[int]]]:
    """Fold equal neighbouring groups that hold text into one ``("+", items)``; each item with its text slots."""
    keys: list[Item] = []
    slots: list[list[int]] = []
    slot = 0
    for t in stream:
        keys.append(t)
        if t[0] == "#":
            slots.append([slot])
            slot += 1
        else:
            slots.append([])
        again = True
        while again:
            again = False
            n, last = len(keys), keys[-1]
            for p in range(1, min(MAX_PERIOD, n - 1) + 1):
                k = keys[n - p - 1]
                if type(k) is tuple and len(k[1]) == p and k[1][-1] == last and k[1] == tuple(keys[n - p:]):
                    slots[n - p - 1:] = [[s for x in slots[n - p - 1:] for s in x]]      # one more of a group
                    del keys[n - p:]
                    again = True
                    break
                if k == last and 2 * p <= n and keys[n - 2 * p:n - p] == keys[n - p:] and any(slots[n - p:]):
                    slots[n - 2 * p:] = [[s for x in slots[n - 2 * p:] for s in x]]      # the second of a new group
                    keys[n - 2 * p:] = [("+", tuple(keys[n - p:]))]
                    again = True
                    break
    return list(zip(keys, slots))


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Longest common subsequence of two item lists, as index pairs."""
    i, pairs = 0, []
    while i < min(len(a), len(b)) and a[i] == b[i]:
        pairs.append((i, i))
        i += 1
    n, m, tail = len(a), len(b), []
    while n > i and m > i and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
        tail.append((n, m))
    best = [[0] * (m - i + 1) for _ in range(n - i + 1)]
    for x in range(n - 1, i - 1, -1):
        for y in range(m - 1, i - 1, -1):
            best[x - i][y - i] = best[x - i + 1][y - i + 1] + 1 if a[x] == b[y] else max(best[x - i + 1][y - i], best[x - i][y - i + 1])
    x = y = i
    while x < n and y < m:
        if a[x] == b[y]:
            pairs.append((x, y))
            x, y = x + 1, y + 1
        elif best[x - i + 1][y - i] >= best[x - i][y - i + 1]:
            x += 1
        else:
            y += 1
    return pairs + tail[::-1]


def one_as_group(items: list, groups: set) -> list[tuple[Item, list[int]]]:
    """Runs that appear once here but repeat on another page are read as the group of one."""
    out, i = [], 0
    sizes = sorted({len(g[1]) for g in groups}, reverse=True)
    while i < len(items):
        for k in sizes:
            g = ("+", tuple(x[0] for x in items[i:i + k]))
            if len(g[1]) == k and g in groups:
                out.append((g, [s for x in items[i:i + k] for s in x[1]]))
                i += k
                break
        else:
            out.append(items[i])
            i += 1
    return out


def merge(a: list[dict], b: list[dict]) -> list[dict]:
    """Align two wrappers; unmatched items become optional, texts that differ are data."""
    groups = {x["k"] for x in a + b if not isinstance(x["k"], str)}
    a, b = regroup(a, groups), regroup(b, groups)
    pairs = align([x["k"] for x in a], [x["k"] for x in b]) + [(len(a), len(b))]
    out, i, j = [], 0, 0
    for x, y in pairs:
        out += [{**w, "opt": True} for w in a[i:x]] + [{**w, "opt": True} for w in b[j:y]]
        if x < len(a):
            p, q = a[x], b[y]
            out.append({"k": p["k"], "opt": p["opt"] or q["opt"], "n": p["n"] + q["n"], "same": p["same"] if p["same"] == q["same"] else None})
        i, j = x + 1, y + 1
    return out


def freeze(k) -> Item:
    return k if isinstance(k, str) else (k[0], tuple(freeze(x) for x in k[1]))


def level_of(k: Item) -> int:
    """The highest level of an item's text slots; -1 if it has none."""
    if isinstance(k, str):
        return int(k[1:]) if k[0] == "#" else -1
    return max(map(level_of, k[1]))


def regroup(w: list[dict], groups: set) -> list[dict]:
    out = []
    for k, members in one_as_group([(x["k"], [i]) for i, x in enumerate(w)], groups):
        xs = [w[i] for i in members]
        out.append({"k": k, "opt": any(x["opt"] for x in xs), "n": max(x["n"] for x in xs), "same": xs[0]["same"] if len(xs) == 1 else None})
    return out


def read_page(page: str) -> tuple[list, list[str]]:
    stream, texts = parse(page)
    return fold(stream), texts


def choose(wrapper: list[dict], pages: int) -> tuple[int, list[bool]]:
    """(level of the host's main part, per item: is it the same text on every one of several pages?)"""
    top = max(1, max((level_of(w["k"]) for w in wrapper if 2 * w["n"] >= pages), default=1))
    fixed = [pages > 2 and w["same"] is not None and w["n"] == pages for w in wrapper]
    data = any(level_of(w["k"]) >= top and not f for w, f in zip(wrapper, fixed, strict=True))
    return top, [f and data for f in fixed]


class Reader:
    """Reads pages with their host's wrapper; what a wrapper says about a stream is worked out once."""

    def __init__(self, wrapper: list[dict], pages: int):
        self.keys = [w["k"] for w in wrapper]
        self.groups = {k for k in self.keys if not isinstance(k, str)}
        self.top, self.fixed = choose(wrapper, pages)
        self.known: dict[tuple, list[bool]] = {}

    def dropped(self, keys: tuple) -> list[bool]:
        """Per item of a stream: does the wrapper call it the host's fixed text?"""
        if keys not in self.known:
            if len(self.known) > 1000:
                self.known.clear()
            read = one_as_group([(k, [i]) for i, k in enumerate(keys)], self.groups)
            out = [False] * len(keys)
            for i, j in align([x[0] for x in read], self.keys):
                for item in read[i][1]:
                    out[item] = self.fixed[j]
            self.known[keys] = out
        return self.known[keys]

    def main_text(self, items: list, texts: list[str]) -> str:
        """A page that has nothing at the host's main level falls back on its own highest level."""
        levels = slot_levels(items, len(texts))
        drop = {s for (_, slots), gone in zip(items, self.dropped(tuple(k for k, _ in items)), strict=True) if gone for s in slots}
        least = self.top if any(lv >= self.top for lv in levels) else max([1, *levels])
        return " ".join(t for s, t in enumerate(texts) if levels[s] >= least and s not in drop)


def slot_levels(items: list, n: int) -> list[int]:
    """Levels by slot number: a group's slots repeat its pattern."""
    def pattern(k: Item) -> list[int]:
        return ([int(k[1:])] if k[0] == "#" else []) if isinstance(k, str) else [x for i in k[1] for x in pattern(i)]

    out = [0] * n
    for k, slots in items:
        if slots:
            p = pattern(k)
            for i, s in enumerate(slots):
                out[s] = p[i % len(p)]
    return out


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def host_wrappers(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper as JSON) from (host, html).

    Pages are first counted by host and stream, with the smallest and the largest hash of each
    item's text instead of the texts.  A host's distinct streams merge in batches of about the
    square root of their number, then the batches' wrappers, so no task sees a host's pages."""
    def streams(batches):
        import xxhash
        for b in batches:
            seen: dict[tuple[str, str], list] = {}
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                items, texts = read_page(page)
                key = json.dumps([k for k, _ in items], ensure_ascii=False, separators=(",", ":"))
                same = [xxhash.xxh64_intdigest(texts[s[0]].encode()) >> 1 if len(s) == 1 else None for _, s in items]
                got = seen.setdefault((host, key), [0, same, same])
                got[0] += 1
                if got[0] > 1:
                    got[1] = [x if x is None else min(x, y) for x, y in zip(got[1], same, strict=True)]
                    got[2] = [x if x is None else max(x, y) for x, y in zip(got[2], same, strict=True)]
            yield pa.RecordBatch.from_pydict(
                {"host": [h for h, _ in seen], "stream": [k for _, k in seen], "n": [v[0] for v in seen.values()],
                 "lo": [v[1] for v in seen.values()], "hi": [v[2] for v in seen.values()]},
                pa.schema([("host", pa.string()), ("stream", pa.string()), ("n", pa.int64()), ("lo", pa.list_(pa.int64())), ("hi", pa.list_(pa.int64()))]))

    told = pages.select("host", "html").mapInArrow(streams, "host string, stream string, n long, lo array<long>, hi array<long>")
    items = told.select("host", "stream", "n", F.posexplode_outer(F.arrays_zip("lo", "hi")).alias("item", "t")) \
        .groupBy("host", "stream", "item").agg(F.sum("n").alias("n"), F.min("t.lo").alias("lo"), F.max("t.hi").alias("hi"))
    distinct = items.groupBy("host", "stream").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("item", "lo", "hi"))).alias("items")) \
        .withColumn("sid", F.xxhash64("stream"))
    distinct = materialize(distinct, "html-streams")

    def folded(pdf, wrappers):
        import pandas as pd
        whole, pages = None, 0
        for w, n in wrappers:
            whole = w if whole is None else merge(whole, w)
            pages += n
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "pages": [pages], "wrapper": [json.dumps(whole, ensure_ascii=False)]})

    def first(pdf):
        def seeds():
            for r in pdf.sort_values(["n", "stream"], ascending=[False, True]).itertuples():
                keys = [freeze(k) for k in json.loads(r.stream)]
                same = [x["lo"] if x["lo"] == x["hi"] else None for x in r.items_]
                yield [{"k": k, "opt": False, "n": int(r.n) if level_of(k) >= 0 else 0, "same": None if s is None else int(s)}
                       for k, s in zip(keys, same)], int(r.n)
        pdf = pdf.rename(columns={"items": "items_"})
        return folded(pdf, seeds())

    def second(pdf):
        return folded(pdf, (([{**x, "k": freeze(x["k"])} for x in json.loads(r.wrapper)], int(r.pages))
                            for r in pdf.sort_values(["pages", "wrapper"], ascending=[False, True]).itertuples()))

    many = distinct.groupBy("host").agg(F.ceil(F.sqrt(F.count(F.lit(1)))).cast("long").alias("_many"))
    kind = "host string, pages long, wrapper string"
    batches = distinct.join(many, "host").withColumn("_batch", F.pmod("sid", "_many"))
    return batches.groupBy("host", "_batch").applyInPandas(first, kind).groupBy("host").applyInPandas(second, kind)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, host, text, n_chars, wrapper_pages."""
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"),
                        F.coalesce(F.col(html), F.lit("")).alias("html"))
    wrappers = materialize(host_wrappers(rows), "html-wrappers")
    joined = rows.join(wrappers, "host", "left")
    kind = rows.schema["page_id"].dataType.simpleString()

    def run(batches):
        read: dict[str, Reader] = {}
        for b in batches:
            texts = []
            for page, wrapper, n in zip(*(b.column(c).to_pylist() for c in ("html", "wrapper", "pages")), strict=True):
                if wrapper not in read:
                    if len(read) > 1000:
                        read.clear()
                    read[wrapper] = Reader([{**x, "k": freeze(x["k"])} for x in json.loads(wrapper or "[]")], n or 0)
                texts.append(read[wrapper].main_text(*read_page(page)))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), b.column("host"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()),
                 b.column("pages")], ["page_id", "url", "host", "text", "n_chars", "wrapper_pages"])

    return joined.mapInArrow(run, f"page_id {kind}, url string, host string, text string, n_chars long, wrapper_pages long")
