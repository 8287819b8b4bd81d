"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from velorank.llm.mixing import BUDGET, EPOCHS, SEED, WEIGHTS
from velorank.llm.url_filter import DEFAULT, HOST_RULES, PATTERN_RULES

_SPACES = r"[\x20\x09-\x0D]+"


def _url_filter() -> str:
    subject = "host || path"
    hosts = sorted(HOST_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [(f"((host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}'))", h + p, v) for h, p, v in hosts]
    pats = [(f"regexp_matches({subject}, '{p}')", n, v) for n, _, p, v in reversed(PATTERN_RULES)]
    case = lambda rows, k, other: "case " + " ".join(f"when {r[0]} then '{r[k]}'" for r in rows) + f" {other} end"
    return f"""
with parts as (
  select page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') as h,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
lowered as (
  select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from parts),
ruled as (
  select *, {case(fits, 1, "")} as rule, {case(fits, 2, "")} as rule_verdict,
         {case(pats, 1, "")} as pattern, {case(pats, 2, "")} as pattern_verdict
  from lowered)
select page_id, host, path, rule, coalesce(rule_verdict, pattern_verdict, '{DEFAULT}') as verdict,
       case when rule is null then pattern end as pattern_rule
from ruled"""


def weight_sql(level: str, weights: dict) -> str:
    whens = " ".join(f"when {level} = '{n}' then {w}" for n, w in weights.get(level, {}).items())
    return f"(case {whens} else 1 end)::hugeint" if whens else "1::hugeint"


def mixing_ctes(rows: str, levels: list[str], weights: dict, epochs: int, budget: tuple[int, int], seed) -> str:
    """CTEs from ``rows`` (doc_id, levels, n_tokens) to ``selected``."""
    out = [f"leaves as (select {', '.join(levels)}, sum(n_tokens)::hugeint as tokens from {rows} group by all)",
           f"""given0 as (select 0 as root, least(sum(tokens) * {budget[0]} // {budget[1]}, sum(tokens) * {epochs})::hugeint as budget
               from leaves)"""]
    parents = ["root"]
    for i, level in enumerate(levels):
        key = ", ".join([*parents, level])
        by = ", ".join(parents)
        out.append(f"""
kids{i} as (
  select {key}, budget, cap, {weight_sql(level, weights)} as w
  from (select 0 as root, {', '.join(levels[:i + 1])}, sum(tokens * {epochs})::hugeint as cap from leaves group by all) c
  join given{i} using ({by})),
sorted{i} as (
  select *, coalesce(sum(cap) over (partition by {by} order by cap::double / w::double, {level}
                      rows between unbounded preceding and 1 preceding), 0)::hugeint as before,
         sum(w) over (partition by {by} order by cap::double / w::double, {level}
                      rows between current row and unbounded following)::hugeint as w_from
  from kids{i}),
full{i} as (select *, cap * w_from <= (budget - before) * w as is_full from sorted{i}),
rest{i} as (
  select *, (budget - coalesce(sum(case when is_full then cap end) over (partition by {by}), 0))::hugeint as rest,
         (sum(case when not is_full then w end) over (partition by {by}))::hugeint as w_rest
  from full{i}),
floors{i} as (
  select *, case when not is_full then rest * w // w_rest end as q, case when not is_full then rest * w % w_rest end as rem
  from rest{i}),
ranked{i} as (
  select *, rest - coalesce(sum(q) over (partition by {by}), 0) as over_,
         row_number() over (partition by {by} order by is_full, rem desc nulls last, {level}) as i
  from floors{i}),
given{i + 1} as (
  select {key}, (case when is_full then cap else q + (case when i <= over_ then 1 else 0 end) end)::hugeint as budget
  from ranked{i})""")
        parents.append(level)
    names = ", ".join(levels)
    out.append(f"""
plan as (
  select l.*, g.budget as leaf_budget, case when tokens > 0 then budget // tokens else 0 end as passes,
         case when tokens > 0 then budget % tokens else 0 end as part
  from leaves l join given{len(levels)} g using ({names})),
dealt as (
  select r.*, leaf_budget, passes, part,
         ('0x' || substr(md5('{seed}:' || passes::bigint::varchar || ':' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as u
  from {rows} r join plan using ({names})),
starts as (
  select *, coalesce(sum(n_tokens) over (partition by {names} order by u, doc_id
                     rows between unbounded preceding and 1 preceding), 0) as start_
  from dealt where part > 0),
selected as (
  select doc_id, {names}, n_tokens, unnest(range(0, passes::bigint)) as epoch, leaf_budget from dealt where passes > 0
  union all
  select doc_id, {names}, n_tokens, passes::bigint as epoch, leaf_budget from starts where start_ + n_tokens <= part)""")
    return ",\n".join(out)


def word_count_sql(text: str = "text") -> str:
    return f"len(list_filter(regexp_split_to_array(coalesce({text}, ''), '{_SPACES}'), lambda w: w <> ''))::bigint"


def crc32_mod4_sql() -> str:
    """crc32 modulo 4 needs the checksum's lowest two bits only, yet DuckDB has no crc32: bit by bit in a recursive query."""
    return """
bytes as (
  select source, 1 as i, 4294967295::bigint as c, hex(coalesce(source, '')::blob) as h from (select distinct source from documents)),
crc as (
  select source, i, c, h from bytes
  union all
  select source, i + 1,
         list_reduce([xor(c, ('0x' || substr(h, 2 * i - 1, 2))::bigint), 0, 0, 0, 0, 0, 0, 0, 0],
                     lambda a, b: xor(a // 2, case when a % 2 = 1 then 3988292384::bigint else 0 end)) as c, h
  from crc where 2 * i <= length(h)),
domains as (
  select source, 'd' || (xor(arg_max(c, i), 4294967295::bigint) % 4)::varchar as domain from crc group by source)"""


def _mixing() -> str:
    return f"""
with recursive {crc32_mod4_sql()},
rows as (
  select doc_id, domain, coalesce(lang, '') as lang, coalesce(d.source, '') as source, {word_count_sql()} as n_tokens
  from documents d join domains s on d.source is not distinct from s.source),
{mixing_ctes("rows", ["domain", "lang", "source"], WEIGHTS, EPOCHS, BUDGET, SEED)}
select doc_id, domain, lang, source, n_tokens, epoch, leaf_budget::bigint as leaf_budget from selected"""


def _host_quality() -> str:
    from velorank.llm import host_quality as Q
    rules = Q.RULES
    rate = lambda r: f"({r} + {r}_m * {r}_k) / (n + {r}_k) as {r}_p"
    limit = lambda r: f"least({Q.HOST_RATE[1]}, greatest({Q.HOST_RATE[0]}, {Q.HOST_ODDS} * {r}_m / (1 + {Q.HOST_ODDS - 1} * {r}_m)))"
    bad = lambda r: f"{r}_p - {Q.SURE} * sqrt({r}_p * (1 - {r}_p) / (n + {r}_k + 1)) > {limit(r)}"
    return f"""
with docs as (select row_number() over () as id, doc_id, source, coalesce(text, '') as text from documents),
word as (
  select id, unnest(ws) as w, unnest(range(len(ws))) as i
  from (select id, list_filter(regexp_split_to_array(text, '{_SPACES}'), lambda w: w <> '') as ws from docs)),
win as (
  select * from (
    select id, i, w, lead(w) over o as w2, lead(w, 2) over o as w3 from word window o as (partition by id order by i))
  where w3 is not null),
again as (select id, i from (select id, i, count(*) over (partition by id, w, w2, w3) as c from win) where c > 1),
rep as (select id, count(distinct i + k) as n from again, (select unnest([0, 1, 2]) as k) group by id),
cnt as (select id, count(*) as n, sum(length(w)) as chars from word group by id),
line as (
  select id, count(*) as n, count(*) - count(distinct ln) as d
  from (select id, unnest(string_split(text, chr(10))) as ln from docs)
  where regexp_matches(ln, '[^\\x20\\x09-\\x0D]') group by id),
m as (
  select docs.id, docs.doc_id, docs.source, coalesce(cnt.n, 0)::bigint as n_words, coalesce(cnt.chars, 0)::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(line.n, 0)::bigint as n_lines,
         coalesce(line.d, 0)::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words
  from docs left join cnt using (id) left join line using (id) left join rep using (id)),
f as (
  select *, n_words < {Q.MIN_WORDS} as fail_short,
         100 * n_repeat_words > {Q.MAX_REPEAT_PERCENT} * n_words as fail_repeats,
         100 * n_symbols > {Q.MAX_SYMBOLS_PER_100_WORDS} * n_words as fail_symbols,
         100 * n_dup_lines > {Q.MAX_DUP_LINE_PERCENT} * n_lines as fail_dup_lines,
         word_chars < {Q.MEAN_WORD[0]} * n_words or word_chars > {Q.MEAN_WORD[1]} * n_words as fail_word_length
  from m),
h as (select source, count(*) as n, {', '.join(f'sum({r}::int)::double as {r}' for r in rules)} from f group by source),
p as (select {', '.join(f'sum({r}) / sum(n) as {r}_m, var_pop({r} / n) as {r}_v' for r in rules)} from h),
k as (select *, {', '.join(f'least(1e6, greatest(1, case when {r}_v > 0 then {r}_m * (1 - {r}_m) / {r}_v - 1 else 1e6 end)) as {r}_k' for r in rules)} from p),
q as (select *, {', '.join(rate(r) for r in rules)} from h, k),
v as (select source, source is not null and ({' or '.join(bad(r) for r in rules)}) as bad from q)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_short or fail_repeats as base_failed,
       not ({' or '.join(rules)} or bad) as kept
from f join v on f.source is not distinct from v.source"""


def _secret_scan() -> str:
    from velorank.llm.secret_scan import PATTERNS
    pats = [p.replace("'", "''") for p in PATTERNS]
    found = " union all ".join(f"""
  select r, {k} as k, unnest(m) as m, unnest(g[:len(m)]) as g, unnest(range(len(m))) as i
  from (select r, regexp_extract_all(t, '{p}') as m, regexp_split_to_array(t, '{p}') as g from docs)""" for k, p in enumerate(pats))
    return f"""
with recursive {crc32_mod4_sql()},
docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as t, coalesce(d.source, '') as repo, domain as owner
  from documents d join domains s on d.source is not distinct from s.source),
found as ({found}),
placed as (
  select r, k, m, case when k = 0 then regexp_extract(m, '{pats[0]}', 2) else m end as v,
         (sum(length(g) + length(m)) over (partition by r, k order by i))::bigint as z
  from found),
spans as (
  select r, k, v, z - length(m) as a, z from placed
  where case when k = 0 then length(v) >= 6 when k = 1 then length(v) >= 20
             when k = 3 then regexp_matches(v, '[A-Z]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[0-9]') else true end),
outside as (
  select * from spans s
  where k < 3 or not exists (select 1 from spans b where b.r = s.r and b.k < 3 and b.a < s.z and b.z > s.a)),
held as (select v, count(distinct repo) >= 3 and count(distinct owner) >= 2 as copied from outside join docs using (r) group by v),
told as (
  select *, ['assign', 'access', 'hex', 'owned'][k + 1] || ':' || a || ':' || z as s
  from outside join held using (v) where k < 3 or not copied),
by_doc as (
  select r, count(*) filter (k = 0) as n_assign, count(*) filter (k = 1) as n_access, count(*) filter (k = 2) as n_hex,
         count(*) filter (k = 3) as n_owned, count(*) filter (not copied) as n_live,
         string_agg(s, ',' order by a, k) as spans, string_agg(s, ',' order by a, k) filter (k < 3) as base
  from told group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(n_owned, 0) as n_owned, coalesce(n_live, 0) as n_live
from docs left join by_doc using (r)"""


def _importance() -> str:
    words = "list_filter(regexp_split_to_array({}, '[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]+'), lambda w: w <> '')"
    lowered = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "[c, 0, 0, 0, 0, 0, 0, 0, 0]"
    byte = "('0x' || substr(h, 2 * i - 1, 2))::bigint"
    return f"""
with docs as (select row_number() over () as r, doc_id, {words.format(lowered)} as ws from documents),
goal as (select {words.format(lowered)} as ws from benchmark),
table256 as (
  select list(list_reduce({bits}, lambda a, b: xor(a >> 1, case when a & 1 = 1 then 3988292384::bigint else 0 end)) order by c) as t
  from range(256) x(c)),
held as (
  select r, unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as f from docs),
wanted as (select unnest(list_concat(ws, list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]))) as f from goal),
names as (
  select f, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(h) // 2 + 1), lambda i: {byte})),
                            lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295::bigint) % 10000 as bucket
  from (select f, hex(f) as h from (select f from held union select f from wanted)), table256),
s as (select bucket, count(*) as n from held join names using (f) group by bucket),
t as (select bucket, count(*) as n from wanted join names using (f) group by bucket),
sums as (select coalesce((select sum(n) from s), 0)::double as s, coalesce((select sum(n) from t), 0)::double as t),
gain as (
  select s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::double * (sums.s + 10000) / ((s.n + 1)::double * (sums.t + 10000))))::bigint as g
  from s left join t using (bucket), sums),
total as (select r, sum(g) as g, count(*) as n from held join names using (f) join gain using (bucket) group by r),
scored as (
  select docs.r, doc_id, len(ws) as n_words, coalesce(n, 0)::bigint as n_features, coalesce(floor(g::double / n), 0)::bigint as weight,
         ('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint::double as h
  from docs left join total using (r)),
noisy as (select *, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296.0))))::bigint as score from scored),
placed as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls last, r) as place,
         (select 25 * count(*) // 100 from noisy where n_words >= 20) as k from noisy)
select doc_id, n_features, weight, score, (case when n_words >= 20 and place <= k then place end)::bigint as rank from placed"""


def _filter_audit() -> str:
    from itertools import permutations
    steps = ", ".join(f"('{''.join(o)}', {i + 1}, '{f}', {sum(2 ** 'ABCDE'.index(g) for g in o[:i])}, {2 ** 'ABCDE'.index(f)})"
                      for o in permutations("ABCDE") for i, f in enumerate(o))
    return f"""
with docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACES}'), lambda w: w <> '') as ws from documents),
fails as (
  select doc_id, part,
         (len(ws) < 100)::int + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::int
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::int
         + 8 * regexp_matches(t, '[#$%&*|]')::int
         + 16 * coalesce(doc_id > min(doc_id) over (partition by t), false)::int as mask
  from docs),
told as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as bad from labels group by doc_id),
cells as (
  select part, mask, count(*) as n, coalesce(sum(good), 0) as good, coalesce(sum(bad), 0) as bad
  from fails left join told using (doc_id) group by part, mask),
steps(filter_order, step, filter, before, bit) as (values {steps}),
counted as (
  select part, filter_order, step, filter,
         sum(case when mask & (before | bit) = 0 then n else 0 end) as kept,
         sum(case when mask & before = 0 and mask & bit <> 0 then n else 0 end) as removed,
         sum(case when mask & before <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
         sum(case when mask = bit then n else 0 end) as unique_fails,
         sum(case when mask & before = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
         sum(case when mask & before = 0 and mask & bit <> 0 then bad else 0 end) as toxic_lost
  from cells, steps group by part, filter_order, step, filter)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
       unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost,
       (sum(removed) over (partition by part, filter))::bigint as shapley
from counted"""


ORACLES = {
    "op11_secret_scan": _secret_scan(),
    "op12_importance_resampling": _importance(),
    "op13_filter_audit": _filter_audit(),
    "op3_url_filter": _url_filter(),
    "op5_source_mixing": _mixing(),
    "op8_host_quality": _host_quality(),
}
