"""DuckDB SQL for the rows of those queries that SQL can express."""

from __future__ import annotations

from firmroll.llm import language, quality, search, secrets, url_filter, vector_codes
from firmroll.llm.common import LOWER, UPPER

BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _matches(name: str, pattern: str, group: int) -> str:
    """Matches with their positions: the parts between them, and they, are measured in turn."""
    pattern = _quoted(pattern)
    return f"""
{name}_all as (select rid, regexp_extract_all(t, {pattern}) as found, regexp_extract_all(t, {pattern}, {group}) as vals,
  string_split_regex(t, {pattern}) as gaps from d),
{name}_rows as (select rid, unnest(range(1, len(found) + 1)) as i, unnest(found) as m, unnest(vals) as v,
  unnest(gaps[1:len(found)]) as g from {name}_all),
{name} as (select rid, i, m, v, sum(length(g) + length(m)) over (partition by rid order by i)::bigint as e from {name}_rows)"""


def op1_secret_scan() -> str:
    """Positions and all sums by window functions over exploded matches and characters."""
    parts, base = [], []
    for order, (kind, (pattern, group, least)) in enumerate(secrets.PATTERNS.items()):
        parts.append(_matches(kind, pattern, group))
        base.append(
            f"select rid, e - length(m) as s, e, {order} as o, '{kind}' as kind from {kind} where length(v) >= {least}"
        )
    parts.append(_matches("token_run", secrets.TOKEN, 0))
    abc = " ".join(f"when regexp_matches(v, '{e[1]}') then '{e[2]}'" for e in secrets.ENCODINGS)
    alone, pairs = secrets.written()
    symbols = "".join(secrets.SYMBOLS)
    kind = "case when {0} < 26 then 0 when {0} < 52 then 1 when {0} < 62 then 2 else 3 end"
    uniform = " ".join(f"when {len(e[2])} then {secrets.exponent(1 / len(e[2]))}" for e in secrets.ENCODINGS)

    def tail(z: str) -> str:
        return f"(1 / (1 + exp(least(1.5976 * ({z}) + 0.07056 * pow({z}, 3), 600))))"

    counts = ", ".join(f"count(*) filter (where kind = '{k}') as n_{k}" for k in secrets.KINDS)
    n_columns = ", ".join(f"coalesce(b.n_{k}, 0) as n_{k}" for k in secrets.KINDS)
    listed = "string_agg(kind || ':' || s || ':' || e, ',' order by s, o, e)"
    return f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents), {", ".join(parts)},
base as ({" union all ".join(base)}),
cand as (select row_number() over () as cid, * from (
  select rid, e - length(m) as s, e, rtrim(m, '=') as v from token_run) c
  where length(v) >= {secrets.MIN_LENGTH}
  and not exists (select 1 from base b where b.rid = c.rid and b.s < c.e and b.e > c.s)),
enc as (select *, length(v)::double as n, case {abc} end as abc from cand),
chars as (select cid, n, length(abc)::double as a, unnest(range(1, length(v) + 1)) as i, unnest(string_split(v, '')) as ch,
  abc from enc where abc is not null),
seen as (select cid, i, a, instr('{symbols}', ch) - 1 as k from chars),
kinds as (select *, {kind.format("k")} as kind, coalesce(lag({kind.format("k")}) over (partition by cid order by i), 3) as before
  from seen),
written as (select cid, sum({alone}[k + 1] + {pairs}[4 * before + kind + 1]) - any_value(case a::int {uniform} end) * count(*) as ex
  from kinds group by cid),
x as (select cid, i, n, a, ch, (instr(abc, ch) - 1)::double as x, avg((instr(abc, ch) - 1)::double) over (partition by cid) as mean
  from chars),
pairs as (select cid, sum(c * (c - 1) / 2.0) as u from (select cid, ch, count(*)::double as c from chars group by all) group by cid),
steps as (select *, lag(x) over (partition by cid order by i) as p from x),
sums as (select cid, any_value(n) as n, any_value(a) as a, (count(*) filter (where 2 * x >= a))::double as high,
  1 + (count(*) filter (where p is not null and (2 * p >= a) <> (2 * x >= a)))::double as runs,
  sum((x - mean) * (x - mean)) as spread, sum((p - mean) * (x - mean)) filter (where p is not null) as serial
  from steps group by cid),
z as (select cid, n, (a / n * (n + 2 * u) - n - (a - 1)) / sqrt(2 * (a - 1) * (n - 1) / n) as zu,
  case when high * (n - high) = 0 then 40 else abs(runs - 1 - 2 * high * (n - high) / n) / sqrt(greatest(2 * high * (n - high)
   * (2 * high * (n - high) - n) / (n * n * (n - 1)), 1e-9)) end as zr,
  case when spread = 0 then 40 else abs(serial / spread * sqrt(n)) end as zs
  from sums join pairs using (cid)),
f as (select cid, rid, s, e, v, z.n, -2 * (ln({tail("zu")}) + ln(least(1, 2 * {tail("zr")})) + ln(least(1, 2 * {tail("zs")}))) as fi,
  ex from z join enc using (cid) join written using (cid)),
judged as (select rid, s, e, v, floor(log2(n))::int as class, floor(least(ex, 300000) / 100.0)::int as tenth,
  exp(-fi / 2) * (1 + fi / 2 + fi * fi / 8) >= {secrets.LEAST_RANDOM} as random from f),
counted as (select class, tenth, count(distinct v) as n from judged group by all),
ranked as (select class, tenth, sum(n) over (partition by class) as total,
  sum(n) over (partition by class order by tenth desc) as upto from counted),
limits as (select class, min(tenth) as least from ranked
  where pow(10.0, -tenth / 10.0) <= upto / total * {secrets.FALSE_DISCOVERIES} group by class),
spans as (select rid, s, e, o, kind from base union all
  select rid, s, e, {len(secrets.KINDS)}, '{secrets.RANDOM}' from judged join limits using (class) where random and tenth >= least),
b as (select rid, {counts}, {listed} as spans from base group by rid),
every as (select rid, {listed} as spans from spans group by rid)
select doc_id, {n_columns}, sha256(coalesce(b.spans, '')) as base_sha256, coalesce(every.spans, '') as spans
from d left join b using (rid) left join every using (rid)"""


def op5_exact_dedup() -> str:
    return rf"""
with n as (select doc_id, length(coalesce(text,'')) as chars, row_number() over () as rid,
  regexp_replace(coalesce(text,''), '{BLANK}', '', 'g') as normal from documents),
r as (select *, row_number() over same as place, first(doc_id) over same as keep_id,
  count(*) over (partition by normal) as group_size
 from n window same as (partition by normal order by chars desc, doc_id nulls last, rid))
select doc_id, keep_id, group_size, place = 1 as kept, sha256(normal) as text_sha256 from r"""


def op8_warc() -> str:
    return """
with p as (select page_id, row_number() over () as rid, coalesce(html,'') as html, strlen(coalesce(html,'')) as size
 from pages),
r as (select *, row_number() over same as place, first(page_id) over same as keep, size >= 1000 as long from p
 window same as (partition by html order by page_id desc nulls last, rid))
select page_id, size as payload_bytes, sha1(html) as payload_digest,
 case when long and place > 1 then 'revisit' else 'response' end as record_type,
 case when long and place > 1 then keep end as refers_to
from r"""


def op9_url_filter() -> str:
    """Rules by length in a CASE, terms by bounded patterns."""
    settings = url_filter.UrlFilter()
    fits = []
    for host, path, verdict in sorted(settings.rules, key=lambda r: -len(r[0] + r[1])):
        on_host = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
        fits.append((on_host, host + path, verdict))

    def hits(weights: dict[str, int]) -> str:
        return " + ".join(
            f"{n} * cast(regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') as bigint)" for t, n in weights.items()
        )

    soft = settings.soft_weights()
    heavy = f"(n_soft >= {settings.soft_distinct} and soft_weight >= {settings.soft_needed})"

    rule = " ".join(f"when {c} then '{r}'" for c, r, _ in fits)
    verdict = " ".join(f"when {c} then '{v}'" for c, _, v in fits)
    return f"""
with parts as (
 select page_id,
  translate(regexp_extract(coalesce(url,''), '://([^/?#]*)', 1), '{url_filter.UPPER}', '{url_filter.LOWER}') as host,
  regexp_extract(coalesce(url,''), '://[^/?#]*([^?#]*)', 1) as path,
  translate(coalesce(url,''), '{url_filter.UPPER}', '{url_filter.LOWER}') as low
 from pages),
hits as (select *, {hits(dict.fromkeys(settings.strict, 1))} as n_strict,
 {hits(dict.fromkeys(soft, 1))} as n_soft, {hits(soft)} as soft_weight from parts)
select page_id, host, path, case {rule} end as rule,
 case {verdict} when n_strict > 0 or {heavy} then 'block' else 'allow' end as verdict,
 n_strict, n_soft, soft_weight
from hits"""


def op10_quality_rules() -> str:
    """Counts by list functions, sketches by integer arithmetic, fences by window functions."""
    w = quality.WINDOW
    low = " ".join(f"when '{k}' then {v[0]}" for k, v in quality.FENCES.items() if v[0] is not None)
    high = " ".join(f"when '{k}' then {v[1]}" for k, v in quality.FENCES.items() if v[1] is not None)

    def fences(name: str, by: str) -> str:
        keys = f"{by}, " if by else ""
        return f"""
{name}_q as (select {keys}ratio, bin, sum(n) over (partition by {keys}ratio order by bin) as upto,
  sum(n) over (partition by {keys}ratio) as total
 from (select {keys}ratio, bin, sum(n) as n from sketch group by {keys}ratio, bin)),
{name}_s as (select {keys}ratio, max(total) as docs, min(bin) filter (where upto * 4 >= total) as q1,
  min(bin) filter (where upto * 4 >= total * 3) as q3 from {name}_q group by {keys}ratio),
{name} as (select {keys}ratio, docs, q1 - greatest({quality.SPREADS} * (q3 - q1), case ratio {low} end) as low,
  q3 + greatest({quality.SPREADS} * (q3 - q1), case ratio {high} end) as high from {name}_s)"""

    def chosen(side: str) -> str:
        return (
            f"case when o.docs >= {quality.MIN_GROUP} then o.{side} "
            f"when l.docs >= {quality.MIN_GROUP} then l.{side} else a.{side} end as {side}"
        )

    beyond = " or ".join(
        [f"(ratio = '{k}' and v > high)" for k, f in quality.FENCES.items() if f[1] is not None]
        + [f"(ratio = '{k}' and v < low)" for k, f in quality.FENCES.items() if f[0] is not None]
    )
    symbols = "".join("\\" + c for c in quality.SYMBOLS)
    return rf"""
with d as (select row_number() over () as rid, doc_id, coalesce(lang,'') as lang, coalesce(source,'') as source,
  coalesce(text,'') as text from documents),
w as (select rid, regexp_extract_all(text, '{NOT_BLANK}+') as words,
  [x for x in string_split(text, chr(10)) if regexp_matches(x, '{NOT_BLANK}')] as lines from d),
grams as (select rid, i, list_slice(words, i, i + {w - 1}) as gram
 from (select rid, words, unnest(range(1, len(words) - {w - 2})) as i from w)),
twice as (select rid, i from (select rid, i, count(*) over (partition by rid, gram) as n from grams) where n > 1),
covered as (select rid, count(distinct p) as n from (select rid, unnest(range(i, i + {w})) as p from twice) group by rid),
m as (select d.rid, doc_id, lang, source, len(words)::bigint as n_words,
  length(regexp_replace(text, '{BLANK}', '', 'g')) as word_chars,
  length(regexp_replace(text, '[^{symbols}]', '', 'g')) as n_symbols,
  len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
  len(lines) as n_lines, length(regexp_replace(text, '[^A-Z]', '', 'g')) as n_capitals
 from d join w using (rid) left join covered using (rid)),
r as (select rid, lang, source, 'word_length' as ratio, case when n_words = 0 then 0 else 100 * word_chars // n_words end as v from m
 union all select rid, lang, source, 'symbols', case when n_words = 0 then 0 else 1000 * n_symbols // n_words end from m
 union all select rid, lang, source, 'dup_lines', case when n_lines = 0 then 0 else 1000 * n_dup_lines // n_lines end from m
 union all select rid, lang, source, 'capitals', case when word_chars = 0 then 0 else 1000 * n_capitals // word_chars end from m),
sketch as (select lang, source, ratio, v - v % (1::bigint << greatest(length(bin(v)) - 5, 0)::int) as bin, count(*) as n
 from r group by all),
{fences("o", "lang, source")}, {fences("l", "lang")}, {fences("a", "")},
limits as (select o.lang, o.source, ratio, {chosen("low")}, {chosen("high")}
 from o join l using (lang, ratio) join a using (ratio)),
bad as (select distinct rid from r join limits using (lang, source, ratio) where {beyond})
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words as base_failed,
 not (n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words)
  and rid not in (select rid from bad) as kept
from m"""


def op11_language_id() -> str:
    """All labelled rows teach, as they do while no label has more rows than its part of the sample."""
    sizes = ", ".join(map(str, range(1, language.LONGEST + 1)))
    polynomial = 0xEDB88320
    step = f"case when c % 2 = 1 then xor(c // 2, {polynomial}) else c // 2 end"
    return f"""
with recursive bits as (select b::bigint as b, b::bigint as c, 0 as i from range(256) t(b)
 union all select b, {step}, i + 1 from bits where i < 8),
crc as (select list(c order by b) as codes from bits where i = 8),
d as (select row_number() over () as rid, doc_id, lang, text, case when doc_id is not null then xor(list_reduce(
  list_transform(string_split(doc_id::varchar, ''), lambda s: ord(s)::bigint),
  lambda c, s: xor(c // 256, codes[xor(c % 256, s) + 1]), 4294967295::bigint), 4294967295::bigint) % 4 end as part
 from documents, crc),
words as (select rid, w, count(*)::bigint as n
 from (select rid, unnest(regexp_extract_all(lower(text), '{language.WORD}')) as w from d) group by all),
taught as (select lang, w, sum(n)::bigint as n from words join d using (rid) where lang is not null and part <> 2 group by all),
grams as (select * from (select w, size, unnest(list_transform(range(1, length(w) + 4 - size), lambda i: substr(' ' || w || ' ', i, size))) as g
 from (select distinct w from words), (select unnest([{sizes}]) as size) where size <= length(w) + 2) where g <> ' '),
counts as (select lang, 0 as size, w as g, n from taught
 union all select lang, size, g, sum(n)::bigint from taught join grams using (w) group by all),
langs as (select lang, (select {language.MODEL_ENTRIES} // (count(distinct lang) * {language.LONGEST + 1})
  from d where lang is not null and text is not null and part <> 2)::bigint as most
 from d where lang is not null and text is not null and part <> 2 group by lang),
totals as (select lang, size, sum(n)::bigint as total from counts group by all),
model as (select lang, size, g, round(-{language.UNIT} * ln(n::double / total))::bigint as cost
 from counts join totals using (lang, size) join langs using (lang) where n * most >= total),
known as (select distinct size, g from model),
best as (select w, size, g from grams join known using (size, g)
 qualify size = max(size) over (partition by w) and not exists (select 1 from known k where k.size = 0 and k.g = w)),
pieces as (select w, 0 as size, w as g from (select distinct w from words) join known k on k.size = 0 and k.g = w
 union all select w, size, g from best),
costs as (select w, l.lang, sum(coalesce(m.cost, round({language.UNIT} * ln(most))::bigint + {language.UNKNOWN}))::bigint // count(*) as cost
 from pieces p cross join langs l left join model m on m.size = p.size and m.g = p.g and m.lang = l.lang group by all),
scored as (select rid, l.lang, coalesce(sum(n * cost), 0)::bigint as total
 from (select distinct rid from words) cross join langs l left join (select rid, n, costs.* from words join costs using (w)) c
  using (rid, lang) group by all),
chosen as (select rid, min((total, lang)) as best, list(total) as totals from scored group by rid)
select doc_id, coalesce(part = 2, false) as held_out, coalesce(best[2], '{language.UNDETERMINED}') as lang_pred,
 coalesce(round(1 / list_sum(list_transform(totals, lambda t: exp((best[1] - t)::double / {language.UNIT}))), 6), 0) as score
from d left join chosen using (rid)"""


def op12_ranked_search() -> str:
    """Every document of every term, without an index."""
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def terms(table: str, key: str) -> str:
        lower = f"translate(text, '{UPPER}', '{LOWER}')"
        return f"""(select rid, {key}, unnest(regexp_extract_all({lower}, '{term}')) as term
 from (select row_number() over () as rid, {key}, text from {table}))"""

    return f"""
with tf as (select rid, doc_id, term, count(*)::bigint as tf from {terms("documents", "doc_id")} group by all),
lengths as (select rid, sum(tf)::bigint as n from tf group by rid),
size as (select count(*)::bigint as docs, sum(n)::bigint as total from lengths),
weights as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
 from tf, size group by term, docs),
asked as (select distinct rid as iid, item_id, term from {terms("benchmark", "item_id")}),
scored as (select iid, item_id, tf.rid, doc_id,
  sum(w * (({search.SCALE} * tf) // ({search.TF_STEP} * tf + {search.LENGTH_STEP}
   * (100 - {search.LENGTH_SHARE} + ({search.LENGTH_SHARE} * n * docs) // total))))::bigint as score
 from asked join weights using (term) join tf using (term) join lengths on lengths.rid = tf.rid, size
 group by iid, item_id, tf.rid, doc_id),
placed as (select *, row_number() over (partition by iid order by score desc, doc_id nulls last) as rank
 from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from placed where rank <= {search.PLACES}"""


def op13_vector_codes() -> str:
    """All distances of all parts to all entries, round by round."""
    parts, entries = vector_codes.PARTS, vector_codes.ENTRIES

    def assigned(n: int) -> str:
        return f"""near{n} as (select rid, part, min((d, entry)) as best from (
  select rid, p.part, entry, sum((p.x - b.x) * (p.x - b.x))::bigint as d
  from pieces p join books{n} b on b.part = p.part and b.pos = p.pos group by rid, p.part, entry) group by rid, part)"""

    rounds = "".join(
        f""", {assigned(n)},
books{n + 1} as (select b.part, b.entry, b.pos, coalesce(m.x, b.x) as x from books{n} b left join (
  select p.part, best[2] as entry, p.pos, floor(sum(p.x)::double / count(*))::bigint as x
  from pieces p join near{n} using (rid, part) group by all) m using (part, entry, pos))"""
        for n in range(vector_codes.ROUNDS)
    )
    last = vector_codes.ROUNDS
    return f"""
with kept as (select row_number() over (order by vec_id, embedding) as rid, vec_id, label, embedding, len(embedding) // {parts} as width
 from embeddings where embedding is not null
 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pieces as (select rid, (i - 1) // width as part, (i - 1) % width as pos, floor({vector_codes.SCALE} * x::double)::bigint as x
 from (select rid, width, unnest(embedding) as x, unnest(range(1, len(embedding) + 1)) as i from kept)),
books0 as (select part, (rid - 1)::bigint as entry, pos, x from pieces where rid <= {entries}){rounds}, {assigned(last)},
digest as (select sha256(string_agg(x::varchar, ',' order by part, entry, pos)) as codebooks_sha256 from books{last}),
coded as (select vec_id, label, string_agg(printf('%02x', best[2]), '' order by part) as code, sum(best[1])::bigint as error
 from near{last} join kept using (rid) group by rid, vec_id, label)
select vec_id, code, error, sum(error) over (partition by label)::bigint as label_error, codebooks_sha256 from coded, digest"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_secret_scan": op1_secret_scan(),
        "op5_exact_dedup": op5_exact_dedup(),
        "op8_warc": op8_warc(),
        "op9_url_filter": op9_url_filter(),
        "op10_quality_rules": op10_quality_rules(),
        "op11_language_id": op11_language_id(),
        "op12_ranked_search": op12_ranked_search(),
        "op13_vector_codes": op13_vector_codes(),
    }
