"""SQL forms of the operator queries, for DuckDB, where SQL can express them."""

from __future__ import annotations

from strideframe.llm import decontamination, mixing, quality, url_filter

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


OP1 = f"""
with recursive w as (
  select doc_id, {_words(f"translate(text, '{_UPPER}', '{_LOWER}')")} as words from documents
), pieces as (
  select doc_id, unnest(case when len(words) >= 5 then list_transform(range(1, len(words) - 3), lambda i: words[i:i + 4])
                             when len(words) > 0 then [words] else [] end) as piece from w
), s as (select distinct doc_id, piece from pieces),
sizes as (select doc_id, count(*) as n from s group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as both_sets
  from s a join s b on a.piece = b.piece and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * both_sets >= 85 * (x.n + y.n - both_sets)
), edges as (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a)
select d.doc_id, coalesce(max(z.n), 0)::bigint as n_shingles,
  least(d.doc_id, coalesce(min(r.b), d.doc_id))::bigint as component_id,
  d.doc_id = least(d.doc_id, coalesce(min(r.b), d.doc_id)) as kept
from documents d left join sizes z using (doc_id) left join reach r on r.a = d.doc_id
group by d.doc_id
"""

_CHARS = "".join(
    f" || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(sha1(html), {5 * k + 1}, 5))::int >> {shift}) & 31) + 1, 1)"
    for k in range(8)
    for shift in (15, 10, 5, 0)
).removeprefix(" || ")

OP2 = f"""
with p as (select page_id, coalesce(html, '') as html from pages),
f as (select html, min(page_id) as first_id from p group by html)
select page_id, strlen(html)::bigint as payload_bytes, {_CHARS} as payload_digest,
  case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from p join f using (html)
"""

OP4 = f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents
), s as (
  select source, sum(size)::double as own, row_number() over (order by source nulls last) as turn from d group by source
), v as (
  select *, list_extract([{", ".join(f"{w}.0::double" for w in mixing.WEIGHTS)}], 1 + ((turn - 1) % {len(mixing.WEIGHTS)})) as weight from s
), o as (
  select *, coalesce(sum({mixing.MOST} * own) over w, 0) as capped, sum(weight) over () - coalesce(sum(weight) over w, 0) as rest,
    {mixing.SHARE} * sum(own) over () as total
  from v window w as (order by {mixing.MOST} * own / weight, source nulls last rows between unbounded preceding and 1 preceding)
), level as (
  select arg_min((total - capped) / rest, {mixing.MOST} * own / weight)
    filter (where {mixing.MOST} * own > weight * (total - capped) / rest) as l from o
), t as (
  select source, own::bigint as source_size, least({mixing.MOST}.0 * own, weight * coalesce(l, 1e300)) as target from v, level
), r as (
  select d.doc_id, d.size, t.source_size, t.target, case when source_size > 0 then target / source_size else 0 end as rate,
    ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint / 4294967296.0 as drawn
  from d join t on d.source is not distinct from t.source
)
select doc_id, size, source_size, target, (size * (floor(rate) + (drawn < rate - floor(rate))::int))::bigint as taken from r
"""

OP5 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as x from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.x, c.x)::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.x) = len(c.x) where q.vec_id % 20 = 0
), ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


def _term(term: str) -> str:
    return f"regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::int"


def _rules() -> tuple[str, str]:
    names, verdicts = [], []
    for verdict, host, path in sorted(url_filter.RULES, key=lambda r: (-len(r[1]) - len(r[2]), -len(r[1]), r)):
        fits = f"(host = '{host}' or ends_with(host, '.{host}')) and starts_with(path, '{path}')"
        names.append(f"when {fits} then '{host}{path}'")
        verdicts.append(f"when {fits} then '{verdict}'")
    return "case " + " ".join(names) + " end", "case " + " ".join(verdicts) + " end"


OP7 = f"""
with p as (
  select page_id, lower(coalesce(url, '')) as u, coalesce(substr(url, nullif(strpos(url, '://'), 0) + 3), '') as tail from pages
), h as (
  select page_id, u, translate(regexp_extract(tail, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') as host,
    regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) as path from p
), t as (
  select *, ({" + ".join(_term(x) for x in url_filter.STRICT)})::bigint as strict_hits,
    ({" + ".join(_term(x) for x in url_filter.SOFT)})::bigint as soft_hits,
    {" + ".join(f"{_term(x)} * {w}::double" for x, w in sorted(url_filter.SOFT.items()))} as soft_weight,
    {_rules()[0]} as rule, {_rules()[1]} as rule_verdict from h
)
select page_id, host, path, rule, strict_hits, soft_hits, soft_weight,
  coalesce(rule_verdict, case when strict_hits > 0 or (soft_hits >= {url_filter.LEAST_SOFT}
    and soft_weight >= {url_filter.LEAST_WEIGHT}) then 'block' else 'allow' end) as verdict
from t
"""

OP8 = f"""
with w as (select doc_id, {_words("text")} as words from documents),
win as (
  select doc_id, i, words[i:i + 19] as piece from (
    select doc_id, words, unnest(case when len(words) >= 20 then range(1, len(words) - 18) else [] end) as i from w)
), later as (
  select doc_id, i from (select doc_id, i, row_number() over (partition by piece order by doc_id, i) as turn from win) where turn > 1
), gone as (select distinct doc_id, unnest(range(i, i + 20)) as k from later),
parts as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as k from w),
left_over as (
  select p.doc_id, string_agg(word, ' ' order by p.k) filter (where g.k is null) as kept, count(g.k)::bigint as n_removed
  from parts p left join gone g on g.doc_id = p.doc_id and g.k = p.k group by p.doc_id
)
select w.doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join left_over l on l.doc_id = w.doc_id
"""


def _tests() -> str:
    rules = (" or ".join(f"{m} > {float(c)}::double" for m, c in rule.items()) for rule in quality.STEPS)
    return ", ".join(f"{{'step': {k}, 'hit': ({rule})::int}}" for k, rule in enumerate(rules))


def _limit(measure: str) -> str:
    values = ", ".join(f"{float(r[measure])}::double" if measure in r else "null" for r in quality.STEPS)
    return f"list_extract([{values}], accepted) as {measure}_cutoff"


OP9 = f"""
with w as (
  select doc_id, coalesce(lang, chr(1)) as lang, coalesce(text, '') as text, {_words("text")} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines from documents
), win as (
  select doc_id, i, words[i:i + 4] as piece from (
    select doc_id, words, unnest(case when len(words) >= 5 then range(1, len(words) - 3) else [] end) as i from w)
), twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, piece) as n from win) where n > 1),
repeated as (select doc_id, count(distinct k) as n from (select doc_id, unnest(range(i, i + 5)) as k from twice) group by doc_id),
m as (
  select w.doc_id, lang, w.text, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(r.n, 0)::bigint as n_repeat_words, len(lines) as n_lines
  from w left join repeated r on r.doc_id = w.doc_id
), q as (
  select *, n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words as base_failed,
    case when n_words > 0 then n_symbols / n_words else 0 end as symbol_ratio,
    case when n_lines > 0 then n_dup_lines / n_lines else 0 end as dup_line_ratio,
    case when n_words > 0 then n_repeat_words / n_words else 0 end as repeat_ratio,
    case when n_words > 0 then word_chars / n_words else 0 end as mean_word_chars
  from m
), good as (
  select distinct lang, text, {", ".join(quality.MEASURES)} from q join labels l using (doc_id) where l.quality = 1 and not base_failed
), tests as (
  select lang, t.step, count(*) as n, sum(t.hit) as x from (select lang, unnest([{_tests()}]) as t from good) group by all
), tested as (
  select *, x < n and list_sum(list_transform(range(0, x::bigint + 1), lambda k: exp(lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)
      + k * ln({quality.ALPHA}) + (n - k) * ln(1 - {quality.ALPHA}))))
    <= {quality.DELTA} / greatest(1, (select count(distinct lang) from q)) as ok from tests
), fixed as (
  select lang, coalesce(min(step) filter (where not ok), {len(quality.STEPS)})::int as accepted from tested group by lang
), limits as (select lang, {", ".join(_limit(m) for m in quality.MEASURES)} from fixed where accepted > 0)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not ({" or ".join(f"coalesce({m} > {m}_cutoff, false)" for m in quality.MEASURES)}) as kept
from q left join limits using (lang)
"""

def _item_words(text: str) -> str:
    pieces = f"string_split_regex(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{decontamination.BETWEEN}')"
    return f"list_filter({pieces}, lambda x: x <> '')"


_SIZE = decontamination.SIZE
OP12 = f"""
with b as (select item_id::varchar as item, {_item_words("text")} as words from benchmark),
bw as (
  select distinct item, least(len(words), {_SIZE}) as l, list_slice(words, i, i + least(len(words), {_SIZE}) - 1) as piece
  from (select item, words, unnest(range(1, len(words) - least(len(words), {_SIZE}) + 2)) as i from b where len(words) > 0)
), d as (select doc_id, {_item_words("text")} as words from documents),
dw as (
  select doc_id, i, l, list_slice(words, i, i + l - 1) as piece
  from (select doc_id, words, l, unnest(case when len(words) >= l then range(1, len(words) - l + 2) else [] end) as i
        from d cross join (select distinct l from bw))
), h as (select doc_id, i, l, piece from dw semi join (select distinct l, piece from bw) using (l, piece)),
hit as (select doc_id, count(distinct k)::bigint as n from (select doc_id, unnest(range(i, i + l)) as k from h) group by doc_id),
named as (
  select doc_id, count(distinct item)::bigint as n_items, string_agg(distinct item, ',' order by item) as items
  from (select distinct doc_id, piece from h) join bw using (piece) group by doc_id
)
select d.doc_id, len(words)::bigint as n_words, coalesce(n, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n, 0) > 0 as contaminated
from d left join hit on hit.doc_id = d.doc_id left join named on named.doc_id = d.doc_id
"""

ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": OP1,
    "op2_content_archive": OP2,
    "op4_source_mixing": OP4,
    "op5_exact_top_k": OP5,
    "op7_url_filter": OP7,
    "op8_substring_dedup": OP8,
    "op9_quality_rules": OP9,
    "op12_decontamination": OP12,
}
