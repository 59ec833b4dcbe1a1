"""DuckDB SQL for the registered queries that SQL can express (written from the contracts, without the operators' code)."""

from __future__ import annotations

from .op2_pii import CONTEXT, KINDS, NEEDS_CONTEXT, SCORES, WINDOW
from .op10_mix import BLOCK

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# --- fixed values: the contract's patterns
_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?)",
    "ssn": r"[0-9]+(?:-[0-9]+)*",
}
_OK = {
    "email": "true",
    "ip": "len(list_filter(string_split(m, '.'), lambda x: len(ltrim(x, '0')) > 3 or "
          "cast('0' || right(ltrim(x, '0'), 3) as int) > 255)) = 0",
    "card": "len(d) between 13 and 19 and list_sum(list_transform(range(1, len(d) + 1), lambda i: "
            "case when i % 2 = 1 then cast(reverse(d)[i] as int) "
            "when cast(reverse(d)[i] as int) > 4 then cast(reverse(d)[i] as int) * 2 - 9 "
            "else cast(reverse(d)[i] as int) * 2 end)) % 10 = 0",
    "phone": "len(d) between 9 and 15",
    "iban": "len(c) between 15 and 34 and list_reduce(list_prepend(0, list_transform(string_split(c[5:] || c[1:4], ''), "
            "lambda x: case when x between '0' and '9' then ascii(x) - 48 else ascii(x) - 55 end)), "
            "lambda a, x: case when x > 9 then (a * 100 + x) % 97 else (a * 10 + x) % 97 end) = 1",
    "ssn": r"regexp_full_match(m, '[0-9]{3}-[0-9]{2}-[0-9]{4}')",
}


def _pii() -> str:
    parts = []
    for n, k in enumerate(KINDS):
        least, rise = SCORES[k]
        ok = _OK[k] + (" and near" if k in NEEDS_CONTEXT else "")
        parts.append(f"""
 select r, {n} kn, '{k}' kind, s, e, {least} + case when near then {rise} else 0 end score from (
  select *, regexp_replace(m, '[^0-9]', '', 'g') d, replace(m, ' ', '') c,
   regexp_matches({_LOW.format(f"substring(text, greatest(s - {WINDOW}, 0) + 1, least(s, {WINDOW})) || chr(10) || substring(text, e + 1, {WINDOW})")},
    '{"|".join(CONTEXT[k])}') near from (
   select *, s + length(m) e from ( select r, text, m, s::bigint s from (
    select r, text, ms[i] m, coalesce(list_sum(list_transform(bs[1:i], lambda x: length(x))), 0)
     + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) s from (
     select r, text, ms, bs, unnest(range(1, len(ms) + 1)) i from (
      select r, text, regexp_extract_all(text, '{_PATTERNS[k]}') ms, string_split_regex(text, '{_PATTERNS[k]}') bs from t))))))
 where {ok}""")
    counts = ", ".join(f"count(*) filter (kind = '{k}') n_{k}" for k in KINDS)
    span = "kind || ':' || cast(s as varchar) || ':' || cast(e as varchar)"
    return f"""
with t as (select row_number() over () r, doc_id, coalesce(text, '') as text from documents),
spans as ({' union all '.join(parts)})
select doc_id, {counts},
 sha256(coalesce(string_agg({span}, ',' order by kn, s) filter (kn < 4), '')) base_sha256,
 coalesce(string_agg({span}, ',' order by kn, s) filter (kind is not null), '') spans,
 coalesce(string_agg({span} || ':' || cast(score as varchar), ',' order by kn, s) filter (kind is not null), '') scored
from t left join spans using (r) group by r, doc_id"""


_EXACT = f"""
with t as (select doc_id, {_LOW.format("coalesce(text, '')")} x from documents),
g as (select x, max(doc_id) keep_id, count(*) group_size from t group by x)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id kept, sha256(x) text_sha256
from t join g using (x)"""

_REST = "coalesce(case when contains({0}, '://') then substring({0}, strpos({0}, '://') + 3) end, '')"

_URLS = rf"""
with recursive u as (
 select page_id, url, coalesce(html, '') html, {_REST.format("url")} rest from pages),
links as (select url, {_LOW.format("regexp_extract(rest, '^[^/?#]*')")} host,
 case when regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) like '%/%'
  then regexp_replace(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '[^/]*$', '') else '/' end folder, unnest([
  regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
  regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) link from u),
targets as (select url, case when contains(link, '://') then link when link like '//%' then 'http:' || link
 when link like '/%' then 'http://' || host || link else 'http://' || host || folder || link end target from links where link <> ''),
every as (select distinct url, {_REST.format("url")} rest from (select url from pages union all select target from targets)),
h as (select *, {_LOW.format("regexp_extract(rest, '^[^/?#]*')")} host,
 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path, regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1) q from every),
k as (select *, case when host <> '' then
  regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '([.]html|/)$', '') ||
  case when q2 <> '' then '?' || q2 else '' end end as key
 from (select *, regexp_replace(regexp_replace(q, '(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*', '', 'g'), '^&', '') q2 from h)),
rules(verdict, rule, rh, rp) as (values ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
 ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'), ('block', 'net/fr/', 'net', '/fr/')),
own as (select url, arg_max(rule, len(rule)) rule, arg_max(verdict, len(rule)) verdict from k join rules
 on (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp) group by url),
one as (select page_id, k.host, k.path, k.key, own.rule, own.verdict
 from pages left join k on pages.url is not distinct from k.url left join own on pages.url = own.url),
tied as (select distinct a.key x, b.key y from targets join k a on targets.url = a.url join k b on targets.target = b.url
 where a.key is not null and b.key is not null),
both_ways as (select x, y from tied union select y, x from tied),
reach(key, verdict) as (select k.key, own.verdict from k join own using (url) where k.key is not null
 union select y, verdict from reach join both_ways on reach.key = x),
decided as (select key, min(verdict) verdict from reach group by key)
select page_id, coalesce(host, '') host, coalesce(path, '') path, rule, coalesce(one.verdict, d.verdict, 'allow') verdict
from one left join decided d using (key)"""

_MIX = f"""
with sizes as (select row_number() over () r, doc_id, source,
  coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) size,
  md5('42|' || coalesce(cast(doc_id as varchar), 'null')) mix from documents),
per as (select source, sum(size)::bigint source_size from sizes group by source),
w as (select *, [5, 2, 1][1 + (s - 1) % 3]::bigint weight from (
  select *, row_number() over (order by source nulls last) s from per)),
f as (select *, 1.5::double * sum(source_size) over () - 2.0::double * coalesce(sum(source_size) over (
   order by source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0) rest,
  sum(weight) over (order by source_size / weight, source nulls last rows between current row and unbounded following) lft from w),
c as (select *, rest * weight > source_size * 2.0::double * lft capped from f),
lvl as (select arg_max(rest, lft) rest, max(lft) lft from c where not capped),
targets as (select s, source, source_size, (case when capped then source_size * 2.0::double
  else lvl.rest * weight / lvl.lft end)::double target from c, lvl),
cum as (select *, case when sum(target) over () > 0 then floor(sum(target) over (order by s) / sum(target) over () * 4294967296.0::double)
  else 0 end::bigint hi, sum(target) over () total from targets),
cell as (select *, coalesce(lag(hi) over (order by s), 0) lo from cum),
slots as (select unnest(range(0, cast(ceil(max(total) / {BLOCK}) as bigint))) slot from cum),
ranked as (select s, source_size, row_number() over (partition by s order by slot) - 1 as rank from slots join cell
  on (slot % 2147483648) * 2654435769 % 4294967296 >= lo and (slot % 2147483648) * 2654435769 % 4294967296 < hi),
used as (select s, rank % cast(ceil(source_size / {BLOCK}) as bigint) as block, count(*) times from ranked
  where rank < 2 * cast(ceil(source_size / {BLOCK}) as bigint) group by all),
line as (select r, doc_id, sizes.size, t.s, t.source_size, t.target,
  sum(sizes.size) over (partition by t.s order by mix, doc_id, sizes.size, r) upto
  from sizes join targets t on sizes.source is not distinct from t.source),
pieces as (select r, s, unnest(range((upto - size)::bigint // {BLOCK}, (upto - 1)::bigint // {BLOCK} + 1)) as block,
  upto - size as lo, upto as hi from line where size > 0),
taken as (select r, sum((least(hi, (p.block + 1) * {BLOCK}) - greatest(lo, p.block * {BLOCK})) * times) taken
  from pieces p join used using (s, block) group by r)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint taken from line left join taken using (r)"""

_JACCARD = f"""
with recursive w as (select row_number() over () r, doc_id, regexp_extract_all(
  {_LOW.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') w from documents),
own as (select r, doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
  when len(w) > 0 then [array_to_string(w, ' ')] else [] end s from w),
cls as (select s, min(doc_id) id from (select list_sort(s) s, doc_id from own) where len(s) > 0 group by s),
el as (select id, len(s) n, unnest(s) e from cls),
pairs as (select a.id a, b.id b from el a join el b on a.e = b.e and a.id < b.id
  group by a.id, b.id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
edges as (select a, b from pairs union all select b, a from pairs),
reach(id, low) as (select id, id from cls union select edges.b, reach.low from reach join edges on edges.a = reach.id where reach.low < edges.b),
low as (select id, min(low) low from reach group by id)
select doc_id, len(own.s)::bigint n_shingles, coalesce(low.low, doc_id) component_id
from own left join cls on list_sort(own.s) = cls.s left join low on cls.id = low.id"""

_VECTORS = """
with recursive v as (select row_number() over () r, vec_id, label, cast(embedding as double[]) e from embeddings),
ok as (select * from v where label is not null and vec_id is not null and len(e) > 0
  and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
pairs as (select a.r a, b.r b, a.vec_id ia, b.vec_id ib from ok a join ok b on a.label = b.label and len(a.e) = len(b.e) and a.r <> b.r
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(id, low) as (select vec_id, vec_id from ok union
  select pairs.ib, reach.low from reach join pairs on pairs.ia = reach.id where reach.low < pairs.ib),
low as (select id, min(low) low from reach group by id),
deg as (select a r, count(*) n from pairs group by a)
select vec_id, coalesce(deg.n, 0)::bigint n_links, coalesce(low.low, vec_id) component_id,
 vec_id is not distinct from coalesce(low.low, vec_id) kept
from v left join deg using (r) left join low on v.vec_id = low.id"""

_TOPK = """
with v as (select distinct vec_id, list_transform(cast(embedding as double[]), lambda e: cast(floor(256 * e) as bigint)) x from embeddings
 where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0),
pairs as (select q.vec_id query_id, c.vec_id, max(list_sum(list_transform(list_zip(q.x, c.x),
  lambda z: coalesce(z[1], 0) * coalesce(z[2], 0)))) score
 from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id group by q.vec_id, c.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, cast(rank as int) as rank, vec_id, cast(coalesce(score, 0) as bigint) score from ranked where rank <= 5"""

_MIDDLE = """
with t as (select doc_id, coalesce(text, '') t, length(coalesce(text, '')) n,
  sha256('1:' || coalesce(cast(doc_id as varchar), 'null')) h from documents),
d as (select *, cast('0x' || h[1:8] as bigint) % (n + 1) a, cast('0x' || h[9:16] as bigint) % (n + 1) b,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or cast('0x' || h[17:24] as bigint) % 100 >= 90
    then 'plain' when cast('0x' || h[25:32] as bigint) % 100 < 20 then 'spm' else 'psm' end form from t),
c as (select *, substring(t, 1, least(a, b)) p, substring(t, least(a, b) + 1, greatest(a, b) - least(a, b)) m,
  substring(t, greatest(a, b) + 1) s from d)
select doc_id, n::bigint n, form, case when form <> 'plain' then least(a, b) end::bigint prefix_chars,
 case when form <> 'plain' then greatest(a, b) - least(a, b) end::bigint middle_chars,
 sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
  else '<S>' || s || '<P>' || p || '<M>' || m end) output_sha256, sha256(t) restored_sha256
from c"""

_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = f"""
with d as (select row_number() over () r, doc_id, {_TERMS} w from documents),
stat as (select count(*)::bigint big_n, sum(len(w))::bigint l from d where len(w) > 0),
q as (select item_id, term, count(*) times from (select item_id, unnest({_TERMS}) term from (
  select distinct item_id, text from benchmark where item_id is not null)) group by all),
post as (select r, doc_id, len(w)::bigint n, term, count(*)::bigint tf from (select r, doc_id, w, unnest(w) term from d)
  where term in (select term from q) group by all),
df as (select term, count(*)::bigint df from post group by term),
score as (select item_id, r, doc_id, sum(times * floor(1000 * ln((2 * big_n + 2)::double / (2 * df + 1)::double))::bigint
  * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // l))))::bigint score
  from q join post using (term) join df using (term), stat where doc_id is not null group by item_id, r, doc_id),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from score where score > 0)
select item_id, cast(rank as int) as rank, doc_id, score from ranked where rank <= 10"""

ORACLE = {"op11_exact_topk": _TOPK, "op12_fill_in_middle": _MIDDLE, "op13_ranked_search": _SEARCH, "op5_embedding_dedup": _VECTORS, "op8_jaccard_join": _JACCARD, "op2_pii": _pii(), "op6_exact_dedup": _EXACT, "op9_url_filter": _URLS, "op10_mix": _MIX}
