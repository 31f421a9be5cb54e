"""DuckDB SQL for the queries that SQL can express."""

from scholaris.llm import licenses, urlfilter
from scholaris.llm.licensedigests import DIGESTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _windows(n: int) -> str:
    return f"""
with words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
numbered as (select row_number() over () as row, doc_id, w from words),
starts as (select row, unnest(range(1, greatest(len(w) - {n - 1}, 0) + 1)) as i from numbered),
windows as (select s.row, s.i, sha256(array_to_string(list_slice(w, i, i + {n - 1}), ' ')) as h from starts s join numbered using (row)),
repeated as (select row, i from (select row, i, count(*) over (partition by h) as n from windows) where n > 1),
gone as (select distinct row, unnest(range(i, i + {n})) as i from repeated),
lost as (select row, list(i) as gone from gone group by row),
left_over as (
  select doc_id, len(w) as n_words, coalesce(len(gone), 0) as n_removed,
         list_filter(w, lambda x, i: gone is null or not list_contains(gone, i)) as kept
  from numbered left join lost using (row))
select doc_id, cast(n_words as bigint) as n_words, cast(n_removed as bigint) as n_removed,
       sha256(array_to_string(kept, ' ')) as kept_sha256
from left_over
"""


def _urls() -> str:
    rules = ", ".join(f"({_text(r.verdict)}, {_text(r.host)}, {_text(r.path)})" for r in urlfilter.RULES)

    def rest(url: str) -> str:
        return f"case when contains({url}, '://') then substr({url}, strpos({url}, '://') + 3) end"

    def host(url: str) -> str:
        return f"coalesce(translate(regexp_extract({rest(url)}, '^[^/?#]*'), '{_UPPER}', '{_LOWER}'), '')"

    def path(url: str) -> str:
        return f"coalesce(regexp_extract({rest(url)}, '^[^/?#]*([^?#]*)', 1), '')"

    def node(url: str) -> str:
        plain = f"regexp_extract({url}, '^[^#]*')"
        front = f"regexp_extract({plain}, '^[^:/?#]+://[^/?#]*')"
        return f"translate({front}, '{_UPPER}', '{_LOWER}') || substr({plain}, length({front}) + 1)"

    def value(tag: str, name: str) -> str:
        start = f"(?is)[\\s\"''/]{name}\\s*=\\s*"
        forms = ('"([^"]*)"', "''([^'']*)''", "([^\\s>\"'']+)")
        return "(" + " || ".join(f"regexp_extract({tag}, '{start}{form}', 1)" for form in forms) + ")"

    return f"""
with recursive rules(verdict, host, path) as (values {rules}),
named as (
  select distinct url, replace(unnest(
    list_transform(list_filter(regexp_extract_all(html, '(?is)<link\\b[^>]*>'), lambda t: regexp_matches({value("t", "rel")}, '(?i)(^|\\s)canonical(\\s|$)')),
                   lambda t: trim({value("t", "href")}))
    || list_transform(list_filter(regexp_extract_all(html, '(?is)<meta\\b[^>]*>'), lambda t: regexp_matches({value("t", "http-equiv")}, '(?i)^\\s*refresh\\s*$')),
                      lambda t: regexp_extract({value("t", "content")}, '(?is)^[^;,]*[;,]\\s*url\\s*=\\s*["'']?\\s*([^"''>\\s]+)', 1))), '&amp;', '&') as name
  from pages where contains(url, '://')),
joined as (
  select url, case when regexp_matches(name, '^[A-Za-z][A-Za-z0-9+.-]*://') then name
                   when starts_with(name, '//') then regexp_extract(url, '^[^:/?#]+:') || name
                   when starts_with(name, '/') then regexp_extract(url, '^[^:/?#]+://[^/?#]*') || name
                   when starts_with(name, '?') then regexp_extract(url, '^[^?#]*') || name
                   when regexp_matches(url, '^[^:/?#]+://[^/?#]*/') then regexp_extract(url, '^[^:/?#]+://[^/?#]*/(?:[^?#]*/)?') || name
                   else regexp_extract(url, '^[^:/?#]+://[^/?#]*') || '/' || name end as target
  from named where name <> '' and not starts_with(name, '#')),
cut as (
  select url, target, regexp_extract(target, '^[^:/?#]+://[^/?#]*') as front, regexp_extract(target, '^[^:/?#]+://[^/?#]*(/[^?#]*)', 1) as path from joined),
whole as (
  select url, case when not regexp_matches(path, '/\\.\\.?(/|$)') or len(string_split(path, '/')) - 1 > {urlfilter.MOST_PARTS} then target
    else front || list_reduce(list_prepend('', string_split(substr(path, 2), '/')), lambda w, p:
           case p when '..' then regexp_replace(w, '/[^/]*$', '') when '.' then w else w || '/' || p end)
         || case when string_split(path, '/')[-1] in ('.', '..') then '/' else '' end || substr(target, length(front) + length(path) + 1) end as target
  from cut),
links as (select {node("url")} as a, {node("target")} as b from whole),
both_ways as (select a, b from links union select b, a from links union select a, a from links union select b, b from links),
reached(a, b) as (select a, b from both_ways union select r.a, l.b from reached r join both_ways l on r.b = l.a),
places as (select url as place from pages union select a from reached),
fits as (
  select p.place, r.verdict, r.host || r.path as rule,
         row_number() over (partition by p.place order by length(r.host || r.path) desc, length(r.host) desc, r.verdict) as nth
  from (select place, {host("place")} as host, {path("place")} as path from places) p
  join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)),
ruled as (select place, verdict, rule from fits where nth = 1),
aliases as (
  select a as node, case when bool_or(verdict = 'allow') then 'allow' when bool_or(verdict = 'block') then 'block' end as alias
  from reached left join ruled on place = b group by a)
select page_id, {host("url")} as host, {path("url")} as path, rule, coalesce(verdict, alias, 'allow') as verdict
from pages left join ruled on place = url left join aliases on node = {node("url")}
"""


TOP_K = """
with whole as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and coalesce(list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false))), true)),
scores as (
  select q.row, q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))) as score
  from whole q join whole c on q.vec_id % 20 = 0 and q.row <> c.row)
select query_id, cast(rank as int) as rank, vec_id, cast(score as bigint) as score
from (select *, row_number() over (partition by row order by score desc, vec_id) as rank from scores)
where rank <= 20
"""


def _licenses() -> str:
    known = ", ".join(f"({_text(name)}, {_text(text)})" for name, text in licenses.KNOWN)
    listed = ", ".join(f"({_text(name)}, {_text(digest)})" for name, digest in DIGESTS)
    mark = "[ \\t*#/;|%<>=!-]*"
    spellings = ", ".join(f"{_text(a)}: {_text(b)}" for a, b in licenses.EQUIVALENT.items())
    small = f"translate(line, '{_UPPER}', '{_LOWER}')"
    plain = f"regexp_replace({small}, '[\\x{{2010}}-\\x{{201F}}\\x{{A0}}\\x{{A9}}\\x{{AB}}\\x{{BB}}]|[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]', ' ', 'g')"
    return f"""
with known(license, text) as (values {known}),
texts as (
  select 'd' as kind, row_number() over () as row, doc_id, null as license, coalesce(text, '') as text from documents
  union all select 'k', row_number() over (), null, license, text from known),
split as (select kind, row, string_split(text, chr(10)) as lines from texts),
lines as (select kind, row, unnest(lines) as line, generate_subscripts(lines, 1) as n from split),
words as (
  select kind, row, n, list_filter(string_split({plain}, ' '), lambda w: w <> '') as w from lines
  where not regexp_matches({small}, '^{mark}(?:copyright\\b|\\(c\\)|©|all rights reserved\\b)')
     or regexp_matches({small}, '^{mark}copyright[ \\t]+(?:holders?|owners?|notices?|laws?|licenses?|statements?|and|or|in|to|interests?)\\b')),
canonical as (
  select kind, row, n, array_to_string(list_transform(w, lambda x: coalesce(map {{{spellings}}}[x], x)), ' ') as line
  from words where len(w) > 0),
wholes as (select kind, row, string_agg(line, ' ' order by n) as whole, count(*) as n from canonical group by kind, row),
digests(license, digest) as (values {listed}),
named as (
  select digest, min(license) as license
  from (select license, sha256(whole) as digest from texts join wholes using (kind, row) where kind = 'k'
        union all select license, digest from digests) group by digest),
noticed as (
  select c.row, string_agg(distinct license, ',' order by license) as notices
  from canonical c join wholes using (kind, row) join named on digest = sha256(c.line)
  where kind = 'd' and wholes.n > 1 group by c.row)
select doc_id, sha256(coalesce(whole, '')) as digest, named.license, coalesce(notices, '') as notices
from texts left join wholes using (kind, row) left join named on digest = sha256(coalesce(whole, ''))
  left join noticed using (row)
where kind = 'd'
"""


INFILL = """
with docs as (
  select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
         sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h from documents),
dealt as (
  select *, [cast('0x' || substr(h, 8 * i + 1, 8) as bigint) for i in range(4)] as d from docs),
cut as (
  select *, least(d[1] % (n + 1), d[2] % (n + 1)) as a, greatest(d[1] % (n + 1), d[2] % (n + 1)) as b,
         case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or d[3] % 100 >= 90 then 'plain'
              when d[4] % 100 < 20 then 'spm' else 'psm' end as form from dealt),
parts as (select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1) as s from cut)
select doc_id, cast(n as bigint) as n, form,
       case when form <> 'plain' then cast(a as bigint) end as prefix_chars,
       case when form <> 'plain' then cast(b - a as bigint) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
              else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(t) as restored_sha256
from parts
"""


def _search(k: int) -> str:
    term = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

    def terms(table: str, name: str) -> str:
        small = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
        return f"select row_number() over () as {name}, *, regexp_extract_all({small}, '{term}') as terms from {table}"

    return f"""
with docs as ({terms("documents", "d")}), items as ({terms("benchmark", "i")}),
totals as (select count(*) filter (len(terms) > 0) as N, cast(sum(len(terms)) as bigint) as L from docs),
tfs as (select d, term, count(*) as tf from (select d, unnest(terms) as term from docs) group by all),
asked as (select i, term, count(*) as times from (select i, unnest(terms) as term from items) group by all),
weights as (select term, cast(floor(1000 * ln((2 * N + 2) / (2 * count(*) + 1))) as bigint) as w from tfs, totals group by term, N),
lengths as (select d, doc_id, 25 + (75 * len(terms) * N) // L as m from docs, totals),
scores as (
  select i, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as score
  from asked join tfs using (term) join weights using (term) join lengths using (d) group by i, d)
select item_id, cast(rank as int) as rank, doc_id, cast(score as bigint) as score
from (select i, doc_id, score, row_number() over (partition by i order by score desc, doc_id) as rank
      from scores join lengths using (d) where score > 0) join items using (i)
where rank <= {k}
"""


ORACLE = {
    "op11_fenwick_infill": INFILL,
    "op12_automaton_search": _search(10),
    "op3_count_min_windows": _windows(35),
    "op5_redirect_aliases": _urls(),
    "op6_maxscore": TOP_K,
    "op9_license_digests": _licenses(),
}
