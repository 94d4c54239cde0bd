"""DuckDB SQL for the queries that SQL can express."""

URL_FILTER = r"""
with u as (
  select page_id, coalesce(url, '') as u, strpos(coalesce(url, ''), '://') as i from pages
), r as (
  select page_id, case when i > 0 then substr(u, i + 3) else '' end as rest from u
), s as (
  select page_id, regexp_extract(rest, '^([^/?#]*)', 1) as h0, rest from r
), p as (
  select page_id, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(substr(rest, length(h0) + 1), '^([^?#]*)', 1) as path from s
), rules(rh, rp, rv) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
select page_id, host, path,
       (select rh || rp from rules where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
        order by length(rh || rp) desc limit 1) as rule,
       coalesce((select rv from rules where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)
                 order by length(rh || rp) desc limit 1), 'allow') as verdict
from p
"""

# Runs of at most ten lines, since a line has a word: the shortest from each line on and to each line.
LINE_DEDUP = r"""
with raw as (
  select distinct doc_id, text from documents
), l0 as (
  select doc_id, text, unnest(string_split(text, chr(10))) as s, generate_subscripts(string_split(text, chr(10)), 1) as line
  from raw
), l as (
  select doc_id, text, s, line, row_number() over (partition by doc_id, text order by line) as pos,
         len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) as words
  from l0 where regexp_matches(s, '[^\x20\x09-\x0D]')
), a as (
  select *, list(s) over f as fs, list(words) over f as fw, list(s) over b as bs, list(words) over b as bw
  from l window f as (partition by doc_id, text order by pos rows between current row and 9 following),
                b as (partition by doc_id, text order by pos rows between 9 preceding and current row)
), n as (
  select doc_id, text, pos, fs, bs,
         (select min(i) from range(1, len(fw) + 1) r(i) where list_sum(list_slice(fw, 1, i)) >= 10) as fn,
         (select min(i) from range(1, len(bw) + 1) r(i) where list_sum(list_slice(bw, -i, -1)) >= 10) as bn
  from a
), w as (
  select doc_id, text, pos, fn as run, list_slice(fs, 1, fn) as k from n where fn is not null
  union
  select doc_id, text, pos - bn + 1, bn, list_slice(bs, -bn, -1) from n where bn is not null
), c as (
  select *, row_number() over (partition by k order by doc_id nulls first, text, pos) as r from w
), gone as (
  select distinct doc_id, text, unnest(range(pos, pos + run)) as pos from c where r > 1
), kept as (
  select l0.doc_id, l0.text, count(distinct g.pos) as n_removed,
         coalesce(string_agg(l0.s, chr(10) order by l0.line) filter (g.pos is null), '') as kept
  from l0 left join l using (doc_id, text, line) left join gone g on g.doc_id = l.doc_id and g.text = l.text and g.pos = l.pos
  group by all
)
select d.doc_id, (select count(*) from l where l.doc_id = d.doc_id and l.text = d.text) as n_lines,
       k.n_removed, length(k.kept) as n_chars, md5(k.kept) as text_md5
from documents d join kept k using (doc_id, text)
"""

COLLOCATIONS = r"""
with t as (
  select row_number() over () as d, coalesce(lang, 'und') as lang,
         regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               '[.,;:!?\x0A-\x0D]') as pieces
  from documents
), p as (
  select d, lang, unnest(pieces) as piece, generate_subscripts(pieces, 1) as i from t
), v as (
  select d, lang, i, regexp_extract_all(piece, '[^\x20\x09]+') as words from p
), w as (
  select d, lang, i, unnest(words) as w1, generate_subscripts(words, 1) as pos from v
), g as (
  select lang, w1, lead(w1, 1) over o as w2, lead(w1, 2) over o as w3 from w window o as (partition by d, i order by pos)
), f as materialized (
  select lang || chr(9) || w1 as key, lang, w1 as phrase, w1, null as w2, null as w3, count(*) as f from g group by all
  union all
  select lang || chr(9) || w1 || ' ' || w2, lang, w1 || ' ' || w2, w1, w2, null, count(*) from g where w2 is not null group by all
  union all
  select lang || chr(9) || w1 || ' ' || w2 || ' ' || w3, lang, w1 || ' ' || w2 || ' ' || w3, w1, w2, w3, count(*)
  from g where w3 is not null group by all
), c as materialized (
  select *, f as a from f where w2 is not null and f >= 10
), cut as (
  select key, a, 1 as k, lang || chr(9) || w1 as x, lang || chr(9) || w2 || coalesce(' ' || w3, '') as y from c
  union all
  select key, a, 2, lang || chr(9) || w1 || ' ' || w2, lang || chr(9) || w3 from c where w3 is not null
), s as (
  select cut.key, cut.a, k, fx.f as l, fy.f as r, 1000000 * cut.a::hugeint * cut.a // (fx.f::hugeint * fy.f) as score
  from cut join f fx on fx.key = cut.x join f fy on fy.key = cut.y
), b as (
  select * from (select *, row_number() over (partition by key order by score, k) as o from s) where o = 1
), held as (
  select key, max(a) as longer from (
    select lang || chr(9) || w1 || ' ' || w2 as key, a from c where w3 is not null
    union all select lang || chr(9) || w2 || ' ' || w3, a from c where w3 is not null)
  group by key
), q as (
  select b.*, c.lang, c.phrase from b join c using (key) left join held using (key)
  where longer is null or 100 * longer < 50 * b.a
), n as (
  select lang, count(*) as n from w group by lang
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from q
)
select lang, rank, phrase, a, l, r, n, score::bigint as score from ranked join n using (lang) where rank <= 2000
"""

ORACLES = {
    "op6_line_dedup": LINE_DEDUP,
    "op7_url_filter": URL_FILTER,
    "op11_collocations": COLLOCATIONS,
}
