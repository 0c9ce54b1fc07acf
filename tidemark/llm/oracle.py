"""The same questions in SQL, where SQL can express them."""

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_QUALITY = (
    r"""
with docs as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text,
         coalesce('=' || lang, '') as lk, coalesce('=' || source, '') as sk, """
    + _WORDS
    + r""" as w
  from documents),
windows as (
  select r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
  from (select r, w, unnest(range(1, len(w) - 1)) as i from docs)),
again as (select r, i from (select r, i, count(*) over (partition by r, g) as n from windows) where n > 1),
covered as (
  select r, count(distinct p) as n from (select r, i + unnest([0, 1, 2]) as p from again) group by r),
lines as (
  select r, count(*) as n, count(*) - count(distinct ln) as dup
  from (select r, unnest(string_split(text, chr(10))) as ln from docs)
  where regexp_matches(ln, '[^\x20\x09-\x0D]') group by r),
counts as (
  select docs.r, doc_id, lk, sk, cast(len(w) as bigint) as n_words,
         cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(lines.dup, 0) as bigint) as n_dup_lines, lines.n as n_lines,
         cast(coalesce(covered.n, 0) as bigint) as n_repeat_words
  from docs left join lines using (r) left join covered using (r)),
judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
measured as (
  select r, lk, sk, unnest([
    {'m': 'symbols', 'v': 1000 * n_symbols // word_chars}, {'m': 'length', 'v': 100 * word_chars // n_words},
    {'m': 'lines', 'v': 1000 * n_dup_lines // n_lines}, {'m': 'repeats', 'v': 1000 * n_repeat_words // n_words}]) as x
  from judged where not base_failed),
bucketed as (
  select lk, sk, x.m as m, (x.v >> greatest(length(bin(x.v)) - 7, 0)) << greatest(length(bin(x.v)) - 7, 0) as b
  from measured),
levels as (
  select 0 as level, lk, sk, m, b from bucketed
  union all select 1, lk, null, m, b from bucketed
  union all select 2, null, null, m, b from bucketed),
running as (
  select level, lk, sk, m, b, sum(n) over (partition by level, lk, sk, m order by b) as upto,
         sum(n) over (partition by level, lk, sk, m) as total
  from (select level, lk, sk, m, b, count(*) as n from levels group by all)),
quarters as (
  select level, lk, sk, m, max(total) as n, min(b) filter (4 * upto >= total) as q1,
         min(b) filter (4 * upto >= 3 * total) as q3
  from running group by all),
fences as (
  select level, lk, sk, m, n, q1 - 3 * greatest(q3 - q1, least_spread) as lo, q3 + 3 * greatest(q3 - q1, least_spread) as hi
  from quarters join (values ('symbols', 20), ('length', 50), ('lines', 150), ('repeats', 100)) as t(m, least_spread) using (m)),
chosen as (
  select a.lk, a.sk, a.m,
         case when a.n >= 200 then a.lo when l.n >= 200 then l.lo else e.lo end as lo,
         case when a.n >= 200 then a.hi when l.n >= 200 then l.hi else e.hi end as hi
  from fences a join fences l on l.level = 1 and l.lk = a.lk and l.m = a.m join fences e on e.level = 2 and e.m = a.m
  where a.level = 0),
faults as (
  select distinct r from measured join chosen on measured.lk = chosen.lk and measured.sk = chosen.sk and x.m = chosen.m
  where x.v > hi or (x.m = 'length' and x.v < lo))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and r not in (select r from faults) as kept
from judged
"""
)

_MIXING = (
    """
with sizes as (
  select row_number() over () as r, doc_id, source, coalesce('=' || source, '') as k, cast(len("""
    + _WORDS
    + """) as bigint) as size
  from documents),
sources as (select k, min(source) as source, cast(sum(size) as bigint) as source_size from sizes group by k),
weighed as (
  select *, [3, 1, 2][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight, 2 * source_size as cap from sources),
shared as (
  select *, row_number() over w as place,
         (3 * sum(source_size) over () / 2 - coalesce(sum(cap) over (w rows between unbounded preceding and 1 preceding), 0))
         / (sum(weight) over () - coalesce(sum(weight) over (w rows between unbounded preceding and 1 preceding), 0)) as per
  from weighed window w as (order by cap * 6 // weight, source nulls last)),
level as (select min(place) as place, min_by(per, place) as per from shared where per * weight <= cap),
aims as (
  select k, source, source_size, cast(case when shared.place >= level.place then level.per * weight else cap end as double) as target
  from shared, level),
bounds as (
  select *, cast(floor(target) as bigint) as words, sum(cast(floor(target) as hugeint)) over () as total,
         sum(cast(floor(target) as hugeint)) over (order by source nulls last) as upto
  from aims),
points as (
  select *, cast((upto - words) * 4294967296 // total as bigint) as lo, cast(upto * 4294967296 // total as bigint) as hi
  from bounds where total > 0),
slots as (
  select unnest(range(cast(ceil((select max(total) from points) / 256.0) as bigint))) as slot),
given as (
  select k, row_number() over (partition by k order by slot) - 1 as rank
  from slots join points on (slot % 4294967296) * 2654435769 % 4294967296 >= lo and (slot % 4294967296) * 2654435769 % 4294967296 < hi),
placed as (
  select r, sizes.k, size, sum(size) over (partition by sizes.k order by md5(coalesce(cast(doc_id as varchar), '')), doc_id, size, r
         rows between unbounded preceding and current row) - size as start
  from sizes),
spans as (
  select r, k, start + p * source_size as f, least(start + p * source_size + size, words) as t
  from placed join bounds using (k), (values (0), (1)) as rounds(p) where size > 0),
pieces as (
  select r, k, f, t, unnest(range(cast(f // 256 as bigint), cast((t - 1) // 256 + 1 as bigint))) as rank from spans where f < t),
taken as (
  select r, sum(least(t, (rank + 1) * 256) - greatest(f, rank * 256)) as taken from pieces join given using (k, rank) group by r)
select doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from sizes join aims using (k) left join taken using (r)
"""
)

_DIVERGENCE = r"""
WITH given AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
),
said AS (SELECT lang, source, doc, unnest(words) AS term FROM given),
kept AS (SELECT lang, term, count(*) AS n FROM said GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
langs AS (
  SELECT lang, coalesce(sum(n), 0)::HUGEINT AS total, count(term)::HUGEINT AS v
  FROM (SELECT DISTINCT lang FROM given) LEFT JOIN kept USING (lang) GROUP BY lang
),
counts AS (SELECT lang, source, term, count(*) AS n FROM said JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM given) LEFT JOIN counts USING (lang, source) GROUP BY lang, source
),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000 * (coalesce(c.n, 0) + 2)::HUGEINT) // (g.total + 2 * l.v) AS p,
    1 + (1000000000 * (k.n + 2)::HUGEINT) // (l.total + 2 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

_WARC = r"""
with given as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes,
    unhex(sha1(coalesce(html, '')))::bit::varchar as bits
  from pages),
firsts as (select html, min(page_id) as first from given group by html)
select page_id, payload_bytes::bigint as payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (substr(bits, 1 + i * 5, 5)::bit::integer), 1)), '') as payload_digest,
  case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id is distinct from first then first end as refers_to
from given join firsts using (html)
"""

ORACLE: dict[str, str] = {
    "op7_quality_rules": _QUALITY,
    "op8_source_mixing": _MIXING,
    "op11_source_divergence": _DIVERGENCE,
    "op13_warc": _WARC,
}
