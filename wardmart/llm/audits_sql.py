"""The n-gram join, the source divergence audit and the clustering as SQL for the checking engine."""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Sets of five-word shingles, links by their shared shingles, and all that links reach.
NGRAMS = rf"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
  from documents),
s as materialized (
  select doc_id, case
    when len(words) >= 5 then list_distinct(list_transform(
      generate_series(1, len(words) - 4), lambda i: array_to_string(words[i:i + 4], ' ')))
    when len(words) > 0 then [array_to_string(words, ' ')] else [] end as shingles from w),
e as materialized (select doc_id, len(shingles) as n, unnest(shingles) as shingle from s),
l as materialized (
  select a.doc_id as a, b.doc_id as b from e a join e b on a.shingle = b.shingle and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))),
r(a, b) as (select a, b from l union select r.a, l.b from r join l on r.b = l.a)
select s.doc_id, len(s.shingles)::bigint as n_shingles, least(s.doc_id, coalesce(min(r.b), s.doc_id)) as component_id
from s left join r on r.a = s.doc_id group by s.doc_id, len(s.shingles)
"""

DIVERGENCE = rf"""
with d as materialized (
  select row_number() over () as id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as words from documents),
t as materialized (
  select id, lang, source, term, count(*) as n from (select id, lang, source, unnest(words) as term from d) group by all),
k as materialized (select lang, term from t group by all having count(*) >= 10),
g as (select distinct lang, source from d),
v as (select g.lang, count(k.term) as size from (select distinct lang from g) g left join k using (lang) group by 1),
c as (select lang, source, term, sum(n) as n from t join k using (lang, term) group by all),
x as materialized (
  select lang, source, term, n,
    (1 + (1000000000::hugeint * (n + 2)) // (sum(n) over (partition by lang, source) + 2 * size))::hugeint as p
  from (select g.lang, g.source, k.term, v.size, coalesce(c.n, 0)::hugeint as n
        from g join k using (lang) join v using (lang) left join c using (lang, source, term))),
y as materialized (
  select lang, term, (1 + (1000000000::hugeint * (n + 2)) // (sum(n) over (partition by lang) + 2 * size))::hugeint as q
  from (select lang, term, any_value(size) as size, sum(n)::hugeint as n from x join v using (lang) group by all)),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(f.value, 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (
    select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) as value
    from x a join x b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all) f
    on f.lang = a.lang and f.source = a.source and f.item = b.source),
words as (
  select lang, source, 'term' as part, term as item, ((p - q) * (p - q) // (p + q))::bigint as value
  from x join y using (lang, term) where n > 0 and p > q),
r as (
  select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
  from (select * from pairs union all select * from words))
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 10
"""

CLUSTERS, ROUNDS = 16, 3


def _assign(centroids: str) -> str:
    """Each vector's nearest centroid; the smaller number on a tie."""
    return f"""
  select row, vec_id, e, arg_min(number, (distance, number)) as cluster, min(distance) as distance from (
    select v.row, v.vec_id, v.e, c.number,
      list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint as distance
    from v cross join {centroids} c) group by row, vec_id, e"""


def _move(assigned: str, centroids: str) -> str:
    """Floors of the means; a centroid without vectors stays."""
    return f"""
  select c.number, coalesce(m.e, c.e) as e from {centroids} c left join (
    select cluster, list((s - ((s % n) + n) % n) // n order by place) as e from (
      select cluster, place, sum(x)::hugeint as s, count(*) as n from (
        select cluster, unnest(e) as x, generate_subscripts(e, 1) as place from {assigned})
      group by cluster, place) group by cluster) m on m.cluster = c.number"""


_ROUNDS = "".join(
    f"a{i} as materialized ({_assign(f'c{i}')}),\nc{i + 1} as materialized ({_move(f'a{i}', f'c{i}')}),\n"
    for i in range(ROUNDS))

CENTROIDS = f"""
with v as materialized (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::hugeint) as e
  from embeddings where len(embedding) = 64
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c0 as materialized (
  select row_number() over (order by sha256('1:' || vec_id), e) - 1 as number, e from v
  order by sha256('1:' || vec_id), e limit {CLUSTERS}),
{_ROUNDS}
a as materialized ({_assign(f'c{ROUNDS}')}),
s as (select cluster, sum(distance)::bigint as cluster_inertia from a group by cluster)
select a.vec_id, a.cluster::int as cluster, a.distance, s.cluster_inertia,
  (select sum(distance)::bigint from a) as inertia, sha256(array_to_string(c.e, ',')) as centroid_sha256
from a join s using (cluster) join c{ROUNDS} c on c.number = a.cluster
"""
