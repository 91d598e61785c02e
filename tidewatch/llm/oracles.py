"""DuckDB SQL for the operators that plain SQL can express."""

PHRASES = r"""
with doc_words as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select doc_id, coalesce(text, '') as text from documents)),
item_words as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from (select item_id, coalesce(text, '') as text from benchmark)),
windows as (
  select distinct item_id, least(len(w), 10) as k, array_to_string(w[s:s + 9], ' ') as phrase
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as s from item_words where len(w) > 0)),
lengths as (select distinct k from windows),
places as (
  select doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') as phrase
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as s from doc_words, lengths where len(w) >= k)),
hits as (select p.doc_id, p.s, p.k, i.item_id from places p join windows i on i.phrase = p.phrase and i.k = p.k),
covered as (select doc_id, count(distinct pos) as n_hit from (select doc_id, unnest(range(s, s + k)) as pos from hits) group by doc_id),
named as (select doc_id, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from hits group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from doc_words d left join covered c on c.doc_id = d.doc_id left join named n on n.doc_id = d.doc_id
"""

VECTORS = r"""
with recursive usable as (
  select vec_id, list_transform(embedding, lambda x: x::double) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a, usable b
  where a.vec_id <> b.vec_id and list_cosine_similarity(a.v, b.v) >= 0.95),
reach(id, to_id) as (select vec_id, vec_id from embeddings union select r.id, l.b from reach r join links l on l.a = r.to_id),
least as (select id, min(to_id) as component_id from reach group by id)
select e.vec_id, (select count(*) from links where a = e.vec_id)::bigint as n_links, component_id, e.vec_id = component_id as kept
from embeddings e join least on least.id = e.vec_id
"""

JACCARD = r"""
with recursive doc_words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
  select distinct doc_id, array_to_string(w[s:s + 4], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as s from doc_words where len(w) > 0)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
shared_grams as (select a.doc_id as a, b.doc_id as b, count(*) as o from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from shared_grams join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * o >= 75 * (x.n + y.n - o)),
reach(id, to_id) as (select doc_id, doc_id from doc_words union select r.id, l.b from reach r join links l on l.a = r.to_id),
least as (select id, min(to_id) as component_id from reach group by id)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
from doc_words d left join sizes s on s.doc_id = d.doc_id join least on least.id = d.doc_id
"""

REPEATS = r"""
with doc_words as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
windows as (
  select doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) as h
  from (select doc_id, w, unnest(range(1, len(w) - 33)) as s from doc_words where len(w) >= 35)),
twice as (select h from windows group by h having count(*) > 1),
gone as (select distinct doc_id, unnest(range(s, s + 35)) as pos from windows semi join twice using (h)),
kept as (
  select d.doc_id, string_agg(word, ' ' order by pos) as t, count(*) as n
  from (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as pos from doc_words) d anti join gone using (doc_id, pos)
  group by d.doc_id)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from doc_words d left join kept k on k.doc_id = d.doc_id
"""
