"""The operators' results as DuckDB SQL, where SQL can express them."""

ORACLES: dict[str, str] = {}

ORACLES["op4_stratified_interleaving"] = """
with crc_table as (
  select list_transform(range(0, 16), lambda i: list_reduce([0, 1, 2, 3], lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as steps),
nibbles as (
  select rowid as r, doc_id, coalesce('=' || source, '') as stratum, octet_length(encode(coalesce(text, ''))) + 1 as size,
    md5('docloom-1:' || coalesce(doc_id::varchar, 'null')) as h, string_split(regexp_replace(hex(encode(coalesce(text, ''))), '(.)(.)', '\\2\\1', 'g'), '') as parts
  from (select *, row_number() over () as rowid from documents)),
numbers as (
  select * exclude parts, list_transform(list_filter(parts, lambda x: x <> ''), lambda x: strpos('0123456789ABCDEF', x)::bigint - 1) as parts from nibbles),
docs as (
  select * exclude parts, xor(list_reduce(parts, lambda c, x: xor(c >> 4, steps[(xor(c, x) & 15) + 1]), 4294967295::bigint), 4294967295) as crc from numbers, crc_table),
ranked as (
  select *, row_number() over (partition by stratum order by h, doc_id, size, crc) as rank, count(*) over (partition by stratum) as total from docs),
spots as (
  select *, row_number() over (order by (rank * 2 - 1)::double / (total * 2)::double, stratum, h, doc_id, size, crc) - 1 as pos, count(*) over () as n from ranked),
cut as (
  select *, n // 16 as each, n % 16 as more from spots),
placed as (
  select *, case when pos < more * (each + 1) then pos // (each + 1) else more + (pos - more * (each + 1)) // greatest(each, 1) end as shard from cut)
select doc_id, size::bigint as size, crc::bigint as text_crc32, 'rows' as law, shard::int as shard,
  (pos - case when shard < more then shard * (each + 1) else more * (each + 1) + (shard - more) * each end)::bigint as slot, null::int as grown_shard
from placed
"""

ORACLES["op5_url_rules"] = """
with rules(host, path, verdict) as (
  values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
rest as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path, row_number() over () as r from rest),
met as (
  select p.r, arg_max(rules.host || rules.path, length(rules.host || rules.path)) as rule, arg_max(verdict, length(rules.host || rules.path)) as verdict
  from parts p join rules on (p.host = rules.host or ends_with(p.host, '.' || rules.host)) and starts_with(p.path, rules.path) group by p.r)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from parts left join met using (r)
"""

_WORDS = ("list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')")

ORACLES["op3_positional_contamination"] = f"""
with doc_words as (select doc_id, row_number() over () as r, {_WORDS} as words from documents),
item_words as (select item_id, {_WORDS} as words from benchmark),
windows as (
  select distinct item_id, least(len(words), 13) as length, array_to_string(words[j:j + least(len(words), 13) - 1], ' ') as phrase
  from (select item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) as j from item_words where len(words) > 0)),
spans as (
  select r, j, length, array_to_string(words[j:j + length - 1], ' ') as phrase
  from (select r, words, length, unnest(range(1, len(words) - length + 2)) as j from doc_words, (select distinct length from windows) where len(words) >= length)),
found as (select s.r, s.j, w.length, w.item_id from spans s join windows w using (length, phrase)),
hits as (select r, count(distinct pos) as n_hit from (select r, unnest(range(j, j + length)) as pos from found) group by r),
listed as (select r, list_sort(list(distinct item_id::varchar)) as items from found where item_id is not null group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(len(items), 0)::bigint as n_items,
  sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(words) as contaminated
from doc_words left join hits using (r) left join listed using (r)
"""

ORACLES["op10_bottom_k_near_duplicates"] = """
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D\\x20]+'), lambda w: w <> '') as words
  from documents),
shingles as (
  select distinct doc_id, array_to_string(words[j:j + 4], ' ') as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as j from words where len(words) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as common from shingles a join shingles b using (shingle) where a.doc_id < b.doc_id group by all),
links as (select a, b from shared join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * common >= 75 * (x.n + y.n - common)),
edges as materialized (select a, b from links union all select b, a from links),
reached(doc_id, other) as (select a, b from edges union select reached.doc_id, edges.b from reached join edges on reached.other = edges.a),
lowest as (select doc_id, min(other) as other from reached group by doc_id)
select doc_id, coalesce(n, 0)::bigint as n_shingles, least(doc_id, coalesce(other, doc_id)) as component_id, doc_id = least(doc_id, coalesce(other, doc_id)) as kept
from words left join sizes using (doc_id) left join lowest using (doc_id)
"""

ORACLES["op7_block_search"] = """
with vectors as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v) as score from vectors q join vectors c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id and len(c.v) = len(q.v)),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

ORACLES["op11_quality_rules"] = """
with words as (
  select row_number() over () as r, doc_id, lang, source, coalesce(text, '') as text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x09-\\x0D\\x20]+'), lambda w: w <> '') as words
  from documents),
windows as (
  select r, j, array_to_string(words[j:j + 7], ' ') as phrase from (select r, words, unnest(range(1, len(words) - 6)) as j from words where len(words) >= 8)),
twice as (select r, phrase from windows group by all having count(*) > 1),
covered as (select r, count(distinct p) as n from (select r, unnest(range(j, j + 8)) as p from windows semi join twice using (r, phrase)) group by r),
lines as (select r, len(l) as n_lines, len(l) - len(list_distinct(l)) as n_dup
  from (select r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x09-\\x0D\\x20]')) as l from words)),
counted as (
  select r, doc_id, lang, source, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, n_dup::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words, n_lines
  from words join lines using (r) left join covered c using (r)),
base as (select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from counted),
measures as (
  select r, lang, source, measure, value, part_width, value // part_width * part_width + part_width // 2 as part, base_failed
  from (select *, (1::bigint << greatest(length(bin(value)) - 9, 0)::int) as part_width
    from (select r, lang, source, base_failed, unnest(['word_length', 'symbols', 'dup_lines', 'repeat_words']) as measure,
      unnest([1000 * word_chars // greatest(n_words, 1), 1000 * n_symbols // greatest(n_words, 1), 1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)]) as value from base))),
sketched as (select * from measures where not base_failed),
ranked as (
  select lang, source, measure, part, count(*) over g as n_g, count(*) over l as n_l, count(*) over a as n_a,
    row_number() over (partition by lang, source, measure order by part) as i_g, row_number() over (partition by lang, measure order by part) as i_l, row_number() over (partition by measure order by part) as i_a
  from sketched window g as (partition by lang, source, measure), l as (partition by lang, measure), a as (partition by measure)),
q_a as (select measure, any_value(n_a) as n, min(part) filter (i_a >= 0.25::double * n_a)::double as low, min(part) filter (i_a >= 0.75::double * n_a)::double as high from ranked group by measure),
q_l0 as (select lang, measure, any_value(n_l) as n, min(part) filter (i_l >= 0.25::double * n_l)::double as low, min(part) filter (i_l >= 0.75::double * n_l)::double as high from ranked group by lang, measure),
q_g0 as (select lang, source, measure, any_value(n_g) as n, min(part) filter (i_g >= 0.25::double * n_g)::double as low, min(part) filter (i_g >= 0.75::double * n_g)::double as high from ranked group by all),
q_l as (select l.lang, measure, (l.n * l.low + 100 * a.low) / (l.n + 100) as low, (l.n * l.high + 100 * a.high) / (l.n + 100) as high from q_l0 l join q_a a using (measure)),
q_g as (select g.lang, g.source, g.measure, (g.n * g.low + 100 * l.low) / (g.n + 100) as low, (g.n * g.high + 100 * l.high) / (g.n + 100) as high
  from q_g0 g join q_l l on g.measure = l.measure and g.lang is not distinct from l.lang),
limits as (
  select lang, source, measure, case when measure = 'word_length' then low - 3 * greatest(high - low, 200::double) else 0 end as floor,
    high + 3 * greatest(high - low, case measure when 'word_length' then 200 when 'symbols' then 50 else 100 end::double) as ceiling from q_g),
failed as (
  select distinct r from measures m join limits l on m.measure = l.measure and m.lang is not distinct from l.lang and m.source is not distinct from l.source where value > ceiling or value < floor)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and r not in (select r from failed) as kept from base
"""

ORACLES["op13_hard_negatives"] = """
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same, list_dot_product(a.v, c.v)::bigint as score from rows a join rows c on a.vec_id % 100 = 0 and c.vec_id <> a.vec_id and len(a.v) = len(c.v)),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id, (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank, vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id) where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify row_number() over (partition by anchor_id, positive_id order by score desc, vec_id) <= 10
"""
