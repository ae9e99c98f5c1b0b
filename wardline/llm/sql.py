"""What some of the operators compute, as plain SQL over whole tables, written for DuckDB and apart from their methods."""

from __future__ import annotations

# All pairs of documents that share a shingle, and what can be reached from each.
NGRAM_JOIN = r"""
with recursive worded as (
  select doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents
),
sets as (
  select doc_id, list_distinct(case when len(words) < 5 then [array_to_string(words, ' ')]
           else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingles
  from worded where len(words) > 0
),
entries as (
  select doc_id, shingle from (select doc_id, unnest(shingles) as shingle from sets)
  qualify count(*) over (partition by shingle) > 1
),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from entries a join entries b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
),
links as (
  select a, b from common join sets x on x.doc_id = a join sets y on y.doc_id = b
  where 100 * n >= 80 * (len(x.shingles) + len(y.shingles) - n)
),
both_ways as (select a, b from links union all select b, a from links),
reached(doc_id, other) as (
  select a, a from both_ways
  union
  select r.doc_id, e.b from reached r join both_ways e on e.a = r.other
),
components as (select doc_id, min(other) as component_id from reached group by doc_id)
select doc_id, cast(coalesce(len(shingles), 0) as bigint) as n_shingles, coalesce(component_id, doc_id) as component_id
from documents left join sets using (doc_id) left join components using (doc_id)
"""

# Every string of 50 bytes, as hexadecimal digits, with the first document that has it; runs of covered bytes from their places.
SUFFIX_DEDUP = r"""
with bytes as (select doc_id, hex(encode(coalesce(text, ''))) as digits, strlen(coalesce(text, '')) as n from documents),
pieces as (
  select doc_id, n, low, substring(digits, 2 * low + 1, 2 * 549) as piece
  from (select *, unnest(range(0, n - 49, 500)) as low from bytes where n >= 50)
),
strings as (
  select doc_id, low + own as place, md5(substring(piece, 2 * own + 1, 100)) as string
  from (select *, unnest(range(least(500, n - 49 - low))) as own from pieces)
),
repeated as (
  select doc_id, place from strings join (select string, min(doc_id) as first_doc from strings group by string) using (string)
  where first_doc < doc_id
),
marked as (
  select *, case when place > lag(place) over places + 50 then 1 else 0 end as opens
  from repeated window places as (partition by doc_id order by place)
),
runs as (
  select doc_id, min(place) as low, max(place) + 50 as high
  from (select *, sum(opens) over (partition by doc_id order by place) as run from marked) group by doc_id, run
),
gaps as (
  select doc_id, low, high, coalesce(lag(high) over (partition by doc_id order by low), 0) as after from runs
),
removed as (
  select doc_id, sum(high - low) as n_removed, count(*) as n_spans,
         string_agg(substring(digits, 2 * after + 1, 2 * (low - after)), '' order by low)
           || substring(any_value(digits), 2 * max(high) + 1) as kept
  from gaps join bytes using (doc_id) group by doc_id
)
select doc_id, n as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed, coalesce(n_spans, 0) as n_spans,
       sha256(unhex(coalesce(kept, digits))) as kept_sha256
from bytes left join removed using (doc_id)
"""
