"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as c
  from embeddings
  where vec_id is not null and embedding is not null
    and list_count(embedding) = len(embedding)
    and len(list_filter(embedding, lambda x: not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, p.vec_id, list_inner_product(q.c, p.c)::bigint as score
  from v q join v p on q.vec_id % 50 = 0 and p.vec_id <> q.vec_id
), r as (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s
)
select query_id, n::int as rank, vec_id, score from r where n <= 5
"""

OP2 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes,
         sha256(coalesce(html, '')) as payload_digest
  from pages
), f as (
  select *, min(page_id) over (partition by payload_digest) as first_page from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id > first_page then 'revisit' else 'response' end
         as record_type,
       case when payload_bytes >= 100 and page_id > first_page then first_page end as refers_to
from f
"""

OP3 = f"""
with l as (
  select doc_id as shown, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad
  from labels group by doc_id
), u as (
  select page_id,
         case when url like '%://%' then translate(
           regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{UPPER}', '{LOWER}') else '' end
           as host,
         case when url like '%://%'
           then regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') else '' end as path
  from pages
), p as (
  select u.*, l.bad from u left join l
    on l.shown = try_cast(regexp_extract(path, '/([0-9]{{1,18}})(\\.html|/)?$', 1) as bigint)
), h0 as (
  select host, count(bad)::double as n, coalesce(sum(bad), 0)::double as k,
         regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*$|\\.$', '') as bare
  from p group by host
), h as (
  select host, n, k, list_extract(string_split(bare, '.'), -1) as suffix,
         array_to_string(list_slice(string_split(bare, '.'), -2, -1), '.') as domain
  from h0
), t as (
  select coalesce(sum(k) / nullif(sum(n), 0), 0.5) as parent from h
), s0 as (
  select suffix, sum(n) as n, sum(k) as k, any_value(parent) as parent from h, t group by suffix
), s as (
  select suffix, (parent * w + k) / (w + n) as parent
  from s0, (select 1 / greatest(1e-4, least(0.5, coalesce(
              sum((k - n * parent) ** 2 - n * parent * (1 - parent))
              / nullif(sum(n * (n - 1) * parent * (1 - parent)), 0), 1e-4))) - 1 as w from s0)
), d0 as (
  select h.suffix, domain, sum(n) as n, sum(k) as k, any_value(parent) as parent
  from h join s on s.suffix = h.suffix group by all
), d as (
  select suffix, domain, (parent * w + k) / (w + n) as parent
  from d0, (select 1 / greatest(1e-4, least(0.5, coalesce(
              sum((k - n * parent) ** 2 - n * parent * (1 - parent))
              / nullif(sum(n * (n - 1) * parent * (1 - parent)), 0), 1e-4))) - 1 as w from d0)
), j0 as (
  select host, n, k, parent from h join d on d.suffix = h.suffix and d.domain = h.domain
), j as (
  select host, parent * w + k as a, (1 - parent) * w + n - k as b
  from j0, (select 1 / greatest(1e-4, least(0.5, coalesce(
              sum((k - n * parent) ** 2 - n * parent * (1 - parent))
              / nullif(sum(n * (n - 1) * parent * (1 - parent)), 0), 1e-4))) - 1 as w from j0)
), m as (
  select host, case when a / (a + b) - 1.6448536269514722
    * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5 then 'block' else 'allow' end as v
  from j
), r as (
  select p.page_id, p.host, p.path, m.v,
    case when (p.host = 'example.org' or p.host like '%.example.org')
              and starts_with(p.path, '/en/1') then 'example.org/en/1'
         when (p.host = 'example.org' or p.host like '%.example.org')
              and starts_with(p.path, '/es/') then 'example.org/es/'
         when (p.host = 'com' or p.host like '%.com') and starts_with(p.path, '/de/')
           then 'com/de/'
         when (p.host = 'com' or p.host like '%.com') and starts_with(p.path, '/fr/')
           then 'com/fr/'
         when (p.host = 'org' or p.host like '%.org') and starts_with(p.path, '/')
           then 'org/' end as rule
  from p join m on m.host = p.host
)
select page_id, host, path, rule,
       case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
            else v end as verdict
from r
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP5 = f"""
with d as (
  select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') as w
  from documents
), i0 as (
  select distinct item_id::varchar as item_id, regexp_extract_all(
    translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_WORDS}') as w
  from benchmark
), i1 as (
  select item_id, w, least(10, len(w)) as size from i0 where len(w) > 0
), i as (
  select distinct item_id, size, array_to_string(list_slice(w, p, p + size - 1), ' ') as key
  from (select *, unnest(range(1, len(w) - size + 2)) as p from i1)
), x as (
  select rid, p, s.size, array_to_string(list_slice(w, p, p + s.size - 1), ' ') as key
  from (select d.*, s.size, unnest(range(1, len(w) - s.size + 2)) as p
        from d, (select distinct size from i) s where len(w) >= s.size) s
), m as (
  select rid, p, x.size, item_id from x join i on i.key = x.key and i.size = x.size
), hit as (
  select rid, count(distinct p + k) as n_hit
  from (select rid, p, unnest(range(0, size)) as k from (select distinct rid, p, size from m))
  group by rid
), ids as (
  select rid, count(distinct item_id) as n_items,
         sha256(array_to_string(list_sort(list_distinct(list(item_id))), ',')) as items_sha256
  from m group by rid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, coalesce(items_sha256, sha256('')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from d left join hit on hit.rid = d.rid left join ids on ids.rid = d.rid
"""

OP10 = r"""
with d as (
  select row_number() over () as rid, doc_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents
), x as (
  select rid, doc_id, p, array_to_string(list_slice(w, p, p + 12), ' ') as key
  from (select *, unnest(range(1, len(w) - 11)) as p from d where len(w) >= 13)
), f as (
  select rid, p, doc_id > min(doc_id) over (partition by key) as again from x
), gone as (
  select distinct rid, p + k as p from (select rid, p, unnest(range(0, 13)) as k from f where again)
), words as (
  select rid, p, w[p] as word from (select rid, w, unnest(range(1, len(w) + 1)) as p from d)
), kept as (
  select words.rid, count(gone.p) as n_removed,
         coalesce(string_agg(word, ' ' order by words.p) filter (gone.p is null), '') as line
  from words left join gone on gone.rid = words.rid and gone.p = words.p group by words.rid
)
select doc_id, len(w)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed,
       sha256(coalesce(line, '')) as kept_sha256
from d left join kept on kept.rid = d.rid
"""

# crc32 in SQL: the table of the reflected polynomial, then one step for each byte of a list
_CRC = """crc_table as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x:
           case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) order by i) as t
  from (select unnest(range(256)) as i)
)"""


def _crc32(byte_list: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, {byte_list}), lambda c, x: "
            "xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295)")


def _digits(value: str) -> str:
    return f"list_transform(string_split({value}::varchar, ''), lambda y: ascii(y)::bigint)"


def _leaf(text: str) -> str:
    parts = [f"coalesce(octet_length(encode({c}::varchar))::varchar || ':' || {c}::varchar, '-')"
             for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(parts)})"


# nodes: one list of digests per lang and level; a lang is keyed so that null comes first
OP11 = f"""
with recursive {_CRC}, d as (
  select row_number() over () as rid, doc_id, coalesce('=' || lang, '') as g,
         {_leaf('text')} as leaf,
         case when {_crc32(_digits('doc_id'))} % 3 = 0
           then {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} else {_leaf('text')} end as got
  from documents, crc_table
), p as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as pos from d
), low as (
  select g, 0 as level, list(leaf order by pos) as nodes from p group by g
  union all
  select g, level + 1, list_transform(range(0, (len(nodes) + 7) // 8), lambda i:
           sha256(array_to_string(list_slice(nodes, i * 8 + 1, i * 8 + 8), '')))
  from low where len(nodes) > 1
), sub as (
  select g, level as height, nodes[1] as subroot,
         row_number() over (order by g) - 1 as place
  from low where len(nodes) = 1
), high as (
  select 0 as level, list(subroot order by place) as nodes from sub
  union all
  select level + 1, list_transform(range(0, (len(nodes) + 7) // 8), lambda i:
           sha256(array_to_string(list_slice(nodes, i * 8 + 1, i * 8 + 8), '')))
  from high where len(nodes) > 1
), steps as (
  select rid, low.level as step, pos // pow(8, low.level)::bigint as i, nodes
  from p join low on low.g = p.g where len(nodes) > 1
  union all
  select rid, height + high.level, place // pow(8, high.level)::bigint, nodes
  from p join sub on sub.g = p.g, high where len(nodes) > 1
), sides as (
  select rid, step, array_to_string(list_slice(nodes, i // 8 * 8 + 1, i), '') as before,
         array_to_string(list_slice(nodes, i + 2, i // 8 * 8 + 8), '') as behind
  from steps
), proofs as (
  select rid, string_agg(before || behind, '' order by step) as proof from sides group by rid
), folds as (
  select rid, 0 as step, got as h from p
  union all
  select s.rid, s.step + 1, sha256(before || h || behind)
  from folds f join sides s on s.rid = f.rid and s.step = f.step
), ends as (
  select rid, arg_max(h, step) as folded_root from folds group by rid
), top as (
  select nodes[1] as root from high where len(nodes) = 1
)
select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root,
       folded_root = root as verified
from p join sub on sub.g = p.g join ends on ends.rid = p.rid left join proofs
  on proofs.rid = p.rid, top
"""

_BYTES = (r"flatten(list_transform(string_split(w, ''), lambda y: case when unicode(y) < 128 "
          r"then [unicode(y)::bigint] else [195, unicode(y)::bigint - 64] end))")

# near words: by a code point left out (insertions, deletions) or left open (replacements)
_ID = _digits("coalesce(doc_id::varchar, '')")

OP13 = rf"""
with recursive {_CRC}, runs as (
  select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                           '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as w
  from documents
), counted as (
  select doc_id, w, count(*) as c from runs where length(w) >= 5 group by all
), hashed as (
  select w, c, {_crc32(f"list_concat({_ID}, [58], {_BYTES})")} as h
  from counted, crc_table
), edited as (
  select case when h % 97 = 0 then left(w, (h % length(w))::int)
                || substr(w, (h % length(w))::int + 2) else w end as word, c
  from hashed
), words as (
  select word, sum(c)::bigint as n from edited where length(word) >= 5
  group by word having sum(c) >= 3
), cut as (
  select word, n, unnest(range(1, length(word) + 1)) as i from words
), less as (
  select distinct word, n, left(word, (i - 1)::int) || substr(word, (i + 1)::int) as rest from cut
), open as (
  select word, n, i, left(word, (i - 1)::int) || substr(word, (i + 1)::int) as rest from cut
), near as (
  select less.word as a, less.n as an, words.word as b, words.n as bn
  from less join words on words.word = less.rest
  union
  select words.word, words.n, less.word, less.n from less join words on words.word = less.rest
  union
  select x.word, x.n, y.word, y.n
  from open x join open y on y.i = x.i and y.rest = x.rest and y.word <> x.word
), best as (
  select a, any_value(an) as an, count(*) as n_near, min((-bn, b)) as m from near group by a
), formed as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
         case when -m[1] >= 2 * w.n then m[2] end as form,
         case when -m[1] >= 2 * w.n then -m[1] end as form_n
  from words w left join best on best.a = w.word
), walk as (
  select word, word as place, 0 as step from formed
  union all
  select walk.word, formed.form, step + 1
  from walk join formed on formed.word = walk.place where formed.form is not null
), ends as (
  select word, arg_max(place, step) as root from walk group by word
)
select f.word, form, root, n, n_near::bigint as n_near, form_n::bigint as form_n
from formed f join ends on ends.word = f.word
"""

ORACLE_SQL = {"op11_merkle": OP11, "op13_spelling": OP13, "op1_topk": OP1, "op2_warc": OP2, "op3_urls": OP3, "op5_decontamination": OP5,
              "op10_substrings": OP10}
