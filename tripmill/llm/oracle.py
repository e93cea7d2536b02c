"""DuckDB SQL for the registered queries of this package that SQL can express."""

from __future__ import annotations

#: Words of every document and item, for texts of the given table.
_WORDS = """list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"""

#: Shared by the query and the pipeline; {docs} is the table judged.
DECONTAMINATE = f"""
item as (select item_id, {_WORDS} as w from benchmark),
win as (
  select item_id, least(len(w), 13) as n,
    unnest(list_transform(range(0, len(w) - least(len(w), 13) + 1),
      lambda i: array_to_string(w[i + 1 : i + least(len(w), 13)], ' '))) as gram
  from item where len(w) > 0),
doc as (select doc_id, len(w) as n_words, w from (select doc_id, {_WORDS} as w from {{docs}})),
place as (
  select doc_id, n, unnest(range(1, n_words - n + 2)) as start, w
  from doc, (select distinct n from win) where n_words >= n),
hit as (
  select doc_id, start, n, item_id
  from (select doc_id, start, n, array_to_string(w[start : start + n - 1], ' ') as gram from place)
  join win using (gram, n)),
hit_words as (
  select doc_id, count(distinct word) as n_hit
  from (select doc_id, unnest(range(start, start + n)) as word from (select distinct doc_id, start, n from hit))
  group by doc_id),
hit_items as (
  select doc_id, count(distinct item_id) as n_items,
    string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items
  from hit group by doc_id),
rated as (
  select doc_id, n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
    sha256(coalesce(items, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= n_words as contaminated
  from doc left join hit_words using (doc_id) left join hit_items using (doc_id))
"""

ORACLE: dict[str, str] = {
    "op2_voronoi_top_k": """
with v as (
  select vec_id as id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
c as (
  select id, v as vector, generate_subscripts(v, 1) as i, unnest(v) as x from v),
s as (
  select q.id as query_id, d.id as vec_id, sum(q.x * d.x)::bigint as score
  from c q join c d on q.i = d.i and len(q.vector) = len(d.vector)
  where q.id % 50 = 0 and q.id <> d.id
  group by q.id, d.id),
r as (
  select query_id, vec_id, score,
    row_number() over (partition by query_id order by score desc, vec_id)::int as rank
  from s)
select query_id, rank, vec_id, score from r where rank <= 5""",
    "op8_decontaminate": f"with {DECONTAMINATE.format(docs='documents')} select * from rated",
    # crc32 by its definition, bit by bit; nodes are lists of (role, text).
    "op12_prefix_trie": """
with t as (
  select conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
    order by turn nulls first) as own
  from conversations where conv_id is not null group by conv_id),
crc as (
  select conv_id, own,
    xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint),
      lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), range(0, 8)),
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384)),
      4294967295::bigint), 4294967295) % 6 as h
  from t),
built as (
  select c.conv_id,
    list_concat(b.own[1 : c.h], c.own[c.h + 1 : len(c.own)]) as seq
  from crc c left join t b on b.conv_id = c.conv_id - c.conv_id % 100),
member as (
  select conv_id, d as depth, seq[1:d] as prefix, len(seq) as n
  from (select *, unnest(range(0, len(seq) + 1)) as d from built)),
node as (
  select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (n = depth), '') as ends
  from member group by depth, prefix),
child as (
  select p.depth, p.prefix, count(*) as n_children
  from node c join node p on c.depth = p.depth + 1 and c.prefix[1 : p.depth] = p.prefix
  group by p.depth, p.prefix),
own as (
  select n.*, coalesce(n_children, 0) as n_children,
    case when depth = 0 then 0 else (n_convs - 1) * length(prefix[depth].text) end as saved
  from node n left join child using (depth, prefix)),
sub as (
  select a.depth, a.prefix, count(*) filter (b.n_children = 0) as n_leaves, sum(b.saved)::bigint as saved_tokens
  from own a join own b on b.depth >= a.depth and b.prefix[1 : a.depth] = a.prefix
  group by a.depth, a.prefix)
select own.conv_id, own.depth, p.conv_id as parent_conv_id, own.n_convs, own.n_children,
  sub.n_leaves, sub.saved_tokens, sha256(own.ends) as ends_sha256
from own join sub using (depth, prefix)
left join node p on p.depth = own.depth - 1 and p.prefix = own.prefix[1 : own.depth - 1]""",
}
