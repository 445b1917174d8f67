"""SQL for the corpus queries that SQL can express."""

SQL = {
    "op12_angle_negatives": """
with usable as (
    select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [floor(256 * x::double) for x in embedding] as q
    from embeddings
    where label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
scored as (
    select a.id as anchor_id, a.label as anchor_label, r.id, r.label, list_inner_product(a.q, r.q)::bigint as score
    from usable a join usable r on a.id <> r.id where a.id % 100 = 0
),
positives as (
    select anchor_id, anchor_label, id as positive_id, score as positive_score from scored where label = anchor_label
    qualify row_number() over (partition by anchor_id order by score desc, id) <= 5
)
select p.anchor_id, p.positive_id, cast(row_number() over w as int) as rank, n.id as negative_id, p.positive_score, n.score as negative_score
from positives p join scored n
  on n.anchor_id = p.anchor_id and n.label <> p.anchor_label
 and 80 * p.positive_score <= 100 * n.score and 100 * n.score <= 100 * p.positive_score
window w as (partition by p.anchor_id, p.positive_id order by n.score desc, n.id)
qualify row_number() over w <= 5
""",
    # DuckDB has no crc32: it is built up bit by bit.
    "op13_prefix_trie": """
with recursive ids as (select distinct conv_id from conversations where conv_id is not null),
crc(conv_id, digits, bit, value) as (
    select conv_id, conv_id::varchar, 0, 4294967295::bigint from ids
    union all
    select conv_id, digits, bit + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384::bigint) else v >> 1 end
    from (
        select conv_id, digits, bit, case when bit % 8 = 0 then xor(value, ascii(digits[bit // 8 + 1])::bigint) else value end as v
        from crc where bit < 8 * length(digits)
    )
),
heads as (
    select conv_id, xor(value, 4294967295::bigint) % 6 as h from crc where bit = 8 * length(digits)
),
original as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first, coalesce(role, '')) as d
    from conversations
),
rebuilt as (
    select h.conv_id, o.d, o.role, o.text from heads h join original o on o.conv_id = h.conv_id - h.conv_id % 100 and o.d <= h.h
    union all
    select h.conv_id, o.d, o.role, o.text from heads h join original o on o.conv_id = h.conv_id and o.d > h.h
),
lists as (
    select i.conv_id, coalesce(list(sha256(length(r.role) || ':' || r.role || r.text) order by r.d) filter (r.d is not null), []) as keys,
           coalesce(list(length(r.text) order by r.d) filter (r.d is not null), []) as sizes
    from ids i left join rebuilt r on r.conv_id = i.conv_id group by i.conv_id
),
members as (
    select conv_id, d as depth, len(keys) = d as ends_here, list_slice(keys, 1, d) as prefix, case when d = 0 then 0 else sizes[d] end as size
    from (select *, unnest(range(len(keys) + 1)) as d from lists)
),
nodes as (
    select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs, any_value(size) as size,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends_here), '')) as ends_sha256
    from members group by depth, prefix
),
linked as (
    select n.*, p.conv_id as parent_conv_id,
           (select count(*) from nodes c where c.depth = n.depth + 1 and list_slice(c.prefix, 1, n.depth) = n.prefix) as n_children
    from nodes n left join nodes p on p.depth = n.depth - 1 and p.prefix = list_slice(n.prefix, 1, n.depth - 1)
),
below as (
    select m.depth, m.prefix, count(*) filter (u.n_children = 0) as n_leaves, sum((u.n_convs - 1) * u.size) as saved_tokens
    from linked u join members m on m.conv_id = u.conv_id and m.depth <= u.depth group by m.depth, m.prefix
)
select n.conv_id, n.depth, n.parent_conv_id, n.n_convs, n.n_children, b.n_leaves, cast(b.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from linked n join below b on b.depth = n.depth and b.prefix = n.prefix
""",
}
