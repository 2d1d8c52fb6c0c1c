"""The queries of this subpackage that plain SQL expresses, for an independent engine."""

LINE_DEDUP = """
with lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as pos
  from documents
), windows as (
  select doc_id, pos, line as a,
    lead(line, 1) over (partition by doc_id order by pos) as b,
    lead(line, 2) over (partition by doc_id order by pos) as c,
    lead(pos, 2) over (partition by doc_id order by pos) as last
  from lines
), later as (
  select doc_id, pos from (
    select doc_id, pos, row_number() over (partition by a, b, c order by doc_id, pos) as nth
    from windows where last is not null
  ) where nth > 1
), removed as (
  select distinct doc_id, pos + k as pos from later, (values (0), (1), (2)) as t(k)
), starts as (
  select doc_id, count(*) as n_removed, count(*) filter (where before is null or before < pos - 1) as n_spans
  from (select doc_id, pos, lag(pos) over (partition by doc_id order by pos) as before from removed)
  group by doc_id
), kept as (
  select doc_id, string_agg(line, chr(10) order by pos) as text
  from lines anti join removed using (doc_id, pos) group by doc_id
)
select d.doc_id,
  coalesce(len(string_split(d.text, chr(10))), 0)::bigint as n_lines,
  coalesce(s.n_removed, 0)::bigint as n_removed, coalesce(s.n_spans, 0)::bigint as n_spans,
  case when d.text is not null then sha256(coalesce(k.text, '')) end as kept_sha256
from documents d left join starts s using (doc_id) left join kept k using (doc_id)
"""

NEAR_DEDUP = r"""
with recursive words as (
  select doc_id, list_filter(
    string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 or w is null then [] when len(w) = 1 then w
    else list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) end as s
  from words
), texts as (
  select doc_id, len(s)::bigint as n, s, case when len(s) > 0 then md5(list_sort(s)::varchar) else 'none ' || doc_id end as node
  from sets
), nodes as (
  select node, min(n) as n, any_value(s) as s from texts where n > 0 group by node
), shingles as (
  select node, n, unnest(s) as x from nodes
), ranked as (
  select node, n, x, row_number() over (partition by node order by f, x) as place
  from shingles join (select x, count(*) as f from shingles group by x) using (x)
), heads as (
  select node, n, x from ranked where place <= n - ceil(0.8 * n) + 1
), pairs as (
  select distinct a.node as u, b.node as v from heads a join heads b on a.x = b.x
  where a.node < b.node and 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
), links as (
  select u, v from pairs join nodes a on a.node = u join nodes b on b.node = v
  where 100 * len(list_intersect(a.s, b.s)) >= 80 * (a.n + b.n - len(list_intersect(a.s, b.s)))
), edges as (
  select u, v from links union all select v, u from links
), reach(node, other) as (
  select u, v from edges union select r.node, e.v from reach r join edges e on e.u = r.other
), named as (
  select node, min(doc_id) as first from texts group by node
), roots as (
  select n.node, least(n.first, min(o.first)) as component_id
  from named n left join reach r on r.node = n.node left join named o on o.node = r.other
  group by n.node, n.first
)
select t.doc_id, t.n as n_shingles, component_id, t.doc_id = component_id as kept
from texts t join roots using (node)
"""

# The table of CRC-32 by its rule, for `crc32_of`.
CRC_TABLE = """
crc_steps(i, k, v) as (
  select range::bigint, 0, range::bigint from range(256)
  union all select i, k + 1, xor(v >> 1, (v & 1) * 3988292384) from crc_steps where k < 8
), crc_table as (select list(v order by i) as crc_tab from crc_steps where k = 8)"""


def crc32_of(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, for a statement that reads crc_table."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::bigint)"
    step = "lambda a, x: xor(a >> 8, crc_tab[(xor(a, x) & 255) + 1])"
    return f"xor(list_reduce({octets}, {step}, 4294967295::bigint), 4294967295)"


# Ids are unique in these tables, so no id crowds a slot.
SHARDING = f"""
with recursive {CRC_TABLE}, records as (
  select doc_id, (coalesce(octet_length(encode(text)), 0) + 8)::bigint as size,
    {crc32_of("coalesce(text, '')")} as text_crc32,
    (('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 8))::bigint % 16384)::int as virtual_slot
  from documents, crc_table
), slots as (
  select virtual_slot, sum(size)::bigint as bytes,
    row_number() over (order by sum(size) desc, virtual_slot) as n
  from records group by virtual_slot
), deal(n, loads, shard) as (
  select 0::bigint, list_transform(range(24), lambda k: 0::bigint), null::int
  union all
  select s.n, list_transform(loads, lambda load, k: load + case when k = least then s.bytes else 0 end), (least - 1)::int
  from (select n, loads, list_position(loads, list_min(loads)) as least from deal) d join slots s on s.n = d.n + 1
)
select doc_id, size, text_crc32, 'bytes' as law, shard,
  row_number() over (partition by shard order by virtual_slot, doc_id) - 1 as slot,
  null::int as grown_shard, virtual_slot
from records join slots using (virtual_slot) join deal using (n)
"""

def _edit(value: str, cost: str, letters: str) -> str:
    """A value, eight digits of cost and then the audit, after one more edit; compared as text."""
    return f"(printf('%08d', substr({value}, 1, 8)::int + {cost}) || substr({value}, 9) || '{letters}')"


def _with_inserts(z: str, s: str, u: str, a: str) -> str:
    return f"""conv_id, n, z, s, u, least(a, {_edit("u", "5", "I")}) as a from (select conv_id, n, z, s,
      least(u, {_edit("z", "5", "I")}, {_edit("s", "5", "I")}, {_edit("a", "5", "I")}) as u, a from (
        select conv_id, n, {z} as z, {s} as s, {u} as u, {a} as a"""


def _row(to: str, sources: str, initial: str | None, rerole: bool = True) -> str:
    """The cheapest way to a state: a row deleted in it, or kept or given a new role in another state."""
    ways = [_edit(to, "2", "D")]
    for q in sources:
        if initial:
            ways.append(f"case when not due and initial = '{initial}' then {_edit(q, 'extra', 'K')} end")
        if rerole:
            ways.append(f"case when not due then {_edit(q, '1 + extra', 'R')} end")
    return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]


SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
CONVERSATION_REPAIR = f"""
with recursive {CRC_TABLE}, marked as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {crc32_of("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as fault
  from conversations, crc_table
), damaged as (
  select conv_id, turn, case fault when 4 then 'user' else role end as role,
    case fault when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
    unnest(case fault when 3 then [1, 2] else [1] end) as copy
  from marked where fault <> 0
), ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as n,
    substr(role, 1, 1) as initial, rtrim(text, {SPACES}) as ended
  from damaged
), faulty as (
  select *, ended = '' as blank,
    ended <> '' and row_number() over (partition by conv_id, role, text order by n) > 1 as duplicate,
    lag(initial) over (partition by conv_id order by n) as before
  from ordered
), judged as (
  select *, blank or duplicate as due, not blank and not duplicate and right(ended, 1) not in ('.', '!', '?') as truncated,
    case when right(ended, 1) not in ('.', '!', '?') then 5 else 0 end as extra
  from faulty
), counts as (
  select conv_id, count(*) as rows, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
    count(*) filter (where blank)::bigint as blank, count(*) filter (where duplicate)::bigint as duplicate,
    count(*) filter (where truncated)::bigint as truncated,
    count(*) filter (where before is not null and before || initial not in ('su', 'ua', 'au'))::bigint as illegal
  from judged group by conv_id
), best(conv_id, n, z, s, u, a) as (
  select {_with_inserts("'00000000'", "null::varchar", "null::varchar", "null::varchar")}
    from (select distinct conv_id, 0::bigint as n from judged)))
  union all
  select {_with_inserts(_row("z", "", None), _row("s", "z", "s", False), _row("u", "zsa", "u"), _row("a", "u", "a"))}
    from (select b.conv_id, j.n, z, s, u, a, due, extra, initial
      from best b join judged j on j.conv_id is not distinct from b.conv_id and j.n = b.n + 1)))
), chosen as (
  select b.conv_id, substr(least(z, a), 1, 8)::bigint as cost, substr(least(z, a), 9) as audit
  from best b join counts c on c.conv_id is not distinct from b.conv_id and c.rows = b.n
), edits as (
  select conv_id, audit, unnest(range(1, length(audit) + 1)) as k from chosen
), letters as (
  select conv_id, k, substr(audit, k, 1) as edit,
    count(*) filter (where substr(audit, k, 1) <> 'I') over (partition by conv_id order by k) as n,
    count(*) filter (where substr(audit, k, 1) <> 'D') over (partition by conv_id order by k) - 1 as place,
    count(*) filter (where substr(audit, k, 1) <> 'D') over (partition by conv_id) % 2 as odd
  from edits
), repaired as (
  select l.conv_id, string_agg(
    case when edit = 'K' then role when (place - odd) % 2 = 0 then 'user' else 'assistant' end || ':' ||
    case when edit = 'I' then '' else text end, chr(10) order by place) as lines
  from letters l join judged j on j.conv_id is not distinct from l.conv_id and j.n = greatest(l.n, 1)
  where edit <> 'D' group by l.conv_id
)
select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
  sha256(coalesce(lines, '')) as repaired_sha256
from (select distinct conv_id from conversations) i
  left join counts c on c.conv_id is not distinct from i.conv_id
  left join chosen h on h.conv_id is not distinct from i.conv_id
  left join repaired r on r.conv_id is not distinct from i.conv_id
"""

SQL = {
    "op1_line_dedup": LINE_DEDUP, "op3_near_dedup": NEAR_DEDUP, "op12_sharding": SHARDING,
    "op13_conversation_repair": CONVERSATION_REPAIR,
}
