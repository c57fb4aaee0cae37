"""What the queries return, as SQL over the same tables, where SQL can state it."""

ORACLES: dict[str, str] = {
    "op11_exact_top_k": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as u
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
p as (
  select q.vec_id as query_id, c.vec_id,
    cast(list_sum(list_transform(list_zip(q.u, c.u), lambda z: z[1] * z[2])) as bigint) as score
  from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id
),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 5
""",
    "op12_collocations": r"""
with t as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents
),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from t),
g as (
  select lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i : i + k - 1], ' '))) as phrase
  from w, range(1, 5) as s(k) where len(ws) >= k
),
f as (select lang, k, phrase, cast(count(*) as bigint) as a from g group by lang, k, phrase having count(*) >= 30),
n as (select lang, cast(sum(len(ws)) as bigint) as n from w group by lang),
c as (select lang, k, phrase, a, string_split(phrase, ' ') as ws from f where k > 1),
u as (select c.*, unnest(range(1, k)) as cut from c),
x as (
  select u.lang, u.phrase, u.k, u.a, u.cut, l.a as l, r.a as r,
    cast((2000000 * u.a::hugeint) // (l.a + r.a) as bigint) as score
  from u
  join f l on l.lang = u.lang and l.phrase = array_to_string(u.ws[1 : u.cut], ' ')
  join f r on r.lang = u.lang and r.phrase = array_to_string(u.ws[u.cut + 1 : u.k], ' ')
),
b as (select *, row_number() over (partition by lang, phrase order by score, cut) as best from x),
i as (
  select lang, a, m, unnest(list_transform(range(1, k - m + 2), lambda p: array_to_string(ws[p : p + m - 1], ' '))) as phrase
  from c, range(2, 4) as s(m) where m < k
),
o as (select lang, phrase, max(a) as longer from i group by lang, phrase),
k as (
  select b.lang, b.phrase, b.a, b.l, b.r, n.n, b.score,
    row_number() over (partition by b.lang order by b.score desc, b.a desc, b.phrase) as rank
  from b join n on n.lang = b.lang left join o on o.lang = b.lang and o.phrase = b.phrase
  where b.best = 1 and (o.longer is null or 100 * o.longer < 80 * b.a)
)
select lang, cast(rank as bigint) as rank, phrase, a, l, r, n, score from k where rank <= 2000
""",
}


def _added(value: str, cost: str, edit: str) -> str:
    """A state's value, eight digits of cost and then the audit, after one more edit."""
    return f"(printf('%08d', cast({value}[1:8] as integer) + {cost}) || {value}[9:] || '{edit}')"


def _repair_sql() -> str:
    """The states are nothing yet (n), after s, after u and after a (s, u, a). A recursion takes the
    messages of all conversations one by one; the least value is the cheapest and then ASCII-least."""
    crc = """list_reduce(range(1, len(k) + 1), lambda c, i: list_reduce(range(8), lambda x, j:
    case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end, xor(c, ord(k[i]))), 4294967295)"""
    into_u = lambda cost, edit: ", ".join(_added(v, cost, edit) for v in ("n", "s", "a"))
    insert = f"n, s, least(u, {into_u('3', 'I')}) as u, least(a, {_added('u', '3', 'I')}) as a"
    kept = "not lost"
    step = f"""{_added('n', '4', 'D')} as n,
    least({_added('s', '4', 'D')}, case when {kept} and initial = 's' then {_added('n', 'more', 'K')} end) as s,
    least({_added('u', '4', 'D')}, case when {kept} then least({into_u('3 + more', 'R')}) end,
      case when {kept} and initial = 'u' then least({into_u('more', 'K')}) end) as u,
    least({_added('a', '4', 'D')}, case when {kept} then {_added('u', '3 + more', 'R')} end,
      case when {kept} and initial = 'a' then {_added('u', 'more', 'K')} end) as a"""
    spaces = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as k
  from conversations
),
kinds as (select *, xor({crc}, 4294967295) % 20 as kind from keyed),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from kinds where kind <> 0
),
ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as i,
    right(rtrim(text, {spaces}), 1) as last, role[1:1] as initial
  from damaged
),
faulty as (
  select *, case when last = '' then 'blank'
      when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
      when last in ('.', '!', '?') then 'fine' else 'truncated' end as fault,
    i > 1 and lag(initial) over (partition by conv_id order by i) || initial not in ('su', 'ua', 'au') as breaks
  from ordered
),
rows_of as (select conv_id, i, initial, fault in ('blank', 'duplicate') as lost, case when fault = 'truncated' then 3 else 0 end as more from faulty),
dp as (
  select distinct conv_id, cast(0 as bigint) as i, '00000000' as n, cast(null as varchar) as s, cast(null as varchar) as u, cast(null as varchar) as a
  from conversations
  union all
  select w.conv_id, w.i, {step}
  from (select conv_id, i, {insert} from (select conv_id, i, {insert} from dp)) d
  join rows_of w on w.conv_id is not distinct from d.conv_id and w.i = d.i + 1
),
ended as (select * from dp qualify row_number() over (partition by conv_id order by i desc) = 1),
best as (
  select conv_id, least(n, a) as value from (select conv_id, i, {insert} from (select conv_id, i, {insert} from ended))
),
letters as (
  select conv_id, value[9:] as audit, unnest(range(1, len(value) - 7)) as p from best where len(value) > 8
),
edits as (
  select conv_id, p, audit[p] as edit, len(replace(audit, 'D', '')) % 2 as odd,
    len(replace(audit[1:p], 'I', '')) as i, len(replace(audit[1:p], 'D', '')) as o
  from letters
),
messages as (
  select e.conv_id, e.p, case when edit = 'K' then f.role when (o - 1 + odd) % 2 = 0 then 'user' else 'assistant' end as role,
    case when edit = 'I' then '' else f.text end as text
  from edits e left join faulty f on f.conv_id is not distinct from e.conv_id and f.i = e.i and e.edit <> 'I'
  where edit <> 'D'
),
texts as (select conv_id, string_agg(role || ':' || text, chr(10) order by p) as repaired from messages group by conv_id),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'blank') as blank,
    count(*) filter (where fault = 'duplicate') as duplicate, count(*) filter (where fault = 'truncated') as truncated,
    count(*) filter (where breaks) as illegal
  from faulty group by conv_id
)
select b.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(value[1:8] as bigint) as cost, value[9:] as audit,
  sha256(coalesce(repaired, '')) as repaired_sha256
from best b
left join counts c on c.conv_id is not distinct from b.conv_id
left join texts t on t.conv_id is not distinct from b.conv_id
"""


ORACLES["op13_repaired_chats"] = _repair_sql()
