"""DuckDB SQL of the queries that SQL can express, written independently of the Spark code."""

from __future__ import annotations

OP2 = r"""
with recursive s as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         md5(cast(doc_id as varchar)) as k from documents
),
src as (
  select source, cast(sum(size) as bigint) as source_size,
         cast(row_number() over (order by source nulls last) - 1 as bigint) as idx from s group by source
),
wt as (select *, [5, 2, 1][idx % 3 + 1] as w, 2 * source_size as cap from src),
lv as (
  select *, 1.5::double * sum(source_size) over () as budget,
    (1.5::double * sum(source_size) over () - coalesce(sum(cap) over o, 0)) / (sum(w) over () - coalesce(sum(w) over o, 0)) as level
  from wt window o as (order by cap / w::double, idx rows between unbounded preceding and 1 preceding)
),
cp as (select *, cap / w::double <= level as capped from lv),
tg as (
  select idx, source, source_size, case when capped then cap::double
    else w * (budget - sum(case when capped then cap else 0 end) over ()) / sum(case when capped then 0 else w end) over () end as target,
    (source_size + 31) // 32 as blocks from cp
),
sl as (select *, case when source_size > 0 then cast(floor(target * blocks / source_size + 0.5) as bigint) else 0 end as slots from tg),
cum as (select idx, slots, sum(slots) over (order by idx) - slots as lo, sum(slots) over (order by idx) as hi from sl),
tot as (select cast(sum(slots) as bigint) as t from sl),
draw as (
  select id // 4096 as shard, cast('0x' || substr(md5(concat('draw:7:', id)), 1, 15) as bigint) % t as pick
  from (select t, unnest(range(0, t)) as id from tot)
),
cnt as (select shard, idx, count(*) as n from draw join cum on pick >= lo and pick < hi group by all),
strt as (select *, sum(n) over (partition by idx order by shard) - n as start from cnt),
had as (select sl.idx, slots, coalesce(sum(n), 0) as had from sl left join cnt using (idx) group by all),
moves as (
  select idx, slots, had, sum(greatest(had - slots, 0)) over w - greatest(had - slots, 0) as extra_at,
    sum(greatest(slots - had, 0)) over w - greatest(slots - had, 0) as short_at, sum(greatest(slots - had, 0)) over w as short_to
  from had window w as (order by idx)
),
each as (select shard, idx, unnest(range(cast(start as bigint), cast(start + n as bigint))) as slot from strt),
fin as (
  select shard, idx, slot from each join moves using (idx) where slot < slots
  union all
  select e.shard, d.idx, cast(d.had + m.extra_at + e.slot - m.slots - d.short_at as bigint)
  from each e join moves m on e.idx = m.idx and e.slot >= m.slots
  join moves d on m.extra_at + e.slot - m.slots >= d.short_at and m.extra_at + e.slot - m.slots < d.short_to
),
side as (
  select idx, blocks, cast(ceil(sqrt(blocks)) as bigint) as wide, (blocks + wide - 1) // wide as high, unnest([0, 1]) as turn
  from sl where slots > 0
),
keyed as (
  select *, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 0)), 1, 15) as bigint) % 2147483646 + 1 as a0, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 1)), 1, 15) as bigint) % 2147483647 as b0, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 2)), 1, 15) as bigint) % 2147483646 + 1 as c0, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 3)), 1, 15) as bigint) % 2147483647 as d0,
    cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 4)), 1, 15) as bigint) % 2147483646 + 1 as a1, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 5)), 1, 15) as bigint) % 2147483647 as b1, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 6)), 1, 15) as bigint) % 2147483646 + 1 as c1, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 7)), 1, 15) as bigint) % 2147483647 as d1,
    cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 8)), 1, 15) as bigint) % 2147483646 + 1 as a2, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 9)), 1, 15) as bigint) % 2147483647 as b2, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 10)), 1, 15) as bigint) % 2147483646 + 1 as c2, cast('0x' || substr(md5(concat('order:7:', idx, ':', turn, ':', 11)), 1, 15) as bigint) % 2147483647 as d2
  from side
),
walk as (
  select idx, turn, slot % blocks as i, slot % blocks as x, 0 as step from fin join sl using (idx) join side using (idx, blocks)
  where turn = slot // blocks
  union all
  select idx, turn, i, l3 * high + r3, step + 1 from (
    select w.*, high, blocks, x // high as l0, x % high as r0,
      ((r0 * a0 + b0) % 2147483647) as t0, (l0 + t0 * t0 % 2147483647 % wide) % wide as l1, ((l1 * c0 + d0) % 2147483647) as u0, (r0 + u0 * u0 % 2147483647 % high) % high as r1,
      ((r1 * a1 + b1) % 2147483647) as t1, (l1 + t1 * t1 % 2147483647 % wide) % wide as l2, ((l2 * c1 + d1) % 2147483647) as u1, (r1 + u1 * u1 % 2147483647 % high) % high as r2,
      ((r2 * a2 + b2) % 2147483647) as t2, (l2 + t2 * t2 % 2147483647 % wide) % wide as l3, ((l3 * c2 + d2) % 2147483647) as u2, (r2 + u2 * u2 % 2147483647 % high) % high as r3
    from walk w join keyed using (idx, turn) where step = 0 or x >= blocks
  )
),
blk as (
  select idx, x as block, count(*) as times from walk join sl using (idx) where step > 0 and x < blocks group by all
),
pos as (
  select s.doc_id, size, idx, source_size, target,
    coalesce(sum(size) over (partition by idx order by k, doc_id rows between unbounded preceding and 1 preceding), 0) as o
  from s join sl on s.source is not distinct from sl.source
),
pc as (select doc_id, idx, o, size, unnest(range(cast(o // 32 as bigint), cast((o + size - 1) // 32 + 1 as bigint))) as block from pos where size > 0),
tk as (
  select doc_id, sum((least(o + size, (pc.block + 1) * 32) - greatest(o, pc.block * 32)) * times) as taken
  from pc join blk on pc.idx = blk.idx and pc.block = blk.block group by doc_id
)
select pos.doc_id, size, source_size, target, cast(coalesce(taken, 0) as bigint) as taken
from pos left join tk using (doc_id)
"""

OP3 = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents
),
sh as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s
  from (select doc_id, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5)
  union select doc_id, array_to_string(ws, ' ') from w where len(ws) between 1 and 4
),
n as (select doc_id, count(*) as n from sh group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as i from sh x join sh y on x.s = y.s and x.doc_id < y.doc_id group by 1, 2
),
links as (
  select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * i >= 85 * (na.n + nb.n - i)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as v, doc_id as c from n
  union select b, c from reach join both_ways on a = v
),
comp as (select v, min(c) as c from reach group by v)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(c, w.doc_id) as component_id,
  w.doc_id = coalesce(c, w.doc_id) as kept
from w left join n on n.doc_id = w.doc_id left join comp on v = w.doc_id
"""

OP5 = r"""
with p as (select page_id, coalesce(html, '') as h from pages),
x as (select page_id, cast(octet_length(encode(h)) as bigint) as payload_bytes, sha1(h) as s from p),
f as (select *, min(page_id) over (partition by s) as first from x),
v as (
  select *, list_transform(range(0, 8), lambda g: cast('0x' || substr(s, cast(5 * g + 1 as bigint), 5) as bigint)) as q from f
)
select page_id, payload_bytes,
  array_to_string(list_transform(q, lambda n: array_to_string(list_transform([15, 10, 5, 0],
    lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((n >> b) % 32 + 1 as bigint), 1)), '')), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to, true as whole
from v
"""

OP7 = r"""
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
win as (
  select doc_id, i, substr(x, 2 * i + 1, 100) as w
  from (select doc_id, x, unnest(range(0, len(x) // 2 - 49)) as i from d where len(x) >= 100)
),
firsts as (select w, min(doc_id) as f from win group by w having min(doc_id) <> max(doc_id)),
hit as (select doc_id, i from win join firsts using (w) where f < doc_id),
isl as (
  select doc_id, i, sum(case when i <= prev + 50 then 0 else 1 end) over (partition by doc_id order by i) as g
  from (select doc_id, i, coalesce(lag(i) over (partition by doc_id order by i), -100) as prev from hit)
),
runs as (select doc_id, min(i) as b, max(i) + 50 as e from isl group by doc_id, g),
gaps as (
  select doc_id, b, lag(e, 1, 0) over (partition by doc_id order by b) as prev_e, e,
         lead(b) over (partition by doc_id order by b) as nxt from runs
),
kept as (
  select g.doc_id, string_agg(substr(x, 2 * prev_e + 1, 2 * (b - prev_e)), '' order by b)
         || substr(max(x), 2 * max(e) + 1) as k, sum(e - b) as lost, count(*) as n
  from gaps g join d using (doc_id) group by g.doc_id
)
select d.doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(lost, 0) as bigint) as n_removed,
  cast(coalesce(n, 0) as bigint) as n_spans, sha256(unhex(coalesce(k, x))) as kept_sha256
from d left join kept using (doc_id)
"""

OP9 = r"""
with d as (select doc_id, source, coalesce(text, '') as text from documents),
w as (select doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from d),
win as (
  select doc_id, i, array_to_string(ws[i:i + 7], ' ') as run
  from (select doc_id, ws, unnest(range(1, len(ws) - 6)) as i from w where len(ws) > 8)
),
rep as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, run) as n from win) where n > 1),
cov as (select doc_id, count(distinct p) as n_repeat_words
        from (select doc_id, unnest(range(i, i + 8)) as p from rep) group by doc_id),
ln as (select doc_id, source, unnest(string_split(text, chr(10))) as l from d),
ok as (select doc_id, source, l from ln where regexp_matches(l, '[^\x20\x09-\x0D]')),
dup as (select doc_id, count(*) - count(distinct l) as n_dup_lines from ok group by doc_id),
norm as (
  select doc_id, source, lower(trim(regexp_replace(l, '[\x20\x09-\x0D]+', ' ', 'g'))) as k,
         sum(len(regexp_extract_all(l, '[^\x20\x09-\x0D]+'))) as lw
  from ok group by all
),
hot as (select source, k, min(doc_id) as first_doc from norm group by source, k having count(distinct doc_id) >= 10),
lost as (
  select n.doc_id, sum(lw) as lost from norm n join hot h on n.k = h.k and n.source is not distinct from h.source
  where n.doc_id <> h.first_doc group by n.doc_id
),
m as (
  select w.doc_id, cast(len(ws) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) as bigint) as word_chars,
    cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines,
    cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
    cast(len(ws) - coalesce(lost, 0) as bigint) as left_words
  from w left join cov using (doc_id) left join dup using (doc_id) left join lost using (doc_id)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 20 or 100 * n_repeat_words > 30 * n_words) as base_failed, left_words,
  not (n_words < 20 or 100 * n_repeat_words > 30 * n_words) and not (100 * left_words < 30 * n_words) as kept
from m
"""

OP10 = r"""
with cap as (
  select page_id, cast((page_id * 7919) % 365 as int) as day,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.+$', ''), '') as host
  from pages
),
hosts as (select distinct host from cap where host is not null),
lab as (select host, string_split(host, '.') as ls from hosts),
par as (select host, array_to_string(ls[i:], '.') as domain, len(ls) - i + 1 as labels
        from (select host, ls, unnest(range(1, len(ls))) as i from lab)),
pairs as (
  select domain, l.list, l.allows, cast('0x' || substr(md5(l.list || '|' || domain), 1, 8) as bigint) as b
  from (select distinct domain from par),
       (values ('adult', false), ('malware', false), ('partners', true), ('spam', false)) as l(list, allows)
),
ev as (
  select list, allows, domain, b, cast((b // 5) % 330 as int) as day, true as added from pairs where b % 5 = 0
  union all select list, allows, domain, b, cast((b // 5) % 330 + 10 + (b // 7) % 90 as int), false
    from pairs where b % 5 = 0 and b % 2 = 0
  union all select list, allows, domain, b, cast((b // 5) % 330 + 25 + (b // 7) % 90 as int), true
    from pairs where b % 5 = 0 and b % 2 = 0 and b % 3 = 0
),
iv as (
  select *, lead(day) over (partition by list, domain order by day) as till from ev
),
hit as (
  select c.host, c.day, i.list, i.allows, p.labels
  from (select distinct host, day from cap where host is not null) c join par p on p.host = c.host
  join iv i on i.domain = p.domain and i.added and i.day <= c.day and (i.till is null or c.day < i.till)
),
best as (
  select host, day, string_agg(distinct list, ',' order by list) as lists, count(distinct list) as n_lists,
    arg_max(allows, labels * 1000000 + (case when allows then 100000 else 0 end)) as allows
  from hit group by host, day
)
select page_id, cap.host, cap.day, coalesce(lists, '') as lists, cast(coalesce(n_lists, 0) as bigint) as n_lists,
  case when coalesce(allows, true) then 'keep' else 'drop' end as verdict
from cap left join best on cap.host = best.host and cap.day = best.day
"""

OP11 = r"""
with c as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, t, r, '\### Assistant: </turn> ok' from (values (0, 'user'), (1, 'assistant')) x(t, r)
),
e as (
  select *, length(text) + length(regexp_replace(text, '[^\\]', '', 'g')) + len(string_split(text, '### ')) - 1
    + len(string_split(text, '</turn>')) - 1 + len(string_split(text, '<|')) - 1
    + length('### : </turn>') + 1
    + case when role in ('system', 'user', 'assistant', 'tool') then length(role) end as n from c
),
g as (
  select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn) as said,
    coalesce(string_agg(case when role = 'assistant' then text end, '' order by turn), '') as loss, sum(n) as n from e group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, cast(length(loss) as bigint) as loss_chars,
  sha256(loss) as loss_sha256, cast(n as bigint) as formatted_chars from g
"""

OP13 = r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from documents
),
q as (
  select distinct item_id, term from (
    select item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark)
),
g as (select cast(count(*) as bigint) as nn, cast(sum(len(ws)) as bigint) as ll from d where len(ws) > 0),
o as (select doc_id, cast(len(ws) as bigint) as n, unnest(ws) as term from d),
tf as (select doc_id, n, term, count(*) as tf from o where term in (select term from q) group by all),
w as (
  select term, cast(floor(1000 * ln((2 * (select nn from g) + 2) / (2 * count(*) + 1)::double)) as bigint) as w from tf group by term
),
s as (
  select item_id, doc_id,
    cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * nn) // ll)))) as bigint) as score
  from q join tf using (term) join w using (term) cross join g group by item_id, doc_id
),
r as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 50
"""

ORACLE: dict[str, str] = {
    "op2_source_mix": OP2,
    "op3_minhash_dedup": OP3,
    "op5_warc": OP5,
    "op7_suffix_dedup": OP7,
    "op9_quality_rules": OP9,
    "op10_url_filters": OP10,
    "op11_chat_format": OP11,
    "op13_ranked_search": OP13,
}
