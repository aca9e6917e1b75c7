"""DuckDB SQL of the queries that SQL can express."""

_DIGITS = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((cast('0x' || substr(h, {5 * k + 1}, 5) as bigint) >> {s}) & 31)::int + 1, 1)"
                      for k in range(8) for s in (15, 10, 5, 0))

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
         "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"



def _tree(name: str, base: str, levels: int = 8) -> str:
    """The levels of the trees over ``base`` (g, idx, n, d), and each node's siblings before and after it."""
    out = f"{name}0 as ({base})"
    for k in range(levels):
        out += f""",
{name}{k + 1} as (select g, idx // 8 as idx, (n + 7) // 8 as n, sha256(string_agg(d, '' order by idx)) as d from {name}{k} where n > 1 group by g, idx // 8, n),
{name}s{k} as (select a.g, a.idx, coalesce(string_agg(b.d, '' order by b.idx) filter (b.idx < a.idx), '') as b, coalesce(string_agg(b.d, '' order by b.idx) filter (b.idx > a.idx), '') as a
  from {name}{k} a join {name}{k} b on a.g = b.g and a.idx // 8 = b.idx // 8 where a.n > 1 group by a.g, a.idx)"""
    return out


def _walk(rows: str, name: str, g: str, idx: str, levels: int = 8) -> str:
    """Add the siblings on the way up to ``proof``, and fold ``back`` with them."""
    for k in range(levels):
        rows = f"""(select r.* exclude (proof, back), r.proof || coalesce(s.b || s.a, '') as proof,
  case when s.g is null then r.back else sha256(s.b || r.back || s.a) end as back
  from {rows} r left join {name}s{k} s on s.g = r.{g} and s.idx = r.{idx} // {8 ** k})"""
    return rows


_FIELD = "coalesce(strlen({0}::varchar) || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD + ")"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc(text: str) -> str:
    """CRC-32 of an ASCII string of up to 40 characters, bit by bit."""
    return f"""(xor(list_reduce(list_prepend(4294967295::bigint, [ascii(c)::bigint for c in string_split({text}, '')]),
  lambda a, c: list_reduce([xor(a, c), 1, 2, 3, 4, 5, 6, 7, 8], lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295::bigint))"""


SQL: dict[str, str] = {
    "op1_chat_format": """
with recursive c as (
  select conv_id, cast(turn as bigint) as turn, role, coalesce(text, '') as text,
         'call_' || substr(md5(conv_id::varchar || ':' || turn::varchar), 1, 16) as own,
         'call_' || substr(md5(conv_id::varchar || ':' || (turn - 1)::varchar), 1, 16) as before,
         case when turn >= 2 then 'call_' || substr(md5(conv_id::varchar || ':' || (turn - 2)::varchar), 1, 16) end as earlier,
         'call_' || substr(md5(conv_id::varchar || ':' || (turn + 2)::varchar), 1, 16) as later
  from conversations),
calls as (
  select *, ['search', 'lookup', 'translate', 'unlisted'][(length(text) % 4) + 1] as name,
         len(string_split(text, ' ')) as words,
         list_filter(case when conv_id % 26 = 0 then [earlier, later] when conv_id % 13 = 0 then [later]
                          when conv_id % 17 = 0 then ['call_none'] else [earlier] end, lambda x: x is not null) as deps
  from c where role = 'assistant'),
results as (
  select conv_id, before as call_id, turn, text, row_number() over (partition by conv_id, before order by turn, text) as n,
         count(*) over (partition by conv_id, before) as results
  from c where role = 'user' and turn >= 1),
edges as (
  select e.conv_id, e.own, e.dep, d.own is not null as there
  from (select distinct conv_id, own, unnest(deps) as dep from calls) e
  left join (select distinct conv_id, own from calls) d on d.conv_id = e.conv_id and d.own = e.dep),
sizes as (select conv_id, count(*) as size from calls group by 1),
paths as (
  select conv_id, own as origin, own as cur, 0 as hops from calls
  union
  select p.conv_id, p.origin, e.dep, p.hops + 1 from paths p join edges e on e.conv_id = p.conv_id and e.own = p.cur
  join sizes on sizes.conv_id = p.conv_id
  where e.there and p.hops < sizes.size),
stage as (select p.conv_id, origin, max(hops) as hops, max(hops) >= any_value(size) as endless
          from paths p join sizes on sizes.conv_id = p.conv_id group by 1, 2),
gone as (select distinct conv_id, own from edges where not there),
shaped as (
  select calls.conv_id, calls.own as call_id, calls.turn, name, calls.text, words,
         case when endless then null else coalesce(hops, 0) end as stage,
         coalesce(endless, false) as cyclic, gone.own is not null as missing, results.text as result, results.call_id is not null as linked,
         coalesce(results.results, 0) > 1 as repeated
  from calls left join stage on stage.conv_id = calls.conv_id and stage.origin = calls.own
  left join gone on gone.conv_id = calls.conv_id and gone.own = calls.own
  left join results on results.conv_id = calls.conv_id and results.call_id = calls.own and n = 1),
checked as (
  select *, list_filter([
      case when name = 'unlisted' then 'tool: unknown' end,
      case when name = 'lookup' and conv_id % 7 = 0 then 'missing: limit' end,
      case when name <> 'unlisted' and conv_id % 7 <> 0 and turn % 5 = 3 then 'type: limit' end,
      case when name <> 'unlisted' and conv_id % 11 = 0 then 'unknown: extra' end,
      case when cyclic and missing then 'dependency: cycle; dependency: missing' when cyclic then 'dependency: cycle' when missing then 'dependency: missing' end,
      case when repeated then 'result: repeated' end], lambda x: x is not null) as errors,
    case when linked then 'linked' else 'missing_result' end as status,
    '{' || concat_ws(',', case when conv_id % 11 = 0 then '"extra":true' end,
      case when conv_id % 7 = 0 then null when turn % 5 = 3 then '"limit":"' || words || '"' else '"limit":' || words end,
      '"query":' || to_json(text)::varchar) || '}' as arguments
  from shaped)
select conv_id, call_id, cast(stage as bigint) as stage, turn, name, status, array_to_string(errors, ', ') as errors,
  '{' || concat_ws(',', '"arguments":' || arguments, '"call_id":"' || call_id || '"', '"errors":' || to_json(errors)::varchar, '"name":"' || name || '"',
    '"result":' || to_json(result)::varchar, '"status":"' || status || '"', '"turn":' || turn) || '}' as message
from checked
union all
select conv_id, call_id, null, turn, null, 'orphan_result', case when results > 1 then 'result: repeated' else '' end,
  '{' || concat_ws(',', '"call_id":"' || call_id || '"', case when results > 1 then '"errors":["result: repeated"]' else '"errors":[]' end,
    '"result":' || to_json(text)::varchar, '"status":"orphan_result"', '"turn":' || turn) || '}'
from results where n = 1 and not exists (select 1 from calls where calls.conv_id = results.conv_id and calls.own = results.call_id)
""",
    "op2_warc_revisits": f"""
with p as (select page_id, coalesce(html, '') as html from pages),
d as (select page_id, cast(strlen(html) as bigint) as payload_bytes, sha1(html) as h from p),
f as (select *, min(page_id) over (partition by h, payload_bytes) as least from d)
select page_id, payload_bytes, {_DIGITS} as payload_digest,
       case when page_id = least then 'response' else 'revisit' end as record_type,
       case when page_id = least then null else least end as refers_to
from f
""",
    "op11_decontamination": f"""
with d as (select doc_id, row_number() over () as r, {_WORDS} as w from documents),
b as (select item_id, {_WORDS} as w from benchmark where item_id is not null),
cut as (select item_id, w, least(len(w), 10) as n from b where len(w) > 0),
bw as (select distinct item_id, n, array_to_string(w[i + 1:i + n], ' ') as win
       from (select item_id, w, n, unnest(range(0, len(w) - n + 1)) as i from cut)),
dw as (select r, n, i, array_to_string(w[i + 1:i + n], ' ') as win
       from (select r, w, n, unnest(range(0, len(w) - n + 1)) as i from d, (select distinct n from bw))),
hit as (select r, n, i, item_id from dw join bw using (n, win)),
places as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from (select distinct r, n, i from hit)) group by r),
names as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item_id::varchar as item from hit) group by r)
select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
       n_hit is not null as contaminated
from d left join places using (r) left join names using (r)
""",
    "op12_manifest": f"""
with src as (select *, dense_rank() over (order by lang nulls first) - 1 as g, {_LEAF.format('text')} as leaf,
    case when {_crc('doc_id::varchar')} % 3 = 0 then {_LEAF.format(_LOWER)} else {_LEAF.format('text')} end as back from documents),
leaves as (select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by g) as n from src),
{_tree('l', 'select g, idx, n, leaf as d from leaves')},
subroots as (select g, d from (select *, max(lv) over (partition by g) as top from ({" union all ".join(f"select g, d, {k} as lv from l{k}" for k in range(9))})) where lv = top),
{_tree('t', 'select 0 as g, g as idx, count(*) over () as n, d from subroots')},
root as (select d from (select d, lv, max(lv) over () as top from ({" union all ".join(f"select d, {k} as lv from t{k}" for k in range(9))})) where lv = top),
begun as (select doc_id, leaf, subroots.d as subroot, root.d as root, leaves.g, idx, 0 as zero, '' as proof, back
  from leaves join subroots using (g), root)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, back as folded_root, back = root as verified
from {_walk(_walk('begun', 'l', 'g', 'idx'), 't', 'zero', 'g')} x
""",
    "op13_repair": f"""
with recursive told as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {_crc("(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '))")} % 20 as kind from conversations),
rows_ as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from told where kind <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from rows_),
seen as (select *, row_number() over (partition by conv_id, role, text order by i) as nth, lag(role[1]) over (partition by conv_id order by i) || role[1] as pair,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z', 1) as final from placed),
r as (select *, case when final = '' then 1 when nth > 1 then 2 when final not in ('.', '!', '?') then 3 else 0 end as fault from seen),
dp as (
  select conv_id, 0::bigint as i, {{'c': 0, 'a': '', 'r': []::varchar[]}} as z, {{'c': 1000000000, 'a': '', 'r': []::varchar[]}} as s,
         {{'c': 2, 'a': 'I', 'r': ['user:']}} as u, {{'c': 4, 'a': 'II', 'r': ['user:', 'assistant:']}} as a
  from (select distinct conv_id from r)
  union all
  select conv_id, i, z, s, u, list_min([a, {{'c': u.c + 2, 'a': u.a || 'I', 'r': list_append(u.r, 'assistant:')}}]) as a
  from (select conv_id, i, z, s, list_min([u, {", ".join(f"{{'c': {x}.c + 2, 'a': {x}.a || 'I', 'r': list_append({x}.r, 'user:')}}" for x in "zsa")}]) as u, a
  from (select dp.conv_id, r.i,
    {{'c': z.c + 3, 'a': z.a || 'D', 'r': z.r}} as z,
    list_min([{{'c': s.c + 3, 'a': s.a || 'D', 'r': s.r}},
      {{'c': z.c + (fault = 3)::int + case when fault in (1, 2) or role[1] <> 's' then 1000000000 else 0 end, 'a': z.a || 'K', 'r': list_append(z.r, role || ':' || text)}}]) as s,
    list_min([{{'c': u.c + 3, 'a': u.a || 'D', 'r': u.r}}, {", ".join(
      f"{{'c': {x}.c + (fault = 3)::int + case when fault in (1, 2) or role[1] <> 'u' then 1000000000 else 0 end, 'a': {x}.a || 'K', 'r': list_append({x}.r, role || ':' || text)}}, "
      f"{{'c': {x}.c + 2 + (fault = 3)::int + case when fault in (1, 2) then 1000000000 else 0 end, 'a': {x}.a || 'R', 'r': list_append({x}.r, 'user:' || text)}}" for x in "zsa")}]) as u,
    list_min([{{'c': a.c + 3, 'a': a.a || 'D', 'r': a.r}},
      {{'c': u.c + (fault = 3)::int + case when fault in (1, 2) or role[1] <> 'a' then 1000000000 else 0 end, 'a': u.a || 'K', 'r': list_append(u.r, role || ':' || text)}},
      {{'c': u.c + 2 + (fault = 3)::int + case when fault in (1, 2) then 1000000000 else 0 end, 'a': u.a || 'R', 'r': list_append(u.r, 'assistant:' || text)}}]) as a
    from dp join r on r.conv_id is not distinct from dp.conv_id and r.i = dp.i + 1))),
best as (select conv_id, list_min([z, a]) as b from (select *, max(i) over (partition by conv_id) as n from dp) where i = n),
found as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate,
    count(*) filter (fault = 3) as truncated, count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal from r group by conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal,
  coalesce(b.c, 0)::bigint as cost, coalesce(b.a, '') as audit, sha256(coalesce(array_to_string(b.r, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o left join found f on f.conv_id is not distinct from o.conv_id left join best t on t.conv_id is not distinct from o.conv_id
""",
}
