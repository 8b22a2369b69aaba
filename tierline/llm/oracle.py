"""DuckDB twins of the queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# exact search
OP1 = """
with v as (select vec_id, cast(embedding as double[]) as e from embeddings),
scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e) as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""

OP3 = f"""
with t as (select doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') as norm from documents)
select doc_id, max(doc_id) over g as keep_id, cast(count(*) over g as bigint) as group_size,
  doc_id = max(doc_id) over g as kept, sha256(norm) as text_sha256
from t window g as (partition by norm)
"""

OP4 = f"""
with rules(rule, host, path, verdict) as (values ('net/', 'net', '/', 'block'),
  ('example.net/en/', 'example.net', '/en/', 'allow'), ('example.com/de/', 'example.com', '/de/', 'block'),
  ('org/fr/', 'org', '/fr/', 'allow')),
p as (select page_id, translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), '{_UPPER}', '{_LOWER}') as host,
  coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') as path from pages),
hits as (select p.page_id, p.host, p.path, r.rule, r.verdict from p left join rules r
  on (p.host = r.host or suffix(p.host, '.' || r.host)) and starts_with(p.path, r.path))
select page_id, host, path, max_by(rule, length(rule)) as rule,
  coalesce(max_by(verdict, length(rule)), 'allow') as verdict
from hits group by page_id, host, path
"""

OP5 = """
with reply as (select conv_id, max(turn) as turn, max_by(text, turn) as text from conversations
  where role = 'assistant' group by conv_id),
following as (select *, lead(text) over (order by conv_id) as bad, lead(conv_id) over (order by conv_id) is not null as other
  from reply),
pairs as (select c.conv_id, r.turn as last, r.text as good, r.bad, coalesce(r.other, false) as other,
    coalesce(r.text = r.bad, false) or r.conv_id is null as same
  from (select distinct conv_id from conversations) c left join following r using (conv_id)),
prompts as (select p.conv_id, count(*) as n,
    string_agg('<|' || c.role || '|>' || chr(10) || c.text || '<|end|>' || chr(10), '' order by c.turn) as prompt
  from pairs p join conversations c on c.conv_id = p.conv_id
    and (p.last is null or c.turn < p.last or (c.turn = p.last and p.same)) group by p.conv_id),
done as (select p.conv_id, coalesce(q.prompt, '') as prompt, coalesce(q.n, 0) as n, same, good, bad, other
  from pairs p left join prompts q using (conv_id))
select conv_id as pair_id, prompt,
  case when same then '' else '<|assistant|>' || chr(10) || good || '<|end|>' || chr(10) end as chosen,
  case when same or not other then '' else '<|assistant|>' || chr(10) || bad || '<|end|>' || chr(10) end as rejected,
  case when same then '' else '14:0,' || (length(good) + 8) || ':1' end as chosen_mask,
  case when same or not other then '' else '14:0,' || (length(bad) + 8) || ':1' end as rejected_mask,
  cast(n as bigint) as prompt_turns, cast(case when same then 0 else 1 end as bigint) as chosen_turns,
  cast(case when same or not other then 0 else 1 end as bigint) as rejected_turns
from done
"""



def crc32(text: str) -> str:
    """DuckDB has no CRC-32: one step per byte, then eight shifts by the reversed polynomial (ASCII only)."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))"
    register = "case when x >= 0 then xor(r, x) else xor(r >> 1, 3988292384 * (r & 1)) end"
    return f"xor(list_reduce(list_prepend(4294967295, cast({steps} as bigint[])), lambda r, x: {register}), 4294967295)"


def hashed(*fields: str) -> str:
    texts = [f"cast({field} as varchar)" for field in fields]
    return "sha256(" + " || ".join(f"coalesce(strlen({text}) || ':' || {text}, '-')" for text in texts) + ")"


def tree(name: str, leaves: str) -> str:
    """Levels of the trees over a relation of tree, place, n, hash: all nodes with their level."""
    return f"""{name} as (select tree, 0 as level, place, n, hash from {leaves} union all
  select tree, any_value(level) + 1, place // 3, (any_value(n) + 2) // 3, sha256(string_agg(hash, '' order by place))
  from {name} where n > 1 group by tree, place // 3)"""


def climb(name: str, start: str, nodes: str) -> str:
    """Steps from (id, tree, level, place, proof, fold) to the root of its tree."""
    return f"""{name} as (select * from {start} union all
  select w.id, w.tree, any_value(w.level) + 1, w.place // 3,
    any_value(w.proof) || coalesce(string_agg(case when t.place <> w.place then t.hash end, '' order by t.place), ''),
    sha256(string_agg(case when t.place = w.place then w.fold else t.hash end, '' order by t.place))
  from {name} w join {nodes} t on t.tree = w.tree and t.level = w.level and t.place // 3 = w.place // 3 and t.n > 1
  group by w.id, w.tree, w.place)"""


OP11 = f"""
with recursive rows as (select *, row_number() over () as id, {hashed("doc_id", "source", "lang", "n_chars", "text")} as leaf,
    case when {crc32("cast(doc_id as varchar)")} % 2 = 0 and doc_id is not null
      then {hashed("doc_id", "source", "lang", "n_chars", "replace(text, chr(10), '')")}
      else {hashed("doc_id", "source", "lang", "n_chars", "text")} end as altered from documents),
leaves as (select *, coalesce('s' || source, '') as tree, leaf as hash, count(*) over (partition by source) as n,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from rows),
{tree("nodes", "leaves")},
subroots as (select tree as of, hash, 0 as tree, count(*) over () as n, row_number() over (order by encode(tree)) - 1 as place
  from nodes where n = 1),
{tree("upper", "subroots")},
starts as (select id, tree, 0 as level, place, '' as proof, altered as fold from leaves),
{climb("walk", "starts", "nodes")},
tops as (select id, any_value(w.tree) as of, max(w.level) as level, max_by(w.proof, w.level) as proof, max_by(w.fold, w.level) as fold
  from walk w group by id),
onward as (select t.id, s.tree, 0 as level, s.place, t.proof, t.fold from tops t join subroots s on s.of = t.of),
{climb("walk2", "onward", "upper")},
ends as (select id, max_by(proof, level) as proof, max_by(fold, level) as fold from walk2 group by id)
select l.doc_id, l.leaf, s.hash as subroot, r.hash as root, sha256(e.proof) as proof_sha256, e.fold as folded_root,
  e.fold = r.hash as verified
from leaves l join ends e using (id) join subroots s on s.of = l.tree cross join (select hash from upper where n = 1) r
"""

# every pair of one label
OP12 = """
with recursive v as (select row_number() over () as id, vec_id, label, cast(embedding as double[]) as e from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs as (select a.id, a.vec_id, b.id as other, b.vec_id as other_id from v a join v b
  on a.label = b.label and a.id <> b.id and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.93),
reach as (select id, id as node from v where id in (select id from pairs)
  union select r.id, p.other from reach r join pairs p on p.id = r.node),
classes as (select r.id, min(v.vec_id) as component_id from reach r join v on v.id = r.node group by r.id),
counts as (select id, count(*) as n_links from pairs group by id),
known as (select v.id, v.vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, v.vec_id) as component_id
  from v left join counts using (id) left join classes using (id)),
none as (select vec_id, 0 as n_links, vec_id as component_id from embeddings
  where not coalesce(vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0, false))
select vec_id, cast(n_links as bigint) as n_links, component_id, vec_id is not distinct from component_id as kept
from (select vec_id, n_links, component_id from known union all select * from none)
"""

# the least (cost, audit) of each state after every turn; up to two inserts precede an edit
OP13 = rf"""
with recursive hit as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    {crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")} % 20 as fate
  from conversations),
rows as (select conv_id, turn, case when fate = 4 then 'user' else role end as role,
    case when fate = 1 then '' when fate = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hit, unnest(range(case fate when 0 then 0 when 3 then 2 else 1 end))),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, encode(role), sha256(text)) as place from rows),
judged as (select *, left(role, 1) as initial, case
    when not regexp_matches(text, '[^ 	-
]') then 1
    when row_number() over (partition by conv_id, role, text order by place) > 1 then 2
    when not regexp_matches(text, '[.!?][ 	-
]*\z') then 3 else 0 end as fault,
  left(role, 1) || lead(left(role, 1)) over (partition by conv_id order by place) as pair from placed),
facts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 1) as blank, count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
    count(*) filter (pair is not null and pair not in ('su', 'ua', 'au')) as illegal, max(place) as n
  from judged group by conv_id),
ahead(q, r, audit, lines) as (values (0, 0, '', ''), (1, 1, '', ''), (2, 2, '', ''), (3, 3, '', ''),
  (0, 2, 'I', 'user:' || chr(10)), (0, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (1, 2, 'I', 'user:' || chr(10)),
  (1, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)), (2, 3, 'I', 'assistant:' || chr(10)),
  (2, 2, 'II', 'assistant:' || chr(10) || 'user:' || chr(10)), (3, 2, 'I', 'user:' || chr(10)),
  (3, 3, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
keeps(q, initial, r) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edits as (select j.conv_id, j.place, q.q, q.q as r, 'D' as letter, 4 as cost, '' as line from judged j, (values (0), (1), (2), (3)) q(q)
  union all select j.conv_id, j.place, k.q, k.r, 'K', case fault when 3 then 3 else 0 end, role || ':' || text || chr(10)
    from judged j join keeps k on k.initial = j.initial where fault not in (1, 2)
  union all select j.conv_id, j.place, d.q, d.r, 'R', 3 + case fault when 3 then 3 else 0 end, d.name || ':' || text || chr(10)
    from judged j, (values (0, 2, 'user'), (1, 2, 'user'), (3, 2, 'user'), (2, 3, 'assistant')) d(q, r, name) where fault not in (1, 2)),
steps as (select e.conv_id, e.place, a.q, e.r, a.audit || e.letter as audit, 3 * length(a.audit) + e.cost as cost, a.lines || e.line as lines
  from ahead a join edits e on e.q = a.r),
paths as (select conv_id, cast(0 as bigint) as place, 0 as q, {{'cost': 0, 'audit': '', 'lines': ''}} as best from facts
  union all select p.conv_id, s.place, s.r, min({{'cost': (p.best).cost + s.cost, 'audit': (p.best).audit || s.audit, 'lines': (p.best).lines || s.lines}})
  from paths p join steps s on s.conv_id is not distinct from p.conv_id and s.place = p.place + 1 and s.q = p.q
  group by p.conv_id, s.place, s.r),
finished as (select p.conv_id, min({{'cost': (best).cost + 3 * length(a.audit), 'audit': (best).audit || a.audit, 'lines': (best).lines || a.lines}}) as best
  from paths p join facts f on f.conv_id is not distinct from p.conv_id and f.n = p.place join ahead a on a.q = p.q and a.r in (0, 3)
  group by p.conv_id)
select c.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
  coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, cast(coalesce((best).cost, 0) as bigint) as cost,
  coalesce((best).audit, '') as audit, sha256(coalesce((best).lines[:-2], '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join facts f on f.conv_id is not distinct from c.conv_id
  left join finished d on d.conv_id is not distinct from c.conv_id
"""

ORACLE: dict[str, str] = {
    "op1_vantage_points": OP1,
    "op3_exact_dedup": OP3,
    "op4_url_filter": OP4,
    "op5_preference_pairs": OP5,
    "op11_merkle_manifest": OP11,
    "op12_multi_index": OP12,
    "op13_turn_repair": OP13,
}
