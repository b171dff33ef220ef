"""SQL that must give the rows of a query, for the operators that SQL can express."""

from __future__ import annotations

from .chat import BEGIN, BLOCK_TURNS, END, PART_TURNS
from .quality_rules import BOILERPLATE, OTHER_STOPS, STOPS

ORACLES: dict[str, str] = {}

ORACLES["op4_perspective_rotation"] = f"""
with named as (
  select conv_id, turn, regexp_replace(coalesce(role, ''), '[\\r\\n]+', ' ', 'g') as name,
         coalesce(text, '') as body from conversations),
turns as (
  select conv_id, turn, case when name = '' then 'unknown' else name end as speaker, body
  from named),
keyed as (
  select *, md5(speaker || chr(10) || body) as content,
         row_number() over (partition by conv_id, turn, speaker, body) as copy from turns),
dialogues as (
  select *, coalesce('c' || conv_id, 'r' || coalesce(cast(turn as varchar), '') || ' ' || content
                                     || '#' || copy) as dialogue,
         case when turn is null then substr(content, 1, 3) else '' end as sub from keyed),
placed as (
  select *, row_number() over (partition by dialogue
      order by coalesce(floor(turn / {BLOCK_TURNS}), 4611686018427387904), sub,
               turn nulls last, speaker, body) - 1 as position
  from dialogues),
people as (select distinct dialogue, speaker as perspective from dialogues),
seen as (
  select p.dialogue, p.conv_id, q.perspective, cast(floor(position / {PART_TURNS}) as bigint) as part,
         position, speaker = perspective as own,
         '{BEGIN}' || case when speaker = perspective then 'assistant'
                           else 'user name=' || speaker end || chr(10) as head, body
  from placed p join people q using (dialogue)),
segments as (
  select *, head || body || '{END}' || chr(10) as segment from seen),
spans as (
  select *, sum(length(segment)) over (partition by dialogue, perspective, part order by position)
            - length(segment) as since from segments)
select conv_id, perspective, part, cast(count(*) as integer) as n_turns,
       cast(count(*) filter (where own) as integer) as n_trained,
       string_agg(segment, '' order by position) as rendered,
       coalesce(string_agg(cast(since + length(head) as varchar), ',' order by position)
                filter (where own), '') as mask_start,
       coalesce(string_agg(cast(since + length(segment) - 1 as varchar), ',' order by position)
                filter (where own), '') as mask_end
from spans group by dialogue, conv_id, perspective, part
"""

BLANK = "[\\x20\\x09-\\x0D]"
WORDS_OF = f"[x for x in string_split_regex({{0}}, '{BLANK}+') if x <> '']"


def chars(column: str, pattern: str) -> str:
    """Number of characters of a class."""
    return f"(length({column}) - length(regexp_replace({column}, '{pattern}', '', 'g')))"


def quality_sql(documents: str = "documents") -> str:
    """SQL of the quality rules, with the columns of the documents."""
    return f"""
docs as (
  select *, row_number() over () as rid, coalesce(text, '') as body from {documents}),
worded as (select *, {WORDS_OF.format("body")} as ws from docs),
starts as (
  select rid, i, ws[i:i + 7] as gram
  from worded, unnest(generate_series(1, len(ws) - 7)) as u(i) where len(ws) >= 8),
again as (
  select rid, i from (select rid, i, count(*) over (partition by rid, gram) as c from starts)
  where c > 1),
repeats as (
  select rid, count(distinct i + j) as n_repeat_words
  from again, unnest(generate_series(0, 7)) as u(j) group by rid),
lines as (
  select rid, line, {WORDS_OF.format("line")} as ws
  from docs, unnest(string_split(body, chr(10))) as u(line)),
measured as (
  select rid, line, len(ws) as n, len(list_distinct(ws)) as different,
         {chars("line", "[#*$%&|<>]")} as symbols, {chars("line", "[|<>]")} as separators,
         {chars("line", "[A-Z]")} as upper_case, {chars("line", "[a-z]")} as lower_case,
         {chars("line", "[" + STOPS.decode() + OTHER_STOPS + "]")} as stops,
         length(regexp_replace(line, '{BLANK}', '', 'g')) as held,
         regexp_matches(line, '(?i)({"|".join(BOILERPLATE)})') as boilerplate
  from lines where len(ws) > 0),
judged as (
  select *, 10 * symbols > 3 * n or (separators >= 3 and 4 * separators >= n)
            or (upper_case >= 20 and upper_case > 2 * lower_case)
            or (n >= 10 and 10 * different < 3 * n) or (n <= 30 and boilerplate)
            or (n >= 40 and stops = 0) as fails from measured),
by_doc as (
  select rid, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines,
         count(*) filter (where fails) as n_failed_lines,
         coalesce(sum(held) filter (where not fails), 0) as kept_chars
  from judged group by rid),
figures as (
  select w.*, len(ws) as n_words, length(regexp_replace(body, '{BLANK}', '', 'g')) as word_chars,
         {chars("body", "[#*$%&|<>]")} as n_symbols,
         coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
         coalesce(n_lines, 0) as n_lines, coalesce(n_failed_lines, 0) as n_failed_lines,
         coalesce(kept_chars, 0) as kept_chars
  from worded w left join by_doc using (rid) left join repeats using (rid)),
verdicts as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from figures)"""


ORACLES["op7_quality_rules"] = f"""
with {quality_sql()}
select doc_id, cast(n_words as bigint) as n_words, cast(word_chars as bigint) as word_chars,
       cast(n_symbols as bigint) as n_symbols, cast(n_dup_lines as bigint) as n_dup_lines,
       cast(n_repeat_words as bigint) as n_repeat_words, base_failed,
       not base_failed and 2 * kept_chars >= word_chars as kept,
       cast(n_lines as bigint) as n_lines, cast(n_failed_lines as bigint) as n_failed_lines,
       cast(kept_chars as bigint) as kept_chars
from verdicts
"""

#: Components of ``edges`` (a, b) over ``nodes`` (node), by the smallest node in reach.
REACH = """
both_ways as (select a, b from edges union select b, a from edges),
reach as (
  select node, node as other from nodes
  union
  select r.node, e.b from reach r join both_ways e on r.other = e.a),
component as (select node, min(other) as component_id from reach group by node)"""

ORACLES["op5_minhash_near_dedup"] = f"""
with recursive worded as (
  select doc_id, {WORDS_OF.format("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as ws
  from documents),
shingled as (
  select distinct doc_id, case when len(ws) < 5 then ws else ws[i:i + 4] end as s
  from worded, unnest(generate_series(1, greatest(1, len(ws) - 4))) as u(i) where len(ws) > 0),
sizes as (select doc_id, count(*) as n from shingled group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as c
  from shingled x join shingled y on x.s = y.s and x.doc_id < y.doc_id group by all),
edges as (
  select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * c >= 85 * (p.n + q.n - c)),
nodes as (select doc_id as node from documents),{REACH}
select d.doc_id, coalesce(n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d left join sizes s on s.doc_id = d.doc_id join component on node = d.doc_id
"""

ORACLES["op2_embedding_near_dedup"] = f"""
with recursive valid as (
  select vec_id, cast(embedding as double[]) as v from embeddings
  where embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
    and len([x for x in embedding if x <> 0]) > 0),
links as (
  select x.vec_id as a, y.vec_id as b from valid x join valid y
  on x.vec_id <> y.vec_id and len(x.v) = len(y.v)
  where list_cosine_similarity(x.v, y.v) >= 0.9),
edges as (select a, b from links where a < b),
nodes as (select vec_id as node from embeddings),{REACH}
select e.vec_id, coalesce(n, 0) as n_links, component_id, e.vec_id = component_id as kept
from embeddings e left join (select a, count(*) as n from links group by a) on a = e.vec_id
join component on node = e.vec_id
"""

ORACLES["op11_exact_dedup"] = r"""
with contents as (
  select doc_id, length(coalesce(text, '')) as points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content
  from documents),
grouped as (
  select doc_id, content, first_value(doc_id) over best as keep_id,
         row_number() over best as place, count(*) over (partition by content) as group_size
  from contents window best as (partition by content order by points desc, doc_id nulls last))
select doc_id, keep_id, group_size, place = 1 as kept, sha256(content) as text_sha256 from grouped
"""

ORACLES["op12_lexical_search"] = r"""
with numbered as (select row_number() over () as doc, doc_id, text from documents),
lowered as (
  select doc, doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                        as text from numbered where text is not null),
doc_terms as (
  select doc, unnest(regexp_extract_all(text, '[0-9a-z\x{80}-\x{10FFFF}]+')) as term from lowered),
postings as (select doc, term, count(*) as tf from doc_terms group by all),
lengths as (select doc, count(*) as n from doc_terms group by doc),
corpus as (select count(*) as documents, cast(sum(n) as bigint) as terms from lengths),
item_terms as (
  select item, item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[0-9a-z\x{80}-\x{10FFFF}]+')) as term
  from (select row_number() over () as item, * from benchmark)),
wanted as (select item, item_id, term, count(*) as repeats from item_terms group by all),
weights as (
  select term, cast(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1)))
                    as bigint) as weight
  from postings cross join corpus where term in (select term from wanted) group by term),
impacts as (
  select doc, term, weight * ((1000000000 * tf)
           // (1000 * tf + 12 * (75 + (25 * n * documents) // terms))) as impact
  from postings join weights using (term) join lengths using (doc) cross join corpus),
scores as (
  select item, item_id, doc, cast(sum(repeats * impact) as bigint) as score
  from wanted join impacts using (term) group by all having sum(repeats * impact) > 0),
ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank
  from scores join (select doc, doc_id from lowered) using (doc))
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 20
"""
