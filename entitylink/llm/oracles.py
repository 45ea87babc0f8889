"""Equivalent SQL of the pN_ queries that SQL can express; the others are tested against brute force in tests/llm."""

P2_FOUND = """
with scored as (
  select s1_id, cand_id, blocking_score, blocking_rank from live_match_requests
  where s1_id is not null and cand_id is not null and blocking_score is not null and not isnan(blocking_score)),
best as (select s1_id, cand_id, max(blocking_score) score from scored group by 1, 2),
single as (
  select b.s1_id, b.cand_id, b.score, min(s.blocking_rank) rank
  from best b join scored s on s.s1_id = b.s1_id and s.cand_id = b.cand_id and s.blocking_score = b.score group by 1, 2, 3),
ranked as (
  select *, row_number() over (partition by s1_id order by score desc, rank asc nulls last, cand_id) position from single)
select s1_id, cand_id from ranked where position <= 5
"""

P4_FOUND = """
with recursive lists as (
  select upper(trim(source1_entity_id)) s1, coalesce(matched_entity_ids, '') l from matching_results),
items as (
  select s1, upper(regexp_replace(m, '^\\s+|\\s+$', '', 'g')) m
  from (select s1, unnest(string_split(l, ',')) m from lists)),
edges as (select distinct s1, m from items where m <> ''),
both_ways as (select s1 a, m b from edges union select m, s1 from edges),
vertices as (select s1 v from lists union select m from edges),
reach as (
  select v, v as w from vertices
  union
  select r.v, e.b from reach r join both_ways e on e.a = r.w)
select v as entity_id, min(w) as group_id from reach group by v
"""


def oracle_sql():
    return {"p2_found": P2_FOUND, "p4_found": P4_FOUND}
