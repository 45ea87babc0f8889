"""SQL pieces for the equivalent queries: each name is a common table expression with the ones it needs."""

from __future__ import annotations

from ..functions import text

IN = lambda terms: "(" + ", ".join(f"'{t}'" for t in terms) + ")"
STOP, LEGAL = IN(text.STOP_WORDS), IN(text.LEGAL_TERMS)


def leet(x: str) -> str:
    for sign, letter in text.LEET:
        x = f"regexp_replace(regexp_replace({x}, '([a-zA-Z]){sign}', '\\1{letter}', 'g'), '{sign}([a-zA-Z])', '{letter}\\1', 'g')"
    return x


def fold(x: str) -> str:
    """Accents by the database's own function, full-width forms by their distance from ASCII, blanks by their numbers: no table of the engine's is used."""
    narrow = f"array_to_string(list_transform(string_split({x}, ''), lambda ch: case when unicode(ch) between 65281 and 65374 then chr(unicode(ch) - 65248) when unicode(ch) in (160, 8239, 8287, 12288) or unicode(ch) between 8192 and 8202 then ' ' else ch end), '')"
    return f"lower(regexp_replace(strip_accents({narrow}), '[^\\x00-\\x7F]', '', 'g'))"


def domain(x: str) -> str:
    return f"regexp_replace({x}, '\\.({text.DOMAINS})\\b', ' ', 'g')"


def clean(x: str) -> str:
    inner = domain(fold(leet(f"coalesce({x}, '')")))
    return f"trim(regexp_replace(regexp_replace({inner}, '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g'))"


def words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def keep(x: str, terms: str) -> str:
    return f"list_filter({x}, lambda w: w not in {terms})"


def numbers(x: str) -> str:
    return f"list_distinct(list_transform(regexp_extract_all({x}, '\\b(\\d{{1,8}})\\b', 1), lambda n: cast(cast(n as integer) as varchar)))"


def both_numbers(name: str, addr: str) -> str:
    return f"list_distinct(list_concat({numbers(name)}, {numbers(addr)}))"


def postal(x: str) -> str:
    return f"list_distinct(regexp_extract_all({x}, '\\b(\\d{{5,6}})\\b', 1))"


def stem(x: str) -> str:
    return f"coalesce(array_to_string({keep(words(x), LEGAL)}, ' '), '')"


def compact(x: str) -> str:
    return f"replace({x}, ' ', '')"


def grams3(x: str) -> str:
    return f"case when length({x}) = 0 then cast([] as varchar[]) when length({x}) < 3 then [{x}] else list_distinct(list_transform(range(1, length({x}) - 1), lambda i: substring({x}, i, 3))) end"


def selective(x: str) -> str:
    return f"list_filter({keep(words(x), STOP)}, lambda w: length(w) >= 3)"


def tokens(cn: str, ca: str) -> str:
    cp = compact(cn)
    pieces = f"flatten(list_transform(list_filter({words(cn)}, lambda w: length(w) >= 4), lambda w: list_transform(range(1, length(w) - 1), lambda i: substring(w, i, 3))))"
    none = "cast([] as varchar[])"
    every = (
        f"list_concat(list_concat(list_concat(list_concat({keep(words(cn), STOP)}, {keep(words(ca), STOP)}), case when length({cp}) >= 5 then [{cp}, {cp}] else {none} end), "
        f"list_transform({both_numbers(cn, ca)}, lambda n: 'num_' || n)), coalesce({pieces}, {none}))"
    )
    return f"list_filter({every}, lambda t: length(t) >= 2)"


def flag(x: str) -> str:
    return f"case when {x} then 1.0::double else 0.0::double end"


def jaccard(a: str, b: str) -> str:
    n = f"len(list_distinct(list_concat({a}, {b})))"
    return f"case when {n} > 0 then len(list_intersect({a}, {b}))::double / {n} else 0.0::double end"


def ratio_table(name: str, source: str) -> str:
    """A table of all rows of ``source`` with ``r``, the ratio on the longest common subsequence of its columns ``a`` and ``b``. The places of
    each letter in the shorter text are the bits of a 128-bit number; folding the longer text's letters over them leaves a zero bit for each common letter."""
    full = "((1::hugeint << length(x)) - 1)"
    places = "list_transform(string_split(y, ''), lambda ch: list_sum(list_transform(string_split(x, ''), lambda e, i: case when e = ch then (1::hugeint << (i - 1)) else 0::hugeint end)))"
    common = f"case when x = '' then 0 else length(x) - bit_count(list_reduce(list_concat([{full}], {places}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})) end"
    return f"""{name} as (select * exclude (x, y), case when length(x) + length(y) = 0 then 100.0::double else 200.0::double * ({common}) / (length(x) + length(y)) end r
  from (select *, case when length(a) <= length(b) then a else b end x, case when length(a) <= length(b) then b else a end y from ({source})))"""


def sorted_words(x: str) -> str:
    return f"coalesce(array_to_string(list_sort({words(x)}), ' '), '')"


def token_set_table(name: str, x: str, y: str) -> str:
    """``s1_id, cid, r`` by word sets: the best ratio of the shared words and the shared words with the rest of each side."""
    join = lambda *parts: "trim(concat_ws(' ', " + ", ".join(f"nullif(coalesce(array_to_string(list_sort({p}), ' '), ''), '')" for p in parts) + "))"
    sets = f"{name}_sets as (select s1_id, cid, list_distinct({words(x)}) u, list_distinct({words(y)}) v, list_intersect({words(x)}, {words(y)}) both_sides from pairs)"
    rest = f"{name}_rest as (select s1_id, cid, u, v, both_sides, list_filter(u, lambda w: not list_contains(v, w)) only_u, list_filter(v, lambda w: not list_contains(u, w)) only_v from {name}_sets)"
    texts = f"{name}_texts as (select *, {join('both_sides')} base, {join('both_sides', 'only_u')} with_u, {join('both_sides', 'only_v')} with_v from {name}_rest)"
    todo = f"select s1_id, cid, with_u a, with_v b from {name}_texts union all select s1_id, cid, base, with_u from {name}_texts where base <> '' union all select s1_id, cid, base, with_v from {name}_texts where base <> ''"
    return ",\n".join([sets, rest, texts, ratio_table(f"{name}_ratios", todo), f"""{name} as (select t.s1_id, t.cid, case when len(t.u) = 0 or len(t.v) = 0 then 0.0::double
    when len(both_sides) > 0 and (len(only_u) = 0 or len(only_v) = 0) then 100.0::double else m.r end r
  from {name}_texts t join (select s1_id, cid, max(r) r from {name}_ratios group by 1, 2) m on m.s1_id = t.s1_id and m.cid = t.cid)"""])


def partial_table(name: str, x: str, y: str) -> str:
    """``s1_id, cid, r``: the best ratio of the shorter text and any window of its length in the longer, cut off at the ends; both ways if equally long."""
    turned = f"select s1_id, cid, {x} a, {y} b from pairs where length({x}) <= length({y}) union all select s1_id, cid, {y}, {x} from pairs where length({x}) >= length({y})"
    windows = f"""select s1_id, cid, a, substring(b, greatest(k, 0)::bigint + 1, (least(k + length(a), length(b)) - greatest(k, 0))::bigint) b from (select *, unnest(range(1 - length(a), length(b))) k from ({turned}) where a <> '' and not contains(b, a))"""
    return ",\n".join([ratio_table(f"{name}_ratios", f"select distinct * from ({windows})"), f"""{name} as (select p.s1_id, p.cid, case when least(length({x}), length({y})) = 0 then case when {x} = {y} then 100.0::double else 0.0::double end
    when contains({x}, {y}) or contains({y}, {x}) then 100.0::double else m.r end r from pairs p left join (select s1_id, cid, max(r) r from {name}_ratios group by 1, 2) m on m.s1_id = p.s1_id and m.cid = p.cid)"""])


def _source(n: int) -> str:
    return f"""s{n} as (select entity_id, min(coalesce(business_name, '')) business_name, min(coalesce(business_address, '')) business_address, min(trim(country)) country
  from source{n} where entity_id is not null and country is not null group by entity_id)"""


_CHANNEL = """select q.s1_id, c.cid, {score}::double score, {rank}::integer rank from {q} q
  join (select * from (select *, row_number() over (partition by country, key order by cid) turn from {c}) where turn <= {cap}) c on c.country = q.country and c.key = q.key group by all"""

#: name -> (needed names, text)
CTES: dict[str, tuple[list[str], str]] = {
    "s1": ([], _source(1)),
    "s2": ([], _source(2)),
    "s3": ([], _source(3)),
    "q": (["s1"], f"q as materialized (select country, entity_id, {clean('business_name')} cn, {clean('business_address')} ca from s1)"),
    "pool": (["s1", "s2", "s3"], "pool as (select * from s2 where country in (select country from s1) union all select * from s3 where country in (select country from s1))"),
    "c": (["pool"], f"c as materialized (select country, entity_id, {clean('business_name')} cn, {clean('business_address')} ca from pool)"),
    "tfc": (["c"], f"tfc as materialized (select country, entity_id, token, count(*) tf from (select country, entity_id, unnest({tokens('cn', 'ca')}) token from c) group by all)"),
    "tfq": (["q"], f"tfq as materialized (select country, entity_id, token, count(*) tf from (select country, entity_id, unnest({tokens('cn', 'ca')}) token from q) group by all)"),
    "banned": (["tfc", "c"], """banned as materialized (select d.country, d.token from (select country, token, count(*) df from tfc group by all) d
  join (select country, greatest(1, floor(count(*) * 0.03)) most from c group by country) m on m.country = d.country where d.df > m.most)"""),
    "pc": (["banned"], "pc as materialized (select t.* from tfc t anti join banned b on b.country = t.country and b.token = t.token)"),
    "pq": (["banned", "tfq"], "pq as materialized (select t.* from tfq t anti join banned b on b.country = t.country and b.token = t.token)"),
    "cosine": (["pc", "pq"], """cosine as materialized (
  with uc as (select *, tf / sqrt(sum(tf * tf) over (partition by country, entity_id)) u from pc), uq as (select *, tf / sqrt(sum(tf * tf) over (partition by country, entity_id)) u from pq),
  scored as (select q.entity_id s1_id, c.entity_id cid, sum(q.u * c.u) score from uq q join uc c on c.country = q.country and c.token = q.token group by 1, 2 having sum(q.u * c.u) > 0.008),
  ranked as (select *, row_number() over (partition by s1_id order by round(score, 9) desc, cid) rank from scored)
  select s1_id, cid, score, rank::integer rank from ranked where rank <= 25)"""),
    "exact": (["q", "c"], "exact as (with eq as (select country, entity_id s1_id, cn as key from q where cn <> ''), ec as (select country, entity_id cid, cn as key from c where cn <> '') "
              + _CHANNEL.format(score="1.0", rank=0, q="eq", c="ec", cap=50) + ")"),
    "stem": (["q", "c"], f"stem as (with eq as (select country, entity_id s1_id, {stem('cn')} as key from q where length({stem('cn')}) >= 3), "
             f"ec as (select country, entity_id cid, {stem('cn')} as key from c where length({stem('cn')}) >= 3 and {stem('cn')} <> cn) " + _CHANNEL.format(score="0.98", rank=0, q="eq", c="ec", cap=40) + ")"),
    "compacted": (["q", "c"], f"compacted as (with eq as (select country, entity_id s1_id, {compact('cn')} as key from q where length({compact('cn')}) >= 4), "
                  f"ec as (select country, entity_id cid, {compact('cn')} as key from c where length({compact('cn')}) >= 4) " + _CHANNEL.format(score="0.95", rank=0, q="eq", c="ec", cap=40) + ")"),
    "freq": (["c"], f"freq as (select country, word, count(*) freq from (select country, unnest(list_distinct({selective('cn')})) word from c) group by all)"),
    "rare": (["q", "freq"], f"rare as (with eq as (select country, entity_id s1_id, unnest(list_distinct({selective('cn')})) as key from q), "
             f"ec as (select w.country, w.cid, w.key from (select country, entity_id cid, unnest(list_distinct({selective('cn')})) as key from c) w join freq f on f.country = w.country and f.word = w.key where f.freq <= 60) "
             + _CHANNEL.format(score="0.85", rank=1, q="eq", c="ec", cap=25) + ")"),
    "buckets": (["c"], f"""buckets as materialized (
  with a as (select country, entity_id, unnest({numbers('ca')}) num, {selective('ca')}[1:6] ws from c where ca <> ''),
  b as (select country, entity_id, num, unnest(ws) word, generate_subscripts(ws, 1) pos from a where length(num) >= 2),
  r as (select *, row_number() over (partition by country, num, word order by entity_id, pos) turn from b)
  select distinct country, num, word, entity_id cid from r where turn <= 30)"""),
    "anchor": (["q", "buckets"], f"""anchor as (
  with a as (select country, entity_id s1_id, unnest({both_numbers('cn', 'ca')}) num, list_distinct({selective('ca')}[1:8]) ws from q where ca <> ''),
  b as (select country, s1_id, num, unnest(ws) word from a)
  select distinct b.s1_id, k.cid, 0.8::double score, 2::integer rank from b join buckets k on k.country = b.country and k.num = b.num and k.word = b.word)"""),
    "united": (["cosine", "exact", "stem", "compacted", "rare", "anchor"], """united as materialized (
  with every as (select s1_id, cid, 0 prio, 'cosine' channel, score, rank from cosine union all select s1_id, cid, 1, 'exact', score, rank from exact union all select s1_id, cid, 2, 'stem', score, rank from stem
    union all select s1_id, cid, 3, 'compact', score, rank from compacted union all select s1_id, cid, 4, 'rare', score, rank from rare union all select s1_id, cid, 5, 'anchor', score, rank from anchor)
  select s1_id, cid, channel, score, rank from (select *, row_number() over (partition by s1_id, cid order by prio, score, rank) turn from every) where turn = 1)"""),
    "gt": ([], "gt as (select distinct source1_entity_id s1_id, trim(x) cid from (select source1_entity_id, unnest(string_split(coalesce(matched_entity_ids, ''), ',')) x from known_matches) where trim(x) <> '')"),
    "ents": ([], "ents as (select distinct source1_entity_id s1_id from known_matches)"),
    "pred": ([], "pred as (select distinct upper(trim(source1_entity_id)) s1_id, upper(trim(x)) cid from (select source1_entity_id, unnest(string_split(coalesce(matched_entity_ids, ''), ',')) x from matching_results) where trim(x) <> '')"),
    "cands": ([], "cands as (select distinct source1_entity_id s1_id, trim(x) cid from (select source1_entity_id, unnest(string_split(coalesce(candidate_entity_ids, ''), ',')) x from candidate_pairs) where trim(x) <> '')"),
    "probs": ([], "probs as materialized (select s1_id, cand_id cid, max(blocking_score) prob from live_match_requests where blocking_score is not null and not isnan(blocking_score) group by 1, 2)"),
    "counts": (["ents", "gt", "pred"], """counts as materialized (select e.s1_id, coalesce(t.n, 0) truth, coalesce(p.n, 0) pred, coalesce(h.n, 0) tp from ents e
  left join (select s1_id, count(*) n from gt group by 1) t on t.s1_id = e.s1_id left join (select s1_id, count(*) n from pred group by 1) p on p.s1_id = e.s1_id
  left join (select g.s1_id, count(*) n from gt g join pred p on p.s1_id = g.s1_id and p.cid = g.cid group by 1) h on h.s1_id = e.s1_id)"""),
    "pairs": (["q", "c", "cands"], f"""pairs as materialized (
  select p.s1_id, p.cid, a.cn cn1, a.ca ca1, {words('a.cn')} w1, {compact('a.cn')} cp1, {both_numbers('a.cn', 'a.ca')} nums1, {stem('a.cn')} stem1, {postal('a.ca')} postal1,
    b.cn cn2, b.ca ca2, {words('b.cn')} w2, {compact('b.cn')} cp2, {both_numbers('b.cn', 'b.ca')} nums2, {stem('b.cn')} stem2, {postal('b.ca')} postal2
  from cands p join q a on a.entity_id = p.s1_id join c b on b.entity_id = p.cid)"""),
}

F05 = "case when truth = 0 then case when pred = 0 then 1.0::double else 0.0::double end when pred = 0 or tp = 0 then 0.0::double else 1.25 * (tp / pred) * (tp / truth) / (0.25 * (tp / pred) + tp / truth) end"
METRICS = f"""avg({F05}) macro_f05, avg(case when truth > 0 then case when pred > 0 then tp / pred else 0 end end)::double macro_precision,
 avg(case when truth > 0 then tp / truth end)::double macro_recall, coalesce(avg(case when truth = 0 then case when pred = 0 then 1.0 else 0.0 end end), 1.0)::double singleton_accuracy, count(*) entities"""


def query(needs: list[str], body: str) -> str:
    """The body with all needed expressions before it, each once and after what it needs."""
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in done:
            for n in CTES[name][0]:
                add(n)
            done[name] = CTES[name][1]

    for n in needs:
        add(n)
    return ("with " + ",\n".join(done.values()) + "\n" if done else "") + body
