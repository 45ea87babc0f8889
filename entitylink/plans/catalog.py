"""Every query by name, beside the SQL that gives the same rows."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import api
from ..functions import features, text, tokens
from ..operators import assemble, candidates, index, metrics, scoring, training, validate
from ..sources import records
from . import sql

_FOUND: dict = {}
_SQL: dict[str, str] = {}


def query(needs: list[str] | None = None, body: str | None = None):
    """Registers a query under its function's name; with SQL if a body is given."""

    def register(f):
        _FOUND[f.__name__] = f
        if body:
            _SQL[f.__name__] = sql.query(needs or [], body)
        return f

    return register


_KEPT: list = []


class World:
    """The tables of a folder, prepared as the operators want them."""

    def __init__(self, spark, d, cut=False):
        self.spark, self.d, self.cut = spark, d, cut
        while _KEPT:  # an earlier query's records; a result of it that is read later computes them again
            _KEPT.pop().unpersist()

    def table(self, name):
        return records.read_table(self.spark, self.d, name)

    def source(self, n):
        return records.source(self.spark, self.d, n)

    @property
    def pool(self):
        s1 = self.source(1)
        return records.of_countries(self.source(2).unionByName(self.source(3)), s1)

    # cleaned records are read by every channel and by the features: kept in memory or on disk until another query's are

    # where they are read in many steps, without their plan: each of these would carry it once for each channel, in the driver and in its log

    def _keep(self, df):
        if self.cut:
            return api.cut(index.cleaned(df.repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")), "entity_id")))
        _KEPT.append(index.cleaned(df).persist())
        return _KEPT[-1]

    @cached_property
    def q(self):
        return self._keep(self.source(1))

    @cached_property
    def c(self):
        return self._keep(self.pool)

    @property
    def truth(self):
        return records.id_list_pairs(self.table("known_matches"), "source1_entity_id", "matched_entity_ids").distinct()

    @property
    def entities(self):
        return self.table("known_matches").select(F.col("source1_entity_id").alias("s1_id")).distinct()

    @property
    def predicted(self):
        p = records.id_list_pairs(self.table("matching_results"), "source1_entity_id", "matched_entity_ids")
        return p.select(F.upper(F.trim("s1_id")).alias("s1_id"), F.upper("cid").alias("cid")).distinct()

    @property
    def listed(self):
        return records.id_list_pairs(self.table("candidate_pairs"), "source1_entity_id", "candidate_entity_ids").distinct()

    @property
    def probs(self):
        live = self.table("live_match_requests").filter(F.col("blocking_score").isNotNull() & ~F.isnan("blocking_score"))
        return live.groupBy("s1_id", F.col("cand_id").alias("cid")).agg(F.max("blocking_score").alias("prob"))

    @property
    def pairs(self):
        return features.paired(self.listed, features.prepared(self.q), features.prepared(self.c))

    @property
    def counts(self):
        return metrics.per_entity(self.entities, self.truth, self.predicted)


# ---- A: scans and sinks

@query(["s1", "s2", "s3"], "select entity_id, business_name, business_address, country, substring(entity_id, 1, 2) source from (select * from s1 union all select * from s2 union all select * from s3)")
def scan_sources(spark, d):
    w = World(spark, d)
    return w.source(1).unionByName(w.source(2)).unionByName(w.source(3)).withColumn("source", F.substring("entity_id", 1, 2))


@query([], """select distinct k.source1_entity_id s1_id, g.cid from known_matches k left join (select distinct source1_entity_id s1_id, trim(x) cid
 from (select source1_entity_id, unnest(string_split(coalesce(matched_entity_ids, ''), ',')) x from known_matches) where trim(x) <> '') g on g.s1_id = k.source1_entity_id""")
def gt_explode(spark, d):
    return records.id_list_pairs(World(spark, d).table("known_matches"), "source1_entity_id", "matched_entity_ids", outer=True).distinct()


@query(["s1"], "select distinct country from s1")
def country_partitions(spark, d):
    return records.countries(World(spark, d).source(1))


@query(["pool"], "select entity_id, business_name, business_address, country from pool")
def country_filtered_sources(spark, d):
    return World(spark, d).pool.select("entity_id", "business_name", "business_address", "country")


@query(["pool", "gt"], """select entity_id, country from pool where entity_id in (select cid from gt)
 union all (select entity_id, country from pool where entity_id not in (select cid from gt) order by entity_id limit 60000)""")
def candidate_pool(spark, d):
    w = World(spark, d)
    return records.candidate_pool(w.pool, w.truth.select(F.col("cid").alias("entity_id")).distinct(), 60_000).select("entity_id", "country")


# ---- B: text

def _all_names(w):
    return w.source(1).unionByName(w.pool)


_NAMES = "(select entity_id, business_name x, business_address y from s1 union all select entity_id, business_name, business_address from pool)"
_CLEAN = "(select entity_id, country, cn, ca from q union all select entity_id, country, cn, ca from c)"


@query(["pool"], f"select entity_id, {sql.leet('x')} as value from {_NAMES}")
def leet_normalize(spark, d):
    return _all_names(World(spark, d)).select("entity_id", text.leet(F.col("business_name")).alias("value"))


@query(["pool"], f"select entity_id, {sql.fold('x')} as value from {_NAMES}")
def strip_accents(spark, d):
    return _all_names(World(spark, d)).select("entity_id", text.ascii_fold(F.col("business_name")).alias("value"))


@query(["pool"], f"select entity_id, {sql.domain(sql.fold('x'))} as value from {_NAMES}")
def domain_strip(spark, d):
    return _all_names(World(spark, d)).select("entity_id", text.strip_domain(text.ascii_fold(F.col("business_name"))).alias("value"))


def _cleaned(w):
    return w.q.unionByName(w.c)


@query(["q", "c"], f"select entity_id, cn, ca from {_CLEAN}")
def clean_text(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", "cn", "ca")


@query(["q", "c"], f"select entity_id, array_to_string(list_sort({sql.both_numbers('cn', 'ca')}), ',') nums from {_CLEAN}")
def extract_numbers(spark, d):
    both = F.array_union(text.numbers(F.col("cn")), text.numbers(F.col("ca")))
    return _cleaned(World(spark, d)).select("entity_id", F.array_join(F.array_sort(both), ",").alias("nums"))


@query(["q", "c"], f"select entity_id, {sql.compact('cn')} cp from {_CLEAN}")
def compact_name(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", text.compact(F.col("cn")).alias("cp"))


@query(["q", "c"], f"select entity_id, {sql.stem('cn')} stem from {_CLEAN}")
def legal_stem(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", text.legal_stem(F.col("cn")).alias("stem"))


@query(["q", "c"], f"select entity_id, array_to_string(list_sort({sql.postal('ca')}), ',') postal from {_CLEAN}")
def postal_codes(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", F.array_join(F.array_sort(text.postal_codes(F.col("ca"))), ",").alias("postal"))


@query(["q", "c"], f"select entity_id, array_to_string(list_sort({sql.grams3('cn')}), ',') grams from {_CLEAN}")
def char_3grams(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", F.array_join(F.array_sort(text.grams3(F.col("cn"))), ",").alias("grams"))


@query(["q", "c"], f"select entity_id, coalesce(array_to_string({sql.keep(sql.words('cn'), sql.STOP)}, ' '), '') kept from {_CLEAN}")
def stopword_filter(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", F.array_join(text.without(text.words(F.col("cn")), text.STOP_WORDS), " ").alias("kept"))


# ---- C, D: tokens and index

@query(["q", "c"], f"select entity_id, array_to_string(list_sort({sql.tokens('cn', 'ca')}), ' ') tokens from {_CLEAN}")
def blocking_tokens(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", F.array_join(F.array_sort(tokens.blocking_tokens(F.col("cn"), F.col("ca"))), " ").alias("tokens"))


@query(["tfc"], "select country, entity_id, token, tf from tfc")
def term_frequency(spark, d):
    return index.term_frequency(World(spark, d).c)


_THREE = lambda c: sql.keep(f"regexp_extract_all({c}, '([a-z0-9]{{3,}})', 1)", sql.STOP)
_INFORMATIVE = (
    f"list_distinct(list_concat(list_concat(list_concat({_THREE('cn')}, {_THREE('ca')}), {sql.both_numbers('cn', 'ca')}), "
    f"case when {sql.compact('cn')} <> '' then [{sql.compact('cn')}] else cast([] as varchar[]) end))"
)


@query(["q", "c"], f"select entity_id, array_to_string(list_sort({_INFORMATIVE}), ' ') tokens from {_CLEAN}")
def informative_tokens(spark, d):
    return _cleaned(World(spark, d)).select("entity_id", F.array_join(F.array_sort(tokens.informative_tokens(F.col("cn"), F.col("ca"))), " ").alias("tokens"))


@query(["tfc"], "select country, token, count(*) df from tfc group by all")
def doc_frequency(spark, d):
    return index.document_frequency(index.term_frequency(World(spark, d).c))


@query(["pc"], "select country, entity_id, token, tf from pc")
def df_pruned_tokens(spark, d):
    c = World(spark, d).c
    tf = index.term_frequency(c)
    return index.pruned(tf, index.banned_tokens(tf, c))


@query(["pc"], "select country, entity_id, round(sqrt(sum(tf * tf)), 6) norm from pc group by all")
def l2_norms(spark, d):
    c = World(spark, d).c
    tf = index.term_frequency(c)
    return index.norms(index.pruned(tf, index.banned_tokens(tf, c))).withColumn("norm", F.round("norm", 6))


@query(["freq"], "select country, word, freq from freq")
def name_word_freq(spark, d):
    return index.word_frequency(World(spark, d).c)


@query(["buckets"], "select country, num, word, cid from buckets")
def addr_anchor_buckets(spark, d):
    return index.anchor_buckets(World(spark, d).c)


# ---- E: candidates

def _scored(df):
    return df.select("s1_id", "cid", F.round("score", 6).alias("score"), "rank")


@query(["cosine"], "select s1_id, cid, round(score, 6) score, rank from cosine")
def cosine_topk(spark, d):
    w = World(spark, d)
    return _scored(candidates.cosine_topk(w.q, w.c))


@query(["exact"], "select s1_id, cid, round(score, 6) score, rank from exact")
def exact_name_join(spark, d):
    w = World(spark, d)
    return _scored(candidates.exact_name(w.q, w.c))


@query(["stem"], "select s1_id, cid, round(score, 6) score, rank from stem")
def legal_stem_join(spark, d):
    w = World(spark, d)
    return _scored(candidates.legal_stem(w.q, w.c))


@query(["compacted"], "select s1_id, cid, round(score, 6) score, rank from compacted")
def compact_name_join(spark, d):
    w = World(spark, d)
    return _scored(candidates.compact_name(w.q, w.c))


@query(["rare"], "select s1_id, cid, round(score, 6) score, rank from rare")
def rare_token_join(spark, d):
    w = World(spark, d)
    return _scored(candidates.rare_token(w.q, w.c))


@query(["anchor"], "select s1_id, cid, round(score, 6) score, rank from anchor")
def addr_anchor_join(spark, d):
    w = World(spark, d)
    return _scored(candidates.address_anchor(w.q, w.c))


@query(["united"], "select s1_id, cid, channel, round(score, 6) score, rank from united")
def candidate_union(spark, d):
    w = World(spark, d)
    return candidates.union_channels(w.q, w.c).withColumn("score", F.round("score", 6))


# ---- F: pair features

def _features(names: list[str]):
    def run(spark, d):
        p = World(spark, d).pairs
        built = features.plain_features()
        return p.select("s1_id", "cid", *[F.round(built[n], 6).alias(n) for n in names])

    return run


def _feature_query(name: str, columns: dict[str, str]) -> None:
    _FOUND[name] = _features(list(columns))
    _SQL[name] = sql.query(["pairs"], "select s1_id, cid, " + ", ".join(f"round({v}, 6) as {k}" for k, v in columns.items()) + " from pairs")


_BOTH = "(ca1 <> '' and ca2 <> '')"
_SHARED = "len(list_intersect(nums1, nums2))"
_feature_query("f_name_jaccard", {"name_jaccard": sql.jaccard("w1", "w2"), "name_containment": "case when len(list_distinct(w1)) > 0 then len(list_intersect(w1, w2))::double / len(list_distinct(w1)) else 0.0::double end"})
_feature_query("f_addr_jaccard", {"addr_jaccard": f"case when {_BOTH} then {sql.jaccard(sql.words('ca1'), sql.words('ca2'))} else 0.0::double end"})
_feature_query("f_flags", {
    "name_exact_clean": sql.flag("cn1 = cn2 and cn1 <> ''"), "name_domain_match": sql.flag("length(cp1) >= 4 and length(cp2) >= 4 and (contains(cp1, cp2) or contains(cp2, cp1))"),
    "addr_empty_s1": sql.flag("ca1 = ''"), "addr_empty_c": sql.flag("ca2 = ''"), "both_addr_present": sql.flag(_BOTH), "is_s2": sql.flag("starts_with(cid, 'S2-')"),
    "name_prefix_match": sql.flag("length(cn1) >= 4 and length(cn2) >= 4 and substring(cn1, 1, 4) = substring(cn2, 1, 4)"), "first_word_match": sql.flag("len(w1) > 0 and len(w2) > 0 and w1[1] = w2[1]"),
    "first_two_words_match": sql.flag("len(w1) >= 2 and len(w2) >= 2 and w1[1:2] = w2[1:2]"), "exact_name_and_addr": sql.flag("cn1 = cn2 and ca1 = ca2 and cn1 <> ''"),
})
_feature_query("f_lengths", {
    "name_len_diff": "abs(length(cn1) - length(cn2))::double", "addr_len_diff": f"case when {_BOTH} then abs(length(ca1) - length(ca2))::double else 0.0::double end",
    "length_ratio": "case when greatest(length(cn1), length(cn2)) > 0 then least(length(cn1), length(cn2))::double / greatest(length(cn1), length(cn2)) else 0.0::double end",
    "token_count_diff": "abs(len(w1) - len(w2))::double",
})
_feature_query("f_numeric", {
    "num_common": f"{_SHARED}::double", "num_jaccard": sql.jaccard("nums1", "nums2"), "num_conflict": sql.flag(f"len(nums1) > 0 and len(nums2) > 0 and {_SHARED} = 0"),
    "addr_num_exact": sql.flag(f"len(nums1) > 0 and {_SHARED} = len(nums1)"),
})
_feature_query("f_3gram", {"name_char_3gram_jaccard": sql.jaccard(sql.grams3("cn1"), sql.grams3("cn2")), "addr_char_3gram_jaccard": f"case when {_BOTH} then {sql.jaccard(sql.grams3('ca1'), sql.grams3('ca2'))} else 0.0::double end"})
_feature_query("f_postal", {"postal_code_match": f"case when {_BOTH} and len(postal1) > 0 and len(postal2) > 0 then case when len(list_intersect(postal1, postal2)) > 0 then 1.0::double else -1.0::double end else 0.0::double end"})


def _fuzzy_features(spark, d):
    p = World(spark, d).pairs.withColumns({"score": F.lit(0.75), "rank": F.lit(1)})
    return features.with_features(p.withColumnsRenamed({"score": "blocking_score", "rank": "blocking_rank"}))


def _after(needs, extra, body):
    """A body with one more expression after the shared ones."""
    return sql.query(needs, "@@").replace("\n@@", ",\n" + extra + "\n" + body)


def _fuzzy_query(name: str, columns: list[str], tables: str, body: str) -> None:
    def run(spark, d):
        return _fuzzy_features(spark, d).select("s1_id", "cid", *[F.round(c, 6).alias(c) for c in columns])

    _FOUND[name] = run
    _SQL[name] = _after(["pairs"], tables, body)


_ratio = lambda name, x, y: sql.ratio_table(name, f"select s1_id, cid, {x} a, {y} b from pairs")
_r = lambda name, column: f"select s1_id, cid, round(r, 6) {column} from {name}"
_both_present = lambda name, column: f"select p.s1_id, p.cid, round(case when {_BOTH} then r else 0.0::double end, 6) {column} from pairs p join {name} t on t.s1_id = p.s1_id and t.cid = p.cid"
_SORT = _ratio("by_sort", sql.sorted_words("cn1"), sql.sorted_words("cn2"))
_STEMS = _ratio("by_stem", sql.sorted_words("stem1"), sql.sorted_words("stem2"))
_SETS, _ADDR_SETS = sql.token_set_table("by_set", "cn1", "cn2"), sql.token_set_table("by_addr_set", "ca1", "ca2")
_DOMAIN_MATCH = "(length(cp1) >= 4 and length(cp2) >= 4 and (contains(cp1, cp2) or contains(cp2, cp1)))"
_fuzzy_query("f_name_ratio", ["name_ratio"], _ratio("plain", "cn1", "cn2"), _r("plain", "name_ratio"))
_fuzzy_query("f_token_sort", ["name_token_sort_ratio"], _SORT, _r("by_sort", "name_token_sort_ratio"))
_fuzzy_query("f_token_set", ["name_token_set_ratio"], _SETS, _r("by_set", "name_token_set_ratio"))
_fuzzy_query("f_partial", ["name_partial_ratio"], sql.partial_table("by_part", "cn1", "cn2"), _r("by_part", "name_partial_ratio"))
_fuzzy_query("f_addr_token_set", ["addr_token_set_ratio"], _ADDR_SETS, _both_present("by_addr_set", "addr_token_set_ratio"))
_fuzzy_query("f_addr_ratio", ["addr_ratio"], _ratio("plain", "ca1", "ca2"), _both_present("plain", "addr_ratio"))
_fuzzy_query(
    "f_legal", ["name_legal_stem_exact", "name_legal_stem_ratio"], _SORT + ",\n" + _STEMS,
    f"""select p.s1_id, p.cid, {sql.flag("stem1 <> '' and stem1 = stem2")} name_legal_stem_exact, round(case when stem1 <> '' and stem2 <> '' then t.r else s.r end, 6) name_legal_stem_ratio
 from pairs p join by_sort s on s.s1_id = p.s1_id and s.cid = p.cid join by_stem t on t.s1_id = p.s1_id and t.cid = p.cid""",
)
_fuzzy_query(
    "f_guards", ["is_latin_disjoint", "high_name_no_addr"], ",\n".join([_SORT, _SETS, _ADDR_SETS]),
    f"""select p.s1_id, p.cid, {sql.flag(f"n.r < 45 and not {_DOMAIN_MATCH} and (case when {_BOTH} then a.r else 0 end < 75 or (len(nums1) > 0 and len(nums2) > 0 and {_SHARED} = 0))")} is_latin_disjoint,
 {sql.flag("ca2 = '' and ((stem1 <> '' and stem1 = stem2) or s.r >= 85 or n.r >= 85)")} high_name_no_addr
 from pairs p join by_sort s on s.s1_id = p.s1_id and s.cid = p.cid join by_set n on n.s1_id = p.s1_id and n.cid = p.cid join by_addr_set a on a.s1_id = p.s1_id and a.cid = p.cid""",
)


@query()
def pair_features(spark, d):
    """All 36 features of the pairs that blocking finds."""
    w = World(spark, d)
    found = candidates.union_channels(w.q, w.c).withColumnsRenamed({"score": "blocking_score", "rank": "blocking_rank"})
    return features.with_features(features.paired(found, features.prepared(w.q), features.prepared(w.c), ("blocking_score", "blocking_rank")))


# ---- G: scoring

_LABELLED = "lab as (select p.s1_id, p.cid, p.prob, case when g.cid is null then 0 else 1 end as label from probs p join ents e on e.s1_id = p.s1_id left join gt g on g.s1_id = p.s1_id and g.cid = p.cid)"


def _labelled(w):
    return training.labelled(w.probs.join(w.entities, "s1_id", "left_semi"), w.truth)


@query()
def class_weights(spark, d):
    return scoring.class_weights(_labelled(World(spark, d)))


_SQL["class_weights"] = _after(["probs", "gt", "ents"], _LABELLED, "select count(*) filter (label = 1) positives, count(*) filter (label = 0) negatives, (count(*) filter (label = 0))::double / nullif(count(*) filter (label = 1), 0)::double weight from lab")


def _tree_sql(tree, node=0):
    if tree["left"][node] < 0:
        return f"{tree['value'][node]}::double"
    return f"case when {tree['feature'][node]} < {tree['value'][node]} then {_tree_sql(tree, tree['left'][node])} else {_tree_sql(tree, tree['right'][node])} end"


def _forest_sql(forest):
    b = forest["base_score"]
    return f"1 / (1 + exp(-(ln({b}::double / (1 - {b}::double)) + {' + '.join(_tree_sql(t) for t in forest['trees'])})))"


@query()
def tree_score(spark, d):
    built = features.plain_features()
    p = World(spark, d).pairs.select("s1_id", "cid", *[built[n].alias(n) for n in ("name_jaccard", "num_jaccard", "addr_jaccard")])
    return p.select("s1_id", "cid", F.round(scoring.forest_probability(scoring.SAMPLE_FOREST), 6).alias("prob"))


_SQL["tree_score"] = _after(
    ["pairs"], f"f as (select s1_id, cid, {sql.jaccard('w1', 'w2')} name_jaccard, {sql.jaccard('nums1', 'nums2')} num_jaccard, case when {_BOTH} then {sql.jaccard(sql.words('ca1'), sql.words('ca2'))} else 0.0::double end addr_jaccard from pairs)",
    f"select s1_id, cid, round({_forest_sql(scoring.SAMPLE_FOREST)}, 6) prob from f",
)


@query()
def roc_auc(spark, d):
    return scoring.roc_auc(_labelled(World(spark, d))).withColumn("auc", F.round("auc", 6))


_SQL["roc_auc"] = _after(
    ["probs", "gt", "ents"], _LABELLED + ",\nranked as (select label, rank() over (order by round(prob, 9)) + (count(*) over (partition by round(prob, 9)) - 1) / 2.0 r from lab)",
    "select round((sum(case when label = 1 then r end) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label)::double * (count(*) - sum(label))), 6)::double auc from ranked",
)


@query()
def model_score(spark, d):
    """The candidates of all source-1 records with the probability of a model trained on the labelled ones."""
    w = World(spark, d, cut=True)
    return scoring.score(api.train_on(w), api.feature_rows(w.q, w.c)).select("s1_id", "cid", F.round("prob", 6).alias("prob"))


@query()
def feature_importance(spark, d):
    return scoring.importances(api.train_on(World(spark, d, cut=True)), spark)


@query()
def run_pipeline(spark, d):
    """Training, blocking, features, scores, threshold, veto and lists: one row for every source-1 record."""
    w = World(spark, d, cut=True)
    return api.match(w.source(1), w.q, w.c, api.train_on(w), 0.56)[0]


# ---- H: assembly

@query(["probs"], "select s1_id, cid, prob from probs where prob >= 0.56")
def threshold_filter(spark, d):
    return assemble.over_threshold(World(spark, d).probs, 0.56)


@query()
def postal_veto(spark, d):
    f = _fuzzy_features(spark, d).withColumn("prob", F.lit(1.0))
    return assemble.postal_veto(f).select("s1_id", "cid")


_SQL["postal_veto"] = _after(
    ["pairs"], _SORT, f"""select p.s1_id, p.cid from pairs p join by_sort s on s.s1_id = p.s1_id and s.cid = p.cid
 where not (not (cn1 = cn2 and cn1 <> '') and {_BOTH} and len(postal1) > 0 and len(postal2) > 0 and len(list_intersect(postal1, postal2)) = 0 and s.r < 90)""",
)


@query(["s1", "probs"], """select s1.entity_id source1_entity_id, coalesce(m.l, '') matched_entity_ids from s1 left join (
 select s1_id, string_agg(cid, ',' order by cid) l from probs where prob >= 0.56 group by s1_id) m on m.s1_id = s1.entity_id""")
def assemble_output(spark, d):
    w = World(spark, d)
    return assemble.lists(w.source(1), assemble.over_threshold(w.probs, 0.56), "matched_entity_ids", [])


@query(["pred", "cands"], "select s1_id, cid from pred anti join cands using (s1_id, cid)")
def subset_check(spark, d):
    w = World(spark, d)
    return assemble.not_contained(w.predicted, w.listed)


# ---- I: metrics

@query(["counts"], f"select round(avg({sql.F05}), 6) macro_f05 from counts")
def macro_f05(spark, d):
    return metrics.macro_f05(World(spark, d).counts).withColumn("macro_f05", F.round("macro_f05", 6))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query(["counts"], f"select round(macro_f05, 6) macro_f05, round(macro_precision, 6) macro_precision, round(macro_recall, 6) macro_recall, round(singleton_accuracy, 6) singleton_accuracy, entities from (select {sql.METRICS} from counts)")
def full_metrics(spark, d):
    return _rounded(metrics.full_metrics(World(spark, d).counts))


@query(["counts"], "select round(coalesce(sum(tp) / nullif(sum(pred), 0), 0), 6)::double micro_precision, round(coalesce(sum(tp) / nullif(sum(truth), 0), 0), 6)::double micro_recall from counts where truth > 0")
def micro_pr(spark, d):
    return _rounded(metrics.micro(World(spark, d).counts))


@query(["gt", "cands"], """select count(*) pairs, count(c.cid) hits, round(count(c.cid) / nullif(count(*), 0), 6)::double recall_pairs, round(count(c.cid) / nullif(count(distinct g.cid), 0), 6)::double recall_ids
 from gt g left join cands c on c.s1_id = g.s1_id and c.cid = g.cid""")
def blocking_recall(spark, d):
    w = World(spark, d)
    return _rounded(metrics.blocking_recall(w.truth, w.listed))


@query(["s1", "pool", "cands"], """select round(p.n / q.n, 6)::double mean_candidates, round(100 * (1 - (p.n / q.n) / greatest(c.n, 1)), 6)::double reduction_ratio
 from (select count(*) n from cands) p, (select count(*) n from s1) q, (select count(*) n from pool) c""")
def reduction_ratio(spark, d):
    w = World(spark, d)
    return _rounded(metrics.reduction(w.listed, w.source(1), w.pool))


_GT_PAIRS = "gtp as (select a.cn cn1, b.cn cn2 from gt g join q a on a.entity_id = g.s1_id join c b on b.entity_id = g.cid)"
_LONG = lambda x, n: f"list_filter({sql.words(x)}, lambda v: length(v) >= {n})"


@query()
def blocking_key_miss(spark, d):
    w = World(spark, d)
    one, two = w.q.select(F.col("entity_id").alias("s1_id"), F.col("cn").alias("cn1")), w.c.select(F.col("entity_id").alias("cid"), F.col("cn").alias("cn2"))
    return metrics.key_misses(w.truth.join(one, "s1_id").join(two, "cid"))


_SQL["blocking_key_miss"] = _after(["gt", "q", "c"], _GT_PAIRS, f"""select count(*) pairs, count(*) filter (len(list_intersect({_LONG('cn1', 3)}, {_LONG('cn2', 3)})) = 0) no_word3,
 count(*) filter (len(list_intersect({_LONG('cn1', 2)}, {_LONG('cn2', 2)})) = 0) no_word2,
 count(*) filter (len(list_intersect({sql.grams3(sql.compact('cn1'))}, {sql.grams3(sql.compact('cn2'))})) = 0) no_gram3 from gtp""")


@query([], """select count(*) entities, count(*) filter (n = 0) singletons, count(*) filter (n > 0) matched, sum(n)::bigint pairs from (
 select len(list_distinct(list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> ''))) n from known_matches)""")
def gt_profile(spark, d):
    return metrics.truth_profile(World(spark, d).table("known_matches"), records.id_items(F.col("matched_entity_ids")))


# ---- J: samples, labels, sweeps

@query(["ents"], "select s1_id, (concat('0x', substring(md5('42:' || s1_id), 1, 8))::bigint / 4294967296.0::double) < 0.05 is_validation from ents")
def train_val_split(spark, d):
    return training.split(World(spark, d).entities)


@query(["ents"], "select s1_id from ents order by s1_id limit 5000 offset (select floor(count(*) * 0.8)::bigint from ents)")
def holdout_slice(spark, d):
    return training.holdout(World(spark, d).entities, 0.8, 5_000)


_LAB_PAIRS = "labp as (select u.s1_id, u.cid, u.rank, case when g.cid is null then 0 else 1 end as label from united u join ents e on e.s1_id = u.s1_id left join gt g on g.s1_id = u.s1_id and g.cid = u.cid)"


def _labelled_candidates(w):
    found = candidates.union_channels(w.q.join(w.entities.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi"), w.c)
    return training.labelled(found.select("s1_id", "cid", "score", "rank"), w.truth)


@query()
def labelled_pairs(spark, d):
    return _labelled_candidates(World(spark, d)).select("s1_id", "cid", "rank", "label")


_SQL["labelled_pairs"] = _after(["united", "gt", "ents"], _LAB_PAIRS, "select s1_id, cid, rank, label from labp")


@query()
def hard_negatives(spark, d):
    return training.hard_negatives(_labelled_candidates(World(spark, d))).select("s1_id", "cid", "rank", "label")


_SQL["hard_negatives"] = _after(["united", "gt", "ents"], _LAB_PAIRS, "select s1_id, cid, rank, label from (select *, row_number() over (partition by s1_id, label order by rank, cid) turn from labp) where label = 1 or turn <= 4")


@query(["united", "gt", "c"], "select s1_id, cid, 0.0::double score, 99 as rank, 1 as label from gt g where not exists (select 1 from united u where u.s1_id = g.s1_id and u.cid = g.cid) and cid in (select entity_id from c)")
def missed_positives(spark, d):
    w = World(spark, d)
    owners = w.truth.select(F.col("s1_id").alias("entity_id")).distinct()  # other records' candidates can't hold a true pair
    return training.missed_positives(w.truth, candidates.union_channels(w.q.join(owners, "entity_id", "left_semi"), w.c), w.c)


@query()
def threshold_sweep(spark, d):
    w = World(spark, d)
    return _rounded(metrics.sweep(w.entities, w.truth, w.probs, metrics.threshold_table(spark, 300, 950, 50)))


_SQL["threshold_sweep"] = _after(
    ["ents", "gt", "probs"], """th as (select unnest(range(300, 951, 50)) / 1000 threshold),
tn as (select s1_id, count(*) n from gt group by 1),
pn as (select t.threshold, p.s1_id, count(*) n, count(g.cid) tp from th t join probs p on p.prob >= t.threshold left join gt g on g.s1_id = p.s1_id and g.cid = p.cid group by 1, 2),
sw as (select t.threshold, coalesce(tn.n, 0) truth, coalesce(pn.n, 0) pred, coalesce(pn.tp, 0) tp from th t cross join ents e left join tn on tn.s1_id = e.s1_id left join pn on pn.s1_id = e.s1_id and pn.threshold = t.threshold)""",
    f"select threshold, round(macro_f05, 6) macro_f05, round(macro_precision, 6) macro_precision, round(macro_recall, 6) macro_recall, round(singleton_accuracy, 6) singleton_accuracy, entities from (select threshold, {sql.METRICS} from sw group by threshold)",
)


@query()
def best_threshold(spark, d):
    w = World(spark, d)
    return _rounded(metrics.best_threshold(metrics.sweep(w.entities, w.truth, w.probs, metrics.threshold_table(spark, 300, 950, 50))))


_SQL["best_threshold"] = f"select * from ({_SQL['threshold_sweep']}) order by macro_f05 desc, threshold limit 1"


@query()
def best_threshold_refined(spark, d):
    """The winner of the coarse sweep and two finer ones around it."""
    w = World(spark, d)
    return _rounded(metrics.refined_threshold(w.entities, w.truth, w.probs))


def _phase_sql(k: int, thresholds: str) -> str:
    first = f"select {k} phase, * from m{k}"
    return f"""th{k} as ({thresholds}),
pn{k} as (select t.t, p.s1_id, count(*) n, count(g.cid) tp from th{k} t join probs p on p.prob >= t.t / 1000 left join gt g on g.s1_id = p.s1_id and g.cid = p.cid group by 1, 2),
m{k} as (select t, {sql.METRICS} from (select t.t, coalesce(tn.n, 0) truth, coalesce(pn.n, 0) pred, coalesce(pn.tp, 0) tp from th{k} t cross join ents e left join tn on tn.s1_id = e.s1_id left join pn{k} pn on pn.s1_id = e.s1_id and pn.t = t.t) group by t),
w{k} as (select * from ({first if k == 1 else f"select * from w{k - 1} union all {first}"}) order by round(macro_f05, 12) desc, phase, {"(round(macro_f05, 12) = 0 and t <> 500), " if k == 1 else ""}t limit 1)"""


_SQL["best_threshold_refined"] = _after(
    ["ents", "gt", "probs"], "tn as (select s1_id, count(*) n from gt group by 1),\n" + ",\n".join([
        _phase_sql(1, "select unnest(range(300, 951, 50)) t"), _phase_sql(2, "select unnest(range(greatest(100, t - 100), least(990, t + 100) + 1, 5)) t from w1"),
        _phase_sql(3, "select unnest(range(greatest(50, t - 20), least(990, t + 20) + 1, 1)) t from w2"),
    ]),
    "select t / 1000 threshold, round(macro_f05, 6) macro_f05, round(macro_precision, 6) macro_precision, round(macro_recall, 6) macro_recall, round(singleton_accuracy, 6) singleton_accuracy, entities from w3",
)


# ---- K: validation

_RESULT = ("source1_entity_id", "matched_entity_ids")
_RAW_ITEMS = "items as (select source1_entity_id s1_id, trim(x) cid from (select source1_entity_id, unnest(string_split(coalesce(matched_entity_ids, ''), ',')) x from matching_results) where trim(x) <> '')"


@query([], "select text as value from documents where text is not null and trim(text) <> '' and not contains(text, chr(9))")
def v_malformed(spark, d):
    return validate.malformed(World(spark, d).table("documents").select(F.col("text").alias("value")))


@query([], "select source1_entity_id s1_id, count(*) n from matching_results group by 1 having count(*) > 1")
def v_dup_rows(spark, d):
    return validate.duplicate_rows(World(spark, d).table("matching_results"), _RESULT[0])


@query([], """select s1_id, (len(l) - len(list_distinct(l)))::integer extra from (select source1_entity_id s1_id, list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> '') l from matching_results)
 where len(l) > len(list_distinct(l))""")
def v_intra_dup(spark, d):
    return validate.repeated_items(World(spark, d).table("matching_results"), *_RESULT)


@query()
def v_prefix(spark, d):
    return validate.bad_prefix(World(spark, d).table("matching_results"), *_RESULT)


_SQL["v_prefix"] = f"with {_RAW_ITEMS} select distinct s1_id, cid, case when starts_with(cid, 'S1-') then 'self_match' else 'bad_prefix' end as rule from items where starts_with(cid, 'S1-') or not (starts_with(cid, 'S2-') or starts_with(cid, 'S3-'))"


@query()
def v_unknown(spark, d):
    w = World(spark, d)
    return validate.unknown_ids(w.table("matching_results"), *_RESULT, w.table("source2").unionByName(w.table("source3")))


_SQL["v_unknown"] = f"with {_RAW_ITEMS} select distinct cid from items where cid not in (select entity_id from source2 union select entity_id from source3)"


@query([], "select distinct entity_id s1_id from source1 where entity_id not in (select source1_entity_id from matching_results where source1_entity_id is not null)")
def v_missing(spark, d):
    w = World(spark, d)
    return validate.missing(w.table("matching_results"), _RESULT[0], w.table("source1"))


@query([], "select distinct source1_entity_id s1_id from matching_results where source1_entity_id not in (select entity_id from source1)")
def v_extra(spark, d):
    w = World(spark, d)
    return validate.unexpected(w.table("matching_results"), _RESULT[0], w.table("source1"))


@query()
def v_report(spark, d):
    w = World(spark, d)
    return validate.report(w.table("matching_results"), *_RESULT, w.table("source1"), w.table("source2").unionByName(w.table("source3")), listed=w.listed)


_NOT_LISTED = "select distinct i.s1_id, i.cid from items i anti join cands c on c.s1_id = i.s1_id and c.cid = i.cid"
_SQL["v_report"] = f"""with {_RAW_ITEMS}, {sql.CTES["cands"][1]},
every as (
 select distinct case when starts_with(cid, 'S1-') then 'self_match' else 'bad_prefix' end as rule, cid id from items where starts_with(cid, 'S1-') or not (starts_with(cid, 'S2-') or starts_with(cid, 'S3-'))
 union all select 'duplicate_row', s1_id from ({_SQL['v_dup_rows']}) union all select distinct 'repeated_item', s1_id from ({_SQL['v_intra_dup']})
 union all select 'missing', s1_id from ({_SQL['v_missing']}) union all select 'unexpected', s1_id from ({_SQL['v_extra']})
 union all select 'unknown', cid from (select distinct cid from items where cid not in (select entity_id from source2 union select entity_id from source3))
 union all select 'match_not_candidate', s1_id || ':' || cid from ({_NOT_LISTED}))
select rule, case when rule = 'match_not_candidate' then 'warning' else 'error' end severity, count(*) n, array_to_string(list_sort(list(id))[1:5], ',') examples from every group by rule"""


@query()
def v_warnings(spark, d):
    w = World(spark, d)
    return validate.not_candidates(w.table("matching_results"), *_RESULT, w.listed)


_SQL["v_warnings"] = f"with {_RAW_ITEMS}, {sql.CTES['cands'][1]} {_NOT_LISTED}"


@query([], """select count(*) as rows, count(*) filter (n = 0) empty_lists, coalesce(sum(n), 0)::bigint ids from (
 select len(list_filter(list_transform(string_split(coalesce(matched_entity_ids, ''), ','), lambda x: trim(x)), lambda x: x <> '')) n from matching_results)""")
def v_counters(spark, d):
    return validate.counters(World(spark, d).table("matching_results"), _RESULT[1])


# ---- L: functions behind the serving surface

@query(["s1"], "select s.country, count(*) total, count(m.id) done from s1 s left join (select distinct source1_entity_id id from matching_results) m on m.id = s.entity_id group by s.country")
def status(spark, d):
    w = World(spark, d)
    return api.status(w.source(1), w.table("matching_results"))


@query(["pred", "cands"], """select p.s1_id, p.matches, coalesce(c.candidates, '') candidates from (select s1_id, string_agg(cid, ',' order by cid) matches from pred group by 1 order by 1 limit 20) p
 left join (select s1_id, string_agg(cid, ',' order by cid) candidates from cands group by 1) c on c.s1_id = p.s1_id""")
def sample_matches(spark, d):
    w = World(spark, d)
    return api.sample_matches(w.predicted, w.listed, 20)


@query()
def match_examples(spark, d):
    """Features of the preset pairs."""
    return api.match_live(spark, api.EXAMPLES)


def queries():
    return dict(_FOUND)


def oracle_sql():
    return dict(_SQL)


__all__ = ["oracle_sql", "queries"]
