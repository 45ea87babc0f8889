"""The 36 pair features over joined, record-level prepared columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text
from .similarity import partial_of, partials, ratio_of, ratios, token_set_of, token_sets, token_sort_of, token_sorts

# Names and order of the features.
FEATURES = """
name_ratio name_token_sort_ratio name_token_set_ratio name_partial_ratio name_jaccard name_exact_clean name_len_diff name_domain_match addr_token_set_ratio
addr_jaccard addr_len_diff addr_empty_s1 addr_empty_c both_addr_present num_common num_jaccard num_conflict blocking_score blocking_rank is_s2
name_char_3gram_jaccard name_prefix_match first_word_match name_containment length_ratio addr_ratio addr_num_exact token_count_diff name_legal_stem_exact
name_legal_stem_ratio addr_char_3gram_jaccard postal_code_match first_two_words_match exact_name_and_addr is_latin_disjoint high_name_no_addr
""".split()


#: Record-level columns of a pair, on either side.
SIDE = ("cn", "ca", "w", "cp", "nums", "stem", "postal", "ws", "as", "g", "ga")


def _columns(cn: Column, ca: Column) -> dict[str, Column]:
    return {
        "w": text.words(cn),
        "cp": text.compact(cn),
        "nums": F.array_union(text.numbers(cn), text.numbers(ca)),
        "stem": text.legal_stem(cn),
        "postal": text.postal_codes(ca),
        "ws": F.array_distinct(text.words(cn)),
        "as": F.array_distinct(text.words(ca)),
        "g": text.grams3(cn),
        "ga": text.grams3(ca),
    }


def prepared(records: DataFrame) -> DataFrame:
    """Record-level columns that pair features reuse: computed once a record, not once a pair."""
    return records.withColumns(_columns(F.col("cn"), F.col("ca")))


def prepared_side(df: DataFrame, n: int) -> DataFrame:
    """The same columns of one side of pairs, from its texts: they are many times as long as the texts, so they are not shuffled."""
    return df.withColumns({f"{c}{n}": v for c, v in _columns(F.col(f"cn{n}"), F.col(f"ca{n}")).items()})


def paired(pairs: DataFrame, left: DataFrame, right: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Pairs ``s1_id, cid`` with the prepared columns of both sides, suffixed 1 and 2; pairs of unknown ids drop out."""
    side = lambda df, n, key: df.select(F.col("entity_id").alias(key), *[F.col(c).alias(f"{c}{n}") for c in SIDE])
    return pairs.select("s1_id", "cid", *keep).join(side(left, 1, "s1_id"), "s1_id").join(side(right, 2, "cid"), "cid")


def paired_texts(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """The same for few pairs and many records: only texts are joined, the columns are prepared on the pairs. These are work, not bytes:
    their number of partitions is fixed."""
    side = lambda df, n, key: df.select(F.col("entity_id").alias(key), F.col("cn").alias(f"cn{n}"), F.col("ca").alias(f"ca{n}"))
    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = pairs.join(side(left, 1, "s1_id"), "s1_id").repartition(tasks, "cid").join(side(right, 2, "cid"), "cid")
    return prepared_side(prepared_side(met, 1), 2)


def flag(c: Column) -> Column:
    return F.when(c, 1.0).otherwise(0.0)


def jaccard(a: Column, b: Column) -> Column:
    """Of arrays without repeated items: one intersection, the union is counted from the sizes."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)), F.size(a) + F.size(b) - F.size(F.array_intersect(a, b))), F.lit(0.0))


def _size(c: Column) -> Column:
    return F.size(c).cast("double")


def _both() -> Column:
    return (F.col("ca1") != "") & (F.col("ca2") != "")


def plain_features() -> dict[str, Column]:
    """Features made of built-in expressions only."""
    c = F.col
    t1, t2 = c("ws1"), c("ws2")
    shared = F.array_intersect(c("nums1"), c("nums2"))
    n1, n2 = F.length("cn1"), F.length("cn2")
    return {
        "name_jaccard": jaccard(t1, t2),
        "name_containment": F.when(F.size(t1) > 0, F.size(F.array_intersect(t1, t2)) / F.size(t1)).otherwise(0.0),
        "name_exact_clean": flag((c("cn1") == c("cn2")) & (c("cn1") != "")),
        "name_domain_match": flag((F.length("cp1") >= 4) & (F.length("cp2") >= 4) & (F.contains(c("cp1"), c("cp2")) | F.contains(c("cp2"), c("cp1")))),
        "addr_empty_s1": flag(c("ca1") == ""),
        "addr_empty_c": flag(c("ca2") == ""),
        "both_addr_present": flag(_both()),
        "is_s2": flag(c("cid").startswith("S2-")),
        "name_prefix_match": flag((n1 >= 4) & (n2 >= 4) & (F.substring("cn1", 1, 4) == F.substring("cn2", 1, 4))),
        "first_word_match": flag((F.size("w1") > 0) & (F.size("w2") > 0) & (F.try_element_at(c("w1"), F.lit(1)) == F.try_element_at(c("w2"), F.lit(1)))),
        "first_two_words_match": flag((F.size("w1") >= 2) & (F.size("w2") >= 2) & (F.slice("w1", 1, 2) == F.slice("w2", 1, 2))),
        "exact_name_and_addr": flag((c("cn1") == c("cn2")) & (c("ca1") == c("ca2")) & (c("cn1") != "")),
        "name_len_diff": F.abs(n1 - n2).cast("double"),
        "addr_len_diff": F.when(_both(), F.abs(F.length("ca1") - F.length("ca2"))).otherwise(0).cast("double"),
        "length_ratio": F.when(F.greatest(n1, n2) > 0, F.least(n1, n2) / F.greatest(n1, n2)).otherwise(0.0),
        "token_count_diff": F.abs(F.size("w1") - F.size("w2")).cast("double"),
        "addr_jaccard": F.when(_both(), jaccard(c("as1"), c("as2"))).otherwise(0.0),
        "num_common": _size(shared),
        "num_jaccard": jaccard(c("nums1"), c("nums2")),
        "num_conflict": flag((F.size("nums1") > 0) & (F.size("nums2") > 0) & (F.size(shared) == 0)),
        "addr_num_exact": flag((F.size("nums1") > 0) & (F.size(F.array_except(c("nums1"), c("nums2"))) == 0)),
        "name_legal_stem_exact": flag((c("stem1") != "") & (c("stem1") == c("stem2"))),
        "name_char_3gram_jaccard": jaccard(c("g1"), c("g2")),
        "addr_char_3gram_jaccard": F.when(_both(), jaccard(c("ga1"), c("ga2"))).otherwise(0.0),
        "postal_code_match": F.when(_both() & (F.size("postal1") > 0) & (F.size("postal2") > 0), F.when(F.arrays_overlap("postal1", "postal2"), 1.0).otherwise(-1.0)).otherwise(0.0),
    }


def fuzzy_features() -> dict[str, Column]:
    """Features on the longest common subsequence. Arrow evaluates all of them in one pass over a batch."""
    c = F.col
    return {
        "name_ratio": ratio_of(c("cn1"), c("cn2")),
        "name_token_sort_ratio": token_sort_of(c("cn1"), c("cn2")),
        "name_token_set_ratio": token_set_of(c("cn1"), c("cn2")),
        "name_partial_ratio": partial_of(c("cn1"), c("cn2")),
        "addr_set_raw": token_set_of(c("ca1"), c("ca2")),
        "addr_ratio_raw": ratio_of(c("ca1"), c("ca2")),
        "stem_sort_raw": token_sort_of(c("stem1"), c("stem2")),
    }


#: Names of the same, in the order of ``fuzzy_values``.
FUZZY = ("name_ratio", "name_token_sort_ratio", "name_token_set_ratio", "name_partial_ratio", "addr_set_raw", "addr_ratio_raw", "stem_sort_raw")


def fuzzy_values(cn1: list[str], ca1: list[str], cn2: list[str], ca2: list[str]) -> list:
    """The same of texts that are in a Python task already."""
    legal = set(text.LEGAL_TERMS)
    stems = lambda names: [" ".join(w for w in name.split() if w not in legal) for name in names]
    return [ratios(cn1, cn2), token_sorts(cn1, cn2), token_sets(cn1, cn2), partials(cn1, cn2), token_sets(ca1, ca2), ratios(ca1, ca2), token_sorts(stems(cn1), stems(cn2))]


def with_features(pairs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All features in their order after ``s1_id, cid`` and the kept columns; ``pairs`` comes from ``paired`` and has blocking_score and blocking_rank;
    features on common subsequences that it has are not computed again."""
    c = F.col
    df = pairs if set(FUZZY) <= set(pairs.columns) else pairs.withColumns(fuzzy_features())
    df = df.withColumns(plain_features()).withColumns(
        {
            "addr_token_set_ratio": F.when(_both(), c("addr_set_raw")).otherwise(0.0),
            "addr_ratio": F.when(_both(), c("addr_ratio_raw")).otherwise(0.0),
            "name_legal_stem_ratio": F.when((c("stem1") != "") & (c("stem2") != ""), c("stem_sort_raw")).otherwise(c("name_token_sort_ratio")),
            "blocking_score": c("blocking_score").cast("double"),
            "blocking_rank": c("blocking_rank").cast("double"),
        }
    )
    df = df.withColumns(guards())
    return df.select("s1_id", "cid", *keep, *FEATURES)


def guards() -> dict[str, Column]:
    c = F.col
    latin = c("cn1").rlike("^[\\x00-\\xFF]*$") & c("cn2").rlike("^[\\x00-\\xFF]*$")
    return {
        "is_latin_disjoint": flag(latin & (c("name_token_set_ratio") < 45) & (c("name_domain_match") == 0) & ((c("addr_token_set_ratio") < 75) | (c("num_conflict") > 0))),
        "high_name_no_addr": flag((c("addr_empty_c") == 1) & ((c("name_legal_stem_exact") == 1) | (c("name_token_sort_ratio") >= 85) | (c("name_token_set_ratio") >= 85))),
    }
