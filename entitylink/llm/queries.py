"""The pN_ queries: each applies an operator with production parameters to its whole tables."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from .addresses import same_location
from .components import match_groups
from .establishments import LEAST_CONFIDENCE, RULES, same_establishment
from .encode import encode_documents
from .lookalike import same_to_the_eye
from .mixing import mixture, shares
from .shared import Stage, ship, table
from .topn import best_candidates
from .truncation import truncated, truncation_rates
from .variants import same_organisation


def p1_found(spark, d):
    return same_organisation(table(spark, d, "live_match_requests"), Stage(spark, "p1"))


def p2_found(spark, d):
    return best_candidates(table(spark, d, "live_match_requests")).select("s1_id", "cand_id")


def p3_found(spark, d):
    return same_location(table(spark, d, "live_match_requests"), Stage(spark, "p3"))


def p4_found(spark, d):
    return match_groups(table(spark, d, "matching_results"), Stage(spark, "p4"))


def _p5(spark, d):
    return same_establishment(table(spark, d, "live_match_requests"), table(spark, d, "known_matches"), Stage(spark, "p5"))


def p5_found(spark, d):
    return _p5(spark, d).filter(F.col("confidence") >= LEAST_CONFIDENCE).select("s1_id", "cand_id")


def p5_rules(spark, d):
    """Pairs and confidence of each rule."""
    names = F.array(*[F.lit(r[0]) for r in RULES])
    return _p5(spark, d).groupBy("rule").agg(F.count(F.lit(1)).alias("pairs"), F.max("confidence").alias("confidence")).withColumn("rule", F.get(names, F.col("rule")))


def p6_found(spark, d):
    return same_to_the_eye(table(spark, d, "live_match_requests").select("s1_id", "s1_name", "s1_addr", "cand_id", "cand_name", "cand_addr"), Stage(spark, "p6"))


def p7_ids(spark, d):
    return encode_documents(table(spark, d, "documents"))


def p8_mix(spark, d):
    return mixture(table(spark, d, "documents"), table(spark, d, "mix_targets"), Stage(spark, "p8"))


def p8_shares(spark, d):
    stage = Stage(spark, "p8")
    targets = table(spark, d, "mix_targets")
    return shares(stage.put("mix", mixture(table(spark, d, "documents"), targets, stage)), targets)


def p9_found(spark, d):
    return truncated(table(spark, d, "documents"), Stage(spark, "p9")).select("doc_id")


def p9_rates(spark, d):
    return truncation_rates(table(spark, d, "documents"), Stage(spark, "p9"))


def _shipped(query):
    @wraps(query)
    def run(spark, d):
        ship(spark)
        return query(spark, d)

    return run


def queries():
    found = [p1_found, p2_found, p3_found, p4_found, p5_found, p5_rules, p6_found, p7_ids, p8_mix, p8_shares, p9_found, p9_rates]
    return {q.__name__: _shipped(q) for q in found}
