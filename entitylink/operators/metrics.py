"""Evaluation of predicted pairs against ground truth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_entity(entities: DataFrame, truth: DataFrame, predicted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``s1_id, truth, pred, tp`` for every entity ``s1_id``; truth and predicted hold pairs ``s1_id, cid``.

    All counts come from one aggregation over the union of both sides; predictions of unknown entities are left out.
    """
    k = keys or []
    t = truth.select("s1_id", "cid", F.lit(1).alias("t"), F.lit(0).alias("p"))
    p = predicted.select("s1_id", "cid", F.lit(0).alias("t"), F.lit(1).alias("p"))
    pair = t.unionByName(p).groupBy("s1_id", "cid").agg(F.max("t").alias("t"), F.max("p").alias("p"))
    counts = pair.groupBy("s1_id").agg(F.sum("t").alias("truth"), F.sum("p").alias("pred"), F.sum(F.col("t") * F.col("p")).alias("tp"))
    return entities.select("s1_id", *k).join(counts, "s1_id", "left").fillna(0, ["truth", "pred", "tp"])


def f05() -> Column:
    """F with beta one half of one entity: a singleton scores 1 without and 0 with predictions."""
    p, r = F.col("tp") / F.col("pred"), F.col("tp") / F.col("truth")
    return (
        F.when(F.col("truth") == 0, F.when(F.col("pred") == 0, 1.0).otherwise(0.0))
        .when((F.col("pred") == 0) | (F.col("tp") == 0), 0.0)
        .otherwise(1.25 * p * r / (0.25 * p + r))
    )


def macro_f05(counts: DataFrame) -> DataFrame:
    return counts.agg(F.avg(f05()).alias("macro_f05"))


def _metrics() -> list[Column]:
    real = F.col("truth") > 0
    precision = F.when(F.col("pred") > 0, F.col("tp") / F.col("pred")).otherwise(0.0)
    alone = F.avg(F.when(~real, F.when(F.col("pred") == 0, 1.0).otherwise(0.0)))
    return [
        F.avg(f05()).alias("macro_f05"), F.avg(F.when(real, precision)).alias("macro_precision"), F.avg(F.when(real, F.col("tp") / F.col("truth"))).alias("macro_recall"),
        F.coalesce(alone, F.lit(1.0)).alias("singleton_accuracy"), F.count(F.lit(1)).alias("entities"),
    ]


def full_metrics(counts: DataFrame) -> DataFrame:
    """Macro F, precision and recall of entities with matches, accuracy on singletons (1 if there are none)."""
    return counts.agg(*_metrics())


def micro(counts: DataFrame) -> DataFrame:
    """Precision and recall over pairs; predictions of singletons don't count."""
    real = counts.filter("truth > 0")
    return real.agg(F.coalesce(F.try_divide(F.sum("tp"), F.sum("pred")), F.lit(0.0)).alias("micro_precision"), F.coalesce(F.try_divide(F.sum("tp"), F.sum("truth")), F.lit(0.0)).alias("micro_recall"))


def blocking_recall(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Share of true pairs among the candidates, over all pairs and over distinct true ids."""
    hit = truth.join(candidates.select("s1_id", "cid").distinct().withColumn("hit", F.lit(1)), ["s1_id", "cid"], "left")
    return hit.agg(
        F.count(F.lit(1)).alias("pairs"), F.count("hit").alias("hits"), F.try_divide(F.count("hit"), F.count(F.lit(1))).alias("recall_pairs"),
        F.try_divide(F.count("hit"), F.count_distinct("cid")).alias("recall_ids"),
    )


def reduction(candidates: DataFrame, queries: DataFrame, pool: DataFrame) -> DataFrame:
    n = candidates.agg(F.count(F.lit(1)).alias("pairs"))
    q, c = queries.agg(F.count(F.lit(1)).alias("queries")), pool.agg(F.count(F.lit(1)).alias("pool"))
    mean = F.try_divide(F.col("pairs"), F.col("queries"))
    return n.crossJoin(q).crossJoin(c).select(mean.alias("mean_candidates"), (100 * (1 - mean / F.greatest(F.col("pool"), F.lit(1)))).alias("reduction_ratio"))


def key_misses(pairs: DataFrame) -> DataFrame:
    """True pairs ``cn1, cn2`` that share no long word, no word of two letters, no piece of the compact name."""
    from ..functions import text

    w = lambda c, n: F.filter(text.words(F.col(c)), lambda x: F.length(x) >= n)
    miss = lambda a, b: F.count_if(F.size(F.array_intersect(a, b)) == 0)
    g = lambda c: text.grams3(text.compact(F.col(c)))
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), miss(w("cn1", 3), w("cn2", 3)).alias("no_word3"), miss(w("cn1", 2), w("cn2", 2)).alias("no_word2"), miss(g("cn1"), g("cn2")).alias("no_gram3"))


def truth_profile(truth_lists: DataFrame, items: Column) -> DataFrame:
    n = F.size(F.array_distinct(items))
    return truth_lists.agg(F.count(F.lit(1)).alias("entities"), F.count_if(n == 0).alias("singletons"), F.count_if(n > 0).alias("matched"), F.sum(n).cast("bigint").alias("pairs"))


def threshold_table(spark, start: int, stop: int, step: int) -> DataFrame:
    """Thresholds in thousandths."""
    return spark.range(start, stop + 1, step).select((F.col("id") / 1000).alias("threshold"))


def sweep(entities: DataFrame, truth: DataFrame, scored: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Full metrics at every threshold, from one aggregation.

    A pair counts at each threshold up to its score. Pairs of an entity are first counted between two neighbouring thresholds; the
    counts at a threshold are running sums from the top, so no pair is repeated for each threshold.
    """
    marks = thresholds.agg(F.sort_array(F.collect_set("threshold")).alias("marks"))
    t = truth.withColumn("is_true", F.lit(1)).select("s1_id", "cid", "is_true").distinct()
    # the number of thresholds that the score reaches
    hit = scored.select("s1_id", "cid", "prob").join(entities.select("s1_id"), "s1_id", "left_semi").join(t, ["s1_id", "cid"], "left").crossJoin(F.broadcast(marks))
    level = hit.select("s1_id", F.size(F.filter("marks", lambda m: m <= F.col("prob"))).alias("level"), F.coalesce("is_true", F.lit(0)).alias("is_true")).filter("level > 0")
    by = level.groupBy("s1_id", "level").agg(F.count(F.lit(1)).alias("n"), F.sum("is_true").alias("tp"))
    packed = by.groupBy("s1_id").agg(F.collect_list(F.struct("level", "n", "tp")).alias("levels"))
    size = t.groupBy("s1_id").agg(F.count(F.lit(1)).alias("truth"))
    base = entities.select("s1_id").join(size, "s1_id", "left").join(packed, "s1_id", "left").crossJoin(F.broadcast(marks)).select("s1_id", F.coalesce("truth", F.lit(0)).alias("truth"), "levels", F.posexplode("marks").alias("at", "threshold"))
    reached = F.filter(F.coalesce("levels", F.array().cast("array<struct<level:int,n:bigint,tp:bigint>>")), lambda x: x["level"] > F.col("at"))
    add = lambda f: F.aggregate(reached, F.lit(0).cast("bigint"), lambda acc, x: acc + x[f])
    return base.select("threshold", "truth", add("n").alias("pred"), add("tp").alias("tp")).groupBy("threshold").agg(*_metrics())


def best_threshold(swept: DataFrame) -> DataFrame:
    """The row of highest macro F; of equal ones the lowest threshold."""
    return swept.orderBy(F.desc(F.round("macro_f05", 12)), F.asc("threshold")).limit(1)


def refined_threshold(entities: DataFrame, truth: DataFrame, scored: DataFrame) -> DataFrame:
    """The best threshold of three sweeps: 0.30 to 0.95 by 0.05, then 0.10 around the winner by 0.005, then 0.02 around that by 0.001.
    A later sweep wins only by a higher macro F; of equal ones in a sweep the lowest threshold, and 0.5 if all of the first are 0."""
    spark = entities.sparkSession
    best, schema = None, None
    for reach, step, lowest in ((None, 50, 300), (100, 5, 100), (20, 1, 50)):
        at = best and round(best["threshold"] * 1000)
        first, last = (max(lowest, at - reach), min(990, at + reach)) if best else (lowest, 950)
        swept = sweep(entities, truth, scored, threshold_table(spark, first, last, step))
        schema = swept.schema
        score = F.round("macro_f05", 12)
        odd = (score == 0) & (F.col("threshold") != 0.5)
        found = swept.orderBy(F.desc(score), odd, "threshold").first()
        if found is None:
            break
        if best is None or round(found["macro_f05"], 12) > round(best["macro_f05"], 12):
            best = found
    return spark.createDataFrame([best] if best else [], schema)
