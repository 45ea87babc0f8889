"""Entry points: train, match, evaluate, live pairs, progress and samples."""

from __future__ import annotations

import hashlib
import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import features, text
from .operators import assemble, candidates, index, metrics, scoring, training
from .sources import records

# Preset pairs of the live surface: title, then name and address of both sides.
EXAMPLES = [
    ("typos", "Corner P1lates & Y0ga Stud1o LLC", "450 7th Ave Ste 1200, New York, NY 10123", "Corner Pilates and Yoga Studio", "450 7th Avenue, Suite 1200, NY"),
    ("landmark", "Balaji Electronics & Telecom Pvt Ltd", "Opp. SBI ATM, Main Market, MG Road, Bangalore 560001", "Balaji Electronics Private Limited", "Shop No 14, MG Rd near State Bank, Bangalore, Karnataka 560001"),
    ("accents", "Boulangerie Pâtisserie de l'Étoile SARL", "18 Avenue des Champs-Élysées, 75008 Paris", "Boulangerie Patisserie l Etoile", "18 Av des Champs Elysees Paris 75008"),
    ("other unit", "Apex Logistics Services Corp", "100 Industrial Parkway Unit 4B, Chicago, IL 60601", "Apex Logistics Services Inc", "100 Industrial Parkway Unit 9C, Chicago, IL 60601"),
]


def feature_rows(queries: DataFrame, pool: DataFrame, k: int = 25, min_score: float = 0.008) -> DataFrame:
    """Blocking and features of cleaned records: ``s1_id, cid`` and the 36 features."""
    found = features.prepared_side(candidates.union_with_texts(queries, pool, k, min_score), 1)
    pairs = features.prepared_side(found.select(*[c for c in found.columns if c != "others"], F.inline("others")), 2)
    return features.with_features(pairs.withColumnsRenamed({"score": "blocking_score", "rank": "blocking_rank"}))


class Inputs:
    """What training and evaluation read: cleaned source-1 records ``q``, cleaned candidates ``c``, true pairs and labelled entities."""

    def __init__(self, s1: DataFrame, others: DataFrame, truth_lists: DataFrame, owner: str = "source1_entity_id", items: str = "matched_entity_ids"):
        self.q, self.c = index.cleaned(s1), index.cleaned(records.of_countries(others, s1))
        self.truth = records.id_list_pairs(truth_lists, owner, items).distinct()
        self.entities = truth_lists.select(F.col(owner).alias("s1_id")).distinct()


#: Training rows of one partition.
TRAINING_PARTITION = 50_000


def training_rows(world, kept: list[DataFrame] | None = None) -> DataFrame:
    """Labelled feature rows: the labelled entities' candidates with at most four negatives each, beside the true pairs blocking missed.
    Their number is bounded by the labels, not by the sources. The candidates are read twice; with a list ``kept`` they are persisted
    and added to it, for the caller to release."""
    labelled_ids = world.entities.select(F.col("s1_id").alias("entity_id"))
    queries, pool = world.q.join(labelled_ids, "entity_id", "left_semi"), world.c
    found = candidates.union_channels(queries, pool).select("s1_id", "cid", "score", "rank")
    if kept is not None:
        kept.append(found.persist())
    chosen = training.hard_negatives(training.labelled(found, world.truth)).unionByName(training.missed_positives(world.truth, found, pool))
    chosen = chosen.withColumnsRenamed({"score": "blocking_score", "rank": "blocking_rank"})
    return features.with_features(features.paired_texts(chosen, queries, pool), ("label",))


def feature_table(rows: DataFrame, folder: str, settings: dict) -> DataFrame:
    """The rows as a table below ``folder``, named by a digest of the settings they were made with: made once, read by later trainings.
    Other settings never find it."""
    spark = rows.sparkSession
    path = f"{folder}/features-{hashlib.sha256(json.dumps(settings, sort_keys=True).encode()).hexdigest()[:16]}"
    if not exists(spark, f"{path}/_SUCCESS"):
        rows.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def cut(df: DataFrame) -> DataFrame:
    """The rows without the plan that made them: every step of a training would carry it, as a tree in the driver and as text in the event
    log. They lie in the checkpoint folder; where none is set, with the executors."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df.localCheckpoint()


def train_on(world, params: dict | None = None, rows: DataFrame | None = None) -> PipelineModel:
    """A model trained on the labelled entities with the trainer's defaults. A fifth of the entities stop it early; if a side of
    the split is empty, it trains all rounds on all rows."""
    kept: list[DataFrame] = []
    if rows is None:
        rows = cut(training_rows(world, kept))
    try:
        # every split of every tree is a job: few rows in many partitions would be nothing but tasks
        sided = rows.join(training.split(world.entities, 0.2), "s1_id").repartition(rows.count() // TRAINING_PARTITION + 1)
        both = sided.select("is_validation").distinct().count() == 2
        return scoring.train(sided, params, "is_validation" if both else None)
    finally:
        for df in kept:
            df.unpersist()


def match(s1: DataFrame, queries: DataFrame, pool: DataFrame, model: PipelineModel, threshold: float, k: int = 25, veto: bool = True) -> tuple[DataFrame, DataFrame]:
    """Result lists and candidate lists of every source-1 record, from cleaned records."""
    rows = feature_rows(queries, pool, k)
    scored = assemble.over_threshold(scoring.score(model, rows), threshold)
    if veto:
        scored = assemble.postal_veto(scored)
    matches = assemble.lists(s1, scored, "matched_entity_ids", [])
    return matches, assemble.lists(s1, rows, "candidate_entity_ids", ["blocking_rank"])


def run(s1: DataFrame, others: DataFrame, model: PipelineModel, threshold: float, k: int = 25, veto: bool = True) -> tuple[DataFrame, DataFrame]:
    """Result lists and candidate lists of every source-1 record."""
    return match(s1, index.cleaned(s1), index.cleaned(records.of_countries(others, s1)), model, threshold, k, veto)


# Bounds of the number of entities of a benchmark.
BENCHMARK_ENTITIES = (100, 5000)


def run_benchmark(world, model: PipelineModel, threshold: float, n: int = 2000) -> DataFrame:
    """Full metrics on ``n`` held-out labelled entities, ``n`` kept within its bounds; those after the first four fifths in the order of ids."""
    low, high = BENCHMARK_ENTITIES
    held = training.holdout(world.entities, 0.8, max(low, min(high, n)))
    queries = world.q.join(held.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi")
    return evaluate(held, world.truth.join(held, "s1_id", "left_semi"), scoring.score(model, feature_rows(queries, world.c)), threshold)


def stats(path: str, spark: SparkSession, n: int = 10) -> dict:
    """Importances of a stored model's features, and the metrics, threshold and parameters stored with it."""
    model, settings = scoring.load(path)
    return {"features": [(r.feature, r.importance) for r in scoring.importances(model, spark, n).collect()], **settings}


def evaluate(entities: DataFrame, truth: DataFrame, scored: DataFrame, threshold: float) -> DataFrame:
    """Full metrics of scored pairs at a threshold."""
    return metrics.full_metrics(metrics.per_entity(entities, truth, assemble.over_threshold(scored, threshold).join(entities.select("s1_id"), "s1_id", "left_semi")))


def tune(rows: DataFrame, grid: list[dict], entities: DataFrame, truth: DataFrame) -> tuple[dict, float]:
    """The parameters of highest macro F on the validation entities. A grid of trainings, each distributed by itself."""
    sides = training.split(entities, 0.2)
    valid = sides.filter("is_validation").select("s1_id")
    best = ({}, -1.0)
    for params in grid:
        model = scoring.train(rows.join(valid, "s1_id", "left_anti"), params)
        found = metrics.refined_threshold(valid, truth.join(valid, "s1_id", "left_semi"), scoring.score(model, rows.join(valid, "s1_id", "left_semi"))).first()
        if found is not None and found["macro_f05"] > best[1]:
            best = (params, found["macro_f05"])
    return best


def match_live(spark: SparkSession, pairs: list[tuple], model: PipelineModel | None = None) -> DataFrame:
    """Features, and with a model the probability, of ad-hoc pairs (title, name, address, name, address)."""
    df = spark.createDataFrame(pairs, "title string, n1 string, a1 string, n2 string, a2 string")
    side = lambda n: df.select(F.concat("title", F.lit(f"#{n}")).alias("entity_id"), text.clean(F.col(f"n{n}")).alias("cn"), text.clean(F.col(f"a{n}")).alias("ca"))
    keys = df.select(F.concat("title", F.lit("#1")).alias("s1_id"), F.concat("title", F.lit("#2")).alias("cid"), F.lit(0.75).alias("blocking_score"), F.lit(1).alias("blocking_rank"))
    rows = features.with_features(features.paired(keys, features.prepared(side(1)), features.prepared(side(2)), ("blocking_score", "blocking_rank")))
    return scoring.score(model, rows) if model else rows


def status(s1: DataFrame, results: DataFrame) -> DataFrame:
    """``country, total, done``: source-1 records and those with a result row."""
    done = results.select(F.col("source1_entity_id").alias("entity_id")).distinct().withColumn("hit", F.lit(1))
    return s1.join(done, "entity_id", "left").groupBy("country").agg(F.count(F.lit(1)).alias("total"), F.count("hit").alias("done"))


def sample_matches(matches: DataFrame, listed: DataFrame, n: int) -> DataFrame:
    """The first ``n`` entities with matches, with both lists."""
    join = lambda df, name: df.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("cid")), ",").alias(name))
    first = matches.select("s1_id").distinct().orderBy("s1_id").limit(n)
    return (
        join(matches.join(F.broadcast(first), "s1_id", "left_semi"), "matches")
        .join(join(listed.join(F.broadcast(first), "s1_id", "left_semi"), "candidates"), "s1_id", "left").withColumn("candidates", F.coalesce("candidates", F.lit("")))
    )
