"""Command line: ``python -m entitylink train | match | evaluate | validate``, from tab-separated files to tab-separated files."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import api
from .operators import metrics, scoring, training, validate
from .sources import records


def _arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="entitylink", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, about: str, *needs: str) -> argparse.ArgumentParser:
        c = commands.add_parser(name, help=about)
        c.add_argument("--s1", required=True, help="records of source 1")
        c.add_argument("--others", required=True, nargs="+", help="records of the other sources")
        for n in needs:
            c.add_argument(f"--{n}", required=True)
        return c

    c = command("train", "train on labelled entities and store the model", "truth", "model")
    c.add_argument("--params", type=json.loads, default={}, help="trainer parameters as JSON, over the defaults")
    c.add_argument("--features", help="folder for the feature table, made once for the same files")
    c = command("match", "match all records of source 1", "model", "out")
    c.add_argument("--threshold", type=float, help="instead of the stored one")
    c.add_argument("--k", type=int, default=25)
    c = command("evaluate", "metrics on held-out labelled entities", "truth", "model")
    c.add_argument("--n", type=int, default=2000)
    c = command("validate", "check a result file", "matches")
    c.add_argument("--candidates")
    c.add_argument("--check-ids", action="store_true")
    return top


def _records(spark: SparkSession, *paths: str) -> DataFrame:
    df = records.read_tsv(spark, list(paths)).filter("entity_id is not null and country is not null")
    text = [F.coalesce(c, F.lit("")).alias(c) for c in ("business_name", "business_address")]
    return df.select("entity_id", *text, F.trim("country").alias("country")).groupBy("entity_id").agg(*[F.min(c).alias(c) for c in ("business_name", "business_address", "country")])


def _lists(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in validate.HEADERS[kind]])).csv(path, sep="\t", header=True, quote="", escape="")


def train(spark: SparkSession, a) -> int:
    """Trains, tunes the threshold on the validation entities, and stores the model with threshold, parameters and metrics."""
    world = api.Inputs(_records(spark, a.s1), _records(spark, *a.others), _lists(spark, a.truth, "matching"))
    kept: list[DataFrame] = []
    rows = api.training_rows(world, kept)
    if a.features:
        rows = api.feature_table(rows, a.features, {"s1": a.s1, "others": a.others, "truth": a.truth})
    kept.append(rows.persist())
    model = api.train_on(world, a.params, rows)
    valid = training.split(world.entities, 0.2).filter("is_validation").select("s1_id")
    valid = world.entities if valid.isEmpty() else valid
    kept.append(scoring.score(model, rows.join(valid, "s1_id", "left_semi")).persist())
    found = metrics.refined_threshold(valid, world.truth.join(valid, "s1_id", "left_semi"), kept[-1]).first()
    scores = found.asDict() if found else {"threshold": 0.5}
    scoring.save(model, a.model, {"threshold": scores.pop("threshold"), "parameters": scoring.DEFAULTS | a.params, "metrics": scores})
    for df in kept:
        df.unpersist()
    return 0


def match(spark: SparkSession, a) -> int:
    model, settings = scoring.load(a.model)
    threshold = settings["threshold"] if a.threshold is None else a.threshold
    matches, listed = api.run(_records(spark, a.s1), _records(spark, *a.others), model, threshold, a.k)
    records.write_lists(matches, f"{a.out}/matching_results")
    records.write_lists(listed, f"{a.out}/candidate_pairs")
    return 0


def evaluate(spark: SparkSession, a) -> int:
    model, settings = scoring.load(a.model)
    world = api.Inputs(_records(spark, a.s1), _records(spark, *a.others), _lists(spark, a.truth, "matching"))
    print(json.dumps(api.run_benchmark(world, model, settings["threshold"], a.n).first().asDict()))
    return 0


def check(spark: SparkSession, a) -> int:
    """Prints what is wrong with the files; 1 if anything is an error."""
    wrong = False
    for kind, path in (("matching", a.matches), ("candidate", a.candidates)):
        if not path:
            continue
        messages = validate.check_header(next((r.value for r in spark.read.text(path).limit(1).collect()), None), kind) if api.exists(spark, path) else ["file does not exist"]
        for m in messages:
            print(f"error\t{path}\t{m}")
        wrong = wrong or bool(messages)
    if wrong:
        return 1
    owner, items = validate.HEADERS["matching"]
    df = _lists(spark, a.matches, "matching")
    listed = records.id_list_pairs(_lists(spark, a.candidates, "candidate"), *validate.HEADERS["candidate"]).distinct() if a.candidates else None
    found = validate.report(df, owner, items, _records(spark, a.s1), _records(spark, *a.others), listed=listed, lines=spark.read.text(a.matches))
    found = (found if a.check_ids else found.filter("rule <> 'unknown'")).persist()
    for r in found.orderBy("rule").collect():
        print(f"{r.severity}\t{r.rule}\t{r.n}\t{r.examples}")
    print("rows, empty lists, ids:", *validate.counters(df, items).first())
    return validate.exit_status(found)


def main(arguments: list[str] | None = None) -> int:
    a = _arguments().parse_args(arguments)
    spark = SparkSession.builder.appName("entitylink").getOrCreate()
    return {"train": train, "match": match, "evaluate": evaluate, "validate": check}[a.command](spark, a)
