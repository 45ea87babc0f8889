"""Pairs meet their texts in cells: the same features as by joins of records, and no prepared column is shuffled."""

import random

import pyarrow as pa
import pytest

from entitylink import api
from entitylink.functions import features
from entitylink.operators import candidates, meeting, scoring

SCHEMA = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(11)
    names = [f"{rng.choice('bdgk')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')} {rng.choice(['Bakery', 'Garage', 'Motors'])}" for _ in range(60)]
    of = lambda side, end, road: spark.createDataFrame([(f"{side}-{i}", n + end, f"{i % 7 + 10} Hill {road} {10000 + i % 9}" if i % 5 else "", "US" if i % 3 else "FR") for i, n in enumerate(names)], SCHEMA)
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i},S2-900") for i in range(30)], "source1_entity_id string, matched_entity_ids string")
    return api.Inputs(of("S1", " Ltd", "Road"), of("S2", "", "Rd"), truth)


def shuffled(df):
    """Types of the columns of all shuffles in the plan."""
    def walk(node):
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            node = node.initialPlan()
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            yield from (node.output().apply(i).dataType().typeName() for i in range(node.output().size()))
        for i in range(node.children().size()):
            yield from walk(node.children().apply(i))

    return list(walk(df._jdf.queryExecution().executedPlan()))


def test_features_of_cells_are_those_of_joins(spark, world):
    found = candidates.union_channels(world.q, world.c).withColumnsRenamed({"score": "blocking_score", "rank": "blocking_rank"})
    joined = features.with_features(features.paired(found, features.prepared(world.q), features.prepared(world.c), ("blocking_score", "blocking_rank")))
    rows = api.feature_rows(world.q, world.c)
    assert rows.dtypes == joined.dtypes
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, joined.collect())) and rows.count() > 500
    assert api.feature_rows(world.q.limit(0), world.c).count() == 0


def test_scoring_shuffles_no_prepared_columns(world):
    types = shuffled(api.feature_rows(world.q, world.c))
    assert "string" in types and "array" not in types
    pairs = features.paired(candidates.exact_name(world.q, world.c), features.prepared(world.q), features.prepared(world.c))
    assert "array" in shuffled(pairs)  # so it would be seen


def test_batches_and_unknown_ids(monkeypatch):
    monkeypatch.setattr(meeting, "BATCH", 2)
    pairs = pa.table({"s1_id": ["b", "a", "b", "x", "a"], "cid": ["1", "1", "2", "1", "9"], "score": [0.5, 0.25, 1.0, 1.0, 1.0], "rank": pa.array([1, 2, 0, 0, 0], pa.int32())})
    texts = pa.table({"first": [True, True, True, False, False], "entity_id": ["a", "b", "c", "2", "1"], "cn": ["na", "nb", "nc", "n2", "n1"], "ca": ["", "ab", "ac", "a2", "a1"]})
    got = meeting.met(pairs, texts)
    flat = {(r["s1_id"], r["cn1"], r["ca1"], *list(o.values())[:5]) for r in got.to_pylist() for o in r["others"]}
    assert flat == {("a", "na", "", "1", 0.25, 2, "n1", "a1"), ("b", "nb", "ab", "1", 0.5, 1, "n1", "a1"), ("b", "nb", "ab", "2", 1.0, 0, "n2", "a2")}
    assert len(got.to_batches()) == 2
    assert meeting.met(pairs.slice(0, 0), texts).num_rows == meeting.met(pairs.slice(3, 1), texts).num_rows == 0


def test_training_shuffles_texts_and_leaves_its_plan_behind(world, monkeypatch):
    assert "array" not in shuffled(api.training_rows(world))
    seen = []
    monkeypatch.setattr(scoring, "train", lambda rows, *_: seen.append((rows.count(), len(rows._jdf.queryExecution().toString()))))
    api.train_on(world)
    assert seen[0][0] == api.training_rows(world).count() > 60 and seen[0][1] < 200_000


def test_training_rows_are_those_of_joins(world):
    rows = api.training_rows(world)
    pairs = rows.select("s1_id", "cid", "blocking_score", "blocking_rank", "label")
    joined = features.with_features(features.paired(pairs, features.prepared(world.q), features.prepared(world.c), ("blocking_score", "blocking_rank", "label")), ("label",))
    assert rows.dtypes == joined.dtypes and sorted(map(tuple, rows.collect())) == sorted(map(tuple, joined.collect()))
