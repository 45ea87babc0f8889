"""Properties of blocking, assembly, metrics, sampling and validation on small tables; text functions against a plain version."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from entitylink.functions import features, text, tokens
from entitylink.operators import assemble, candidates, index, metrics, scoring, training, validate
from entitylink.sources import records


def plain_clean(t):
    if not t:
        return ""
    for sign, letter in text.LEET:
        t = re.sub(f"(?<=[a-zA-Z]){sign}|{sign}(?=[a-zA-Z])", letter, t)
    t = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().lower()
    t = re.sub(rf"\.({text.DOMAINS})\b", " ", t, flags=re.ASCII)
    return " ".join(re.sub(r"[^a-z0-9\s]", " ", t).split())


def test_clean_against_plain_version(spark):
    rng = random.Random(6)
    letters = "aB c01355@.-&'é ﬁ Ｗ№ö日न\t,comnet½"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(800)]
    texts += ["a10 a01 5B info@x.com", "cornerpilates.com", "0105 Rd", "P1lates & Y0ga", "", " ", "x" * 4000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None)], "i int, t string")
    got = {r.i: r.c for r in df.select("i", text.clean(F.col("t")).alias("c")).collect()}
    assert got.pop(-1) == ""
    assert [got[i] for i in range(len(texts))] == [plain_clean(t) for t in texts]
    assert plain_clean("a10 a01 5B info@x.com") == "al0 aol sb infoax"


def test_numbers_and_grams(spark):
    df = spark.createDataFrame([("0105 rd 7th 4b 123456789 12 0012",)], "c string")
    assert df.select(text.numbers(F.col("c"))).first()[0] == ["105", "12"]
    df = spark.createDataFrame([("",), ("a",), ("ab",), ("abc",), ("abcd",)], "c string")
    assert [r[0] for r in df.select(text.grams3(F.col("c"))).collect()] == [[], ["a"], ["ab"], ["abc"], ["abc", "bcd"]]


S1 = [("S1-1", "Target", "12 Gorfu Lane 10001", "US"), ("S1-2", "Rodi Bakery Corp", "", "US"), ("S1-3", "नमस्ते", "5 Rue Pan 75001", "FR"), ("S1-4", "Target Corp", "12 Gorfu Lane 10001", "US")]
OTHER = [("S2-1", "Target Corp", "12 Gorfu Lane 10001", "US"), ("S2-2", "Target", "", "US"), ("S3-1", "Rodi-Bakery", "9 Hill", "US"), ("S3-2", "Target Corp", "12 Gorfu Lane", "FR"), ("S2-9", "Target", "x", "XX")]
SCHEMA = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def sides(spark):
    s1, other = spark.createDataFrame(S1, SCHEMA), spark.createDataFrame(OTHER, SCHEMA)
    return s1, index.cleaned(s1), index.cleaned(records.of_countries(other, s1))


def pairs(df):
    return {(r.s1_id, r.cid) for r in df.collect()}


def test_channels(sides):
    _, q, c = sides
    assert pairs(candidates.exact_name(q, c)) == {("S1-1", "S2-2"), ("S1-4", "S2-1")}
    stem = pairs(candidates.legal_stem(q, c))
    assert ("S1-1", "S2-1") in stem and ("S1-4", "S2-2") not in stem
    assert ("S1-2", "S3-1") not in pairs(candidates.compact_name(q, c))
    united = candidates.union_channels(q, c)
    rows = united.collect()
    assert len(rows) == len({(r.s1_id, r.cid) for r in rows})
    assert not any(r.cid == "S3-2" and r.s1_id != "S1-3" for r in rows), "another country"
    assert index.cleaned(sides[0].limit(0)).count() == 0
    assert candidates.union_channels(q.limit(0), c).count() == 0 and candidates.union_channels(q, c.limit(0)).count() == 0


def test_query_norm_counts_unseen_tokens(spark):
    s = lambda rows: index.cleaned(spark.createDataFrame(rows, SCHEMA))
    q = s([("S1-1", "zeta kappa", "", "US")])
    c = s([("S2-1", "zeta", "", "US"), *[(f"S2-{i}", f"omega{i}", "", "US") for i in range(2, 60)]])
    score = candidates.cosine_topk(q, c).first().score
    alone = candidates.cosine_topk(s([("S1-1", "zeta", "", "US")]), c).first().score
    assert score < alone == pytest.approx(1.0)


def test_assembly_and_metrics(spark, sides):
    scored = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S2-2", 0.4), ("S1-2", "S3-1", 0.7)], "s1_id string, cid string, prob double")
    rows = {r[0]: r[1] for r in assemble.lists(sides[0], assemble.over_threshold(scored, 0.4), "matched_entity_ids", []).collect()}
    assert rows == {"S1-1": "S2-1,S2-2", "S1-2": "S3-1", "S1-3": "", "S1-4": ""}
    e = spark.createDataFrame([("a",), ("b",), ("c",)], "s1_id string")
    truth = spark.createDataFrame([("a", "x"), ("a", "y")], "s1_id string, cid string")
    pred = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("c", "x"), ("unknown", "x")], "s1_id string, cid string")
    counts = metrics.per_entity(e, truth, pred)
    assert metrics.macro_f05(counts).first()[0] == pytest.approx((1.25 * (2 / 3) / (0.25 * 2 / 3 + 1) + 1 + 0) / 3)
    assert 1.25 * (2 / 3) / (0.25 * 2 / 3 + 1) == pytest.approx(0.7142857)
    full = metrics.full_metrics(counts).first()
    assert full.singleton_accuracy == 0.5 and full.macro_recall == 1.0
    assert metrics.full_metrics(counts.limit(0)).first().entities == 0


def test_refined_threshold_lies_between_coarse_steps(spark):
    """Right pairs at 0.573, wrong ones at 0.545, 0.566 and 0.5725: each sweep comes nearer, only the third tells all apart."""
    ed = spark.createDataFrame([(f"S1-{i}",) for i in range(8)], "s1_id string")
    td = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(5)], "s1_id string, cid string")
    sd = spark.createDataFrame([(f"S1-{i}", f"S2-{i}", 0.573) for i in range(5)] + [("S1-5", "S2-9", 0.5725), ("S1-6", "S2-9", 0.566), ("S1-7", "S2-9", 0.545)], "s1_id string, cid string, prob double")
    coarse = metrics.best_threshold(metrics.sweep(ed, td, sd, metrics.threshold_table(spark, 300, 950, 50))).first()
    assert coarse.threshold == 0.55 and coarse.macro_f05 < 1
    got = metrics.refined_threshold(ed, td, sd).first()
    assert (got.threshold, got.macro_f05) == (0.573, 1.0)
    # nothing is gained by going finer: the first winner stays
    assert metrics.refined_threshold(ed, td, sd.filter("prob = 0.573")).first().threshold == 0.3
    assert metrics.refined_threshold(ed.limit(1), td, sd.limit(0)).first().threshold == 0.5
    assert metrics.refined_threshold(ed.limit(0), td, sd).count() == 0


def test_sweep_equals_single_evaluations(spark):
    rng = random.Random(9)
    e = [f"e{i}" for i in range(25)]
    truth = [(x, f"c{rng.randrange(6)}") for x in e[:18] for _ in range(2)]
    scored = [(x, f"c{j}", rng.choice([0.25, 0.3, 0.5, 0.55, 0.9, 1.0])) for x in [*e, "other"] for j in range(4)]
    ed, td = spark.createDataFrame([(x,) for x in e], "s1_id string"), spark.createDataFrame(truth, "s1_id string, cid string").distinct()
    sd = spark.createDataFrame(scored, "s1_id string, cid string, prob double")
    swept = metrics.sweep(ed, td, sd, metrics.threshold_table(spark, 300, 950, 50)).collect()
    assert len(swept) == 14
    for r in swept[::5]:
        one = metrics.full_metrics(metrics.per_entity(ed, td, sd.filter(F.col("prob") >= r.threshold).join(ed, "s1_id", "left_semi"))).first()
        assert (r.macro_f05, r.macro_precision, r.macro_recall, r.singleton_accuracy) == pytest.approx((one.macro_f05, one.macro_precision, one.macro_recall, one.singleton_accuracy))


def test_auc(spark):
    rng = random.Random(2)
    rows = [(rng.choice([0.0, 0.1, 0.5, 0.50001, 0.9, 1.0]), rng.randrange(2)) for _ in range(200)]
    pos, neg = [p for p, y in rows if y], [p for p, y in rows if not y]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert scoring.roc_auc(spark.createDataFrame(rows, "prob double, label int")).first()[0] == pytest.approx(expected)
    assert scoring.roc_auc(spark.createDataFrame([], "prob double, label int")).first()[0] is None


def test_samples(spark):
    e = spark.createDataFrame([(f"S1-{i}",) for i in range(2000)], "s1_id string")
    assert 60 < training.split(e).filter("is_validation").count() < 145
    assert training.holdout(e, 0.8, 30).count() == 30
    p = spark.createDataFrame([("a", f"c{i}", i, int(i in (3, 9))) for i in range(12)], "s1_id string, cid string, rank int, label int")
    kept = training.hard_negatives(p)
    assert kept.filter("label = 1").count() == 2 and sorted(r.rank for r in kept.filter("label = 0").collect()) == [0, 1, 2, 4]


def test_validation(spark, tmp_path):
    f = tmp_path / "m.tsv"
    f.write_text('source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,S2-1\nS1-1\tS1-9\n\nbroken line\nS1-7\tX-1\nS1-2\t"q\n', encoding="utf-8")
    lines = spark.read.text(str(f))
    assert [r.value for r in validate.malformed(lines).collect()] == ["broken line"]
    schema = records.T.StructType([records.T.StructField(c, records.T.StringType()) for c in validate.HEADERS["matching"]])
    df = records.read_tsv(spark, str(f), schema)
    s1, other = spark.createDataFrame(S1, SCHEMA), spark.createDataFrame(OTHER, SCHEMA)
    report = {r.rule: (r.n, r.examples) for r in validate.report(df, *validate.HEADERS["matching"], s1, other).collect()}
    assert report["duplicate_row"] == (1, "S1-1") and report["self_match"] == (1, "S1-9") and report["repeated_item"] == (1, "S1-1")
    assert report["missing"] == (2, "S1-3,S1-4") and report["unexpected"] == (1, "S1-7") and report["unknown"][0] == 3
    assert validate.check_header("source1_entity_id,matched_entity_ids", "matching") and not validate.check_header(" Source1_Entity_Id\tmatched_entity_ids\n", "matching")
    assert validate.check_header("", "matching") == ["file is empty"]


def test_round_trip_of_lists(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", 'S2-1,"S2-2'), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string")
    records.write_lists(df, str(tmp_path / "out"), single_file=True)
    body = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert body == 'source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1,"S2-2\nS1-2\t\n'


def test_training_and_stream(spark, tmp_path):
    from entitylink import api
    from entitylink.streaming import incremental

    rng = random.Random(4)
    names = [f"{rng.choice('bdgk')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}{i} {rng.choice(['Bakery', 'Garage', 'Motors'])}" for i in range(40)]
    s1 = spark.createDataFrame([(f"S1-{i}", n + " Ltd", f"{i + 10} Hill Road {10000 + i}", "US") for i, n in enumerate(names)], SCHEMA)
    other = spark.createDataFrame([(f"S2-{i}", n, f"{i + 10} Hill Rd {10000 + i}", "US") for i, n in enumerate(names)], SCHEMA)
    rows = api.feature_rows(index.cleaned(s1), index.cleaned(other)).withColumn("label", (F.substring("s1_id", 4, 9) == F.substring("cid", 4, 9)).cast("int")).persist()
    model = scoring.train(rows, {"max_depth": 3, "rounds": 3, "step_size": 0.5})
    auc = scoring.roc_auc(scoring.score(model, rows)).first()[0]
    assert auc > 0.95
    scoring.save(model, str(tmp_path / "model"), {"threshold": 0.5})
    model, side = scoring.load(str(tmp_path / "model"))
    assert side == {"threshold": 0.5}
    assert scoring.importances(model, spark, 3).count() == 3
    matches, listed = api.run(s1, other, model, 0.5)
    assert matches.count() == 40 and listed.count() == 40
    s1.write.parquet(str(tmp_path / "arriving"))
    q = incremental.match_stream(incremental.arriving(spark, str(tmp_path / "arriving")), other, model, 0.5, str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(240)
    assert spark.read.parquet(str(tmp_path / "out")).drop("batch").orderBy("source1_entity_id").collect() == matches.orderBy("source1_entity_id").collect()


def test_tokens_keep_multiplicity(spark):
    df = spark.createDataFrame([("rodi bakery", "12 hill road")], "cn string, ca string")
    got = df.select(F.array_sort(tokens.blocking_tokens(F.col("cn"), F.col("ca")))).first()[0]
    assert got == sorted(["rodi", "bakery", "12", "hill", "rodibakery", "rodibakery", "num_12", "rod", "odi", "bak", "ake", "ker", "ery"])


def test_warnings_counters_and_status(spark):
    df = spark.createDataFrame([("S1-1", "S2-1, S3-1"), ("S1-2", None), ("S1-4", "S2-2")], "source1_entity_id string, matched_entity_ids string")
    listed = spark.createDataFrame([("S1-1", "S2-1"), ("S1-4", "S2-2")], "s1_id string, cid string")
    owner, items = validate.HEADERS["matching"]
    assert [tuple(r) for r in validate.not_candidates(df, owner, items, listed).collect()] == [("S1-1", "S3-1")]
    assert tuple(validate.counters(df, items).first()) == (3, 1, 3) and tuple(validate.counters(df.limit(0), items).first()) == (0, 0, 0)
    s1, other = spark.createDataFrame(S1, SCHEMA), spark.createDataFrame(OTHER, SCHEMA)
    found = validate.report(df.unionByName(spark.createDataFrame([("S1-3", "")], df.schema)), owner, items, s1, other, listed=listed)
    assert [(r.rule, r.severity, r.n) for r in found.collect()] == [("match_not_candidate", "warning", 1)] and validate.exit_status(found) == 0
    assert validate.exit_status(validate.report(df, owner, items, s1, other)) == 1


def test_feature_table_is_made_once_per_settings(spark, tmp_path):
    from entitylink import api

    a = api.feature_table(spark.range(3), str(tmp_path), {"k": 1})
    assert a.count() == 3 and api.feature_table(spark.range(5), str(tmp_path), {"k": 1}).count() == 3
    assert api.feature_table(spark.range(5), str(tmp_path), {"k": 2}).count() == 5


def test_files_in_files_out(spark, tmp_path, capsys):
    """Train, match, evaluate and validate from the command line, on tab-separated files."""
    from entitylink.main import main

    rng = random.Random(7)
    names = [f"{rng.choice('bdgk')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}{i} {rng.choice(['Bakery', 'Garage', 'Motors'])}" for i in range(12)]
    head = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    (tmp_path / "s1.tsv").write_text(head + "".join(f"S1-{i}\t{n} Ltd\t{i + 10} Hill Road {10000 + i}\tUS\n" for i, n in enumerate(names)))
    (tmp_path / "s2.tsv").write_text(head + "".join(f"S2-{i}\t{n}\t{i + 10} Hill Rd {10000 + i}\tUS\n" for i, n in enumerate(names)))
    (tmp_path / "truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i}\n" for i in range(10)))
    at = lambda n: str(tmp_path / n)
    both = ["--s1", at("s1.tsv"), "--others", at("s2.tsv")]
    assert main(["train", *both, "--truth", at("truth.tsv"), "--model", at("model"), "--params", '{"max_depth": 2, "rounds": 2, "step_size": 0.5}']) == 0
    assert main(["match", *both, "--model", at("model"), "--out", at("out")]) == 0
    lines = [line for p in (tmp_path / "out" / "matching_results").glob("part-*") for line in p.read_text().splitlines() if line.startswith("S1-")]
    assert len(lines) == 12 and "S1-3\tS2-3" in lines
    capsys.readouterr()
    assert main(["evaluate", *both, "--truth", at("truth.tsv"), "--model", at("model"), "--n", "5"]) == 0
    assert '"entities": 2' in capsys.readouterr().out
    check = ["validate", *both, "--matches", at("out/matching_results"), "--candidates", at("out/candidate_pairs"), "--check-ids"]
    assert main(check) == 0 and "rows, empty lists, ids: 12" in capsys.readouterr().out
    assert main(["validate", *both, "--matches", at("nowhere")]) == 1 and "does not exist" in capsys.readouterr().out


def test_search_keeps_the_best_parameters(spark):
    from entitylink import api

    entities = spark.createDataFrame([(f"S1-{i}",) for i in range(40)], "s1_id string")
    truth = spark.createDataFrame([(f"S1-{i}", f"S2-{i}") for i in range(40)], "s1_id string, cid string")
    base = {f: 0.0 for f in features.FEATURES}
    rows = spark.createDataFrame([{"s1_id": f"S1-{i}", "cid": f"S2-{j}", "label": int(i == j), **base, "name_ratio": 90.0 if i == j else 10.0} for i in range(40) for j in (i, i + 50)]).persist()
    params, score = api.tune(rows, [{"max_depth": 1, "rounds": 1, "step_size": 0.5}, {"max_depth": 2, "rounds": 2, "step_size": 0.5}], entities, truth)
    assert score == 1.0 and params["rounds"] in (1, 2)


def test_registered_queries_train_with_the_defaults(spark, tmp_path, monkeypatch):
    from entitylink.plans import catalog

    for n, rows in ((1, S1), (2, OTHER[:2]), (3, OTHER[2:4])):
        spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / f"source{n}.parquet"))
    spark.createDataFrame([("S1-4", "S2-1"), ("S1-2", "S3-1")], "source1_entity_id string, matched_entity_ids string").write.parquet(str(tmp_path / "known_matches.parquet"))
    used = []

    def train(labelled, params=None, validation=None):
        used.append(scoring.DEFAULTS | (params or {}))
        raise InterruptedError

    monkeypatch.setattr(scoring, "train", train)
    for name in ("model_score", "feature_importance", "run_pipeline"):
        with pytest.raises(InterruptedError):
            catalog.queries()[name](spark, str(tmp_path))
    assert used == [scoring.DEFAULTS] * 3
