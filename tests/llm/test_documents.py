"""Mixing and truncation."""

import random

import numpy as np
import pytest

from entitylink.llm import mixing, truncation
from entitylink.llm.shared import Stage, ship


@pytest.mark.parametrize("seed", range(5))
def test_flight_keeps_both_totals(seed):
    rng = np.random.default_rng(seed)
    t = rng.integers(1, 400, 300)
    p = rng.random(300)
    if seed == 3:
        t[:] = 7
    out = mixing.fly(p, t, rng)
    assert out.sum() == pytest.approx(p.sum()) and (out * t).sum() == pytest.approx((p * t).sum())
    assert ((out > 0) & (out < 1)).sum() <= 2


def test_flight_is_unbiased():
    t, p = np.array([3, 9, 4, 11, 6]), np.array([0.2, 0.5, 0.7, 0.4, 0.9])
    mean = np.mean([mixing.fly(p, t, np.random.default_rng(s)) for s in range(4000)], axis=0)
    assert mean == pytest.approx(p, abs=0.04)


def test_mixture(spark):
    ship(spark)
    rng = random.Random(1)
    sentence = lambda: " ".join(rng.choice("the rusty belt lost some noise".split()) for _ in range(rng.randint(3, 60)))
    rows = [(i, s, sentence()) for i, s in enumerate(["big"] * 600 + ["mid"] * 200 + ["low"] * 60 + ["other"] * 10)]
    rows += [(9001, "low", None), (9002, "low", ""), (9003, None, "no source here")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("big", 5.0, 2), ("mid", 3.0, 2), ("low", 2.0, 3), ("absent", 1.0, 2)], "source string, target_weight double, max_repeats int")
    mixed = mixing.mixture(docs, targets, Stage(spark, "t"))
    got = mixed.collect()
    assert len({r.doc_id for r in got}) == len(got) and not {9001, 9002, 9003} & {r.doc_id for r in got}
    share = {r.source: r for r in mixing.shares(mixed, targets).collect()}
    for s, w, most in (("big", 0.5, 2), ("mid", 0.3, 2), ("low", 0.2, 3)):
        assert share[s].actual_share == pytest.approx(w, abs=0.005) and share[s].most_copies <= most
    assert share["absent"].actual_share == 0 and "other" not in share
    again = mixing.mixture(docs, targets, Stage(spark, "t")).collect()
    assert {(r.doc_id, r.copies) for r in again} == {(r.doc_id, r.copies) for r in got}
    assert mixing.mixture(docs.limit(0), targets, Stage(spark, "t")).count() == 0


def test_mixture_of_a_given_total_and_of_scarce_sources(spark):
    """Sources below their share give all they have; a source of a few documents doesn't hold the total down."""
    docs = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate([("big", 10)] * 100 + [("mid", 10)] * 50 + [("tiny", 10)])], "doc_id bigint, source string, tokens bigint")
    targets = spark.createDataFrame([("big", 2.0, 2), ("mid", 1.0, 3), ("tiny", 1.0, 4)], "source string, target_weight double, max_repeats int")
    goals = lambda total: {r.source: round(r.goal, 6) for r in mixing.quotas(docs, targets, total).collect()}
    assert goals(None) == {"big": 2000, "mid": 1000, "tiny": 40}
    assert goals(80) == {"big": 40, "mid": 20, "tiny": 20}
    assert goals(640) == {"big": 400, "mid": 200, "tiny": 40}
    assert goals(3400) == {"big": 2000, "mid": 1360, "tiny": 40}
    assert goals(9_000_000) == {"big": 2000, "mid": 1500, "tiny": 40}
    assert mixing.quotas(docs.limit(0), targets, 100).count() == 0


WORDS = "the rusty belt lost some noise whenever it rains because nobody greased shaft and another gasket carries thin crust of salt".split()


def corpus(n=3000, seed=3):
    rng = random.Random(seed)
    rows, cut = [], set()
    for i in range(n):
        source = rng.choice(["limited", "free"])
        text = ""
        for _ in range(rng.randint(1, 14)):
            text += " ".join(rng.choice(WORDS) for _ in range(rng.randint(4, 12))) + " " + rng.choice(["rains", "shaft", "salt"]) + ". "
        text = text.strip()
        if source == "limited" and len(text) > 300:
            text = text[:300]
            if text.rstrip()[-1] != ".":
                cut.add(i)
        rows.append((i, source, text))
    return rows, cut


def test_truncated_at_a_limit(spark):
    rows, cut = corpus()
    rows += [(10001, "free", None), (10002, "free", ""), (10003, None, "  ")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = {r.doc_id for r in truncation.truncated(docs, Stage(spark, "t")).collect()}
    assert len(got & cut) >= 0.95 * len(cut) and len(got - cut) <= 0.02 * len(cut)
    limits = truncation.hazards(truncation.endings(docs)).filter("unit = 'chars'").collect()
    assert {r.length for r in limits if r.source == "limited"} >= {300} and not [r for r in limits if r.source == "free"]
    rates = {r.source: r for r in truncation.truncation_rates(docs, Stage(spark, "t")).collect()}
    assert rates["limited"].truncated >= 0.95 * len(cut) and rates[None].documents == 1
    assert truncation.truncated(docs.limit(0), Stage(spark, "t")).count() == 0


def test_endings(spark):
    cases = {
        "It rains.": "stopped", "We lost the belt (read more)": "marked", "needs the <blockqu": "broken", "under a &quo": "broken", "see [url=http://": "broken", "https://a.example/t/12": "finished",
        "ok.\n-- \nName | est. 1999": "finished", "the rusty be": "word", "the rusty,": "open", "well [/i]": "closed", "> the club archive lost a b [...]": "quoted", "too hot, 40 °C": "closed",
    }
    docs = spark.createDataFrame([(i, "s", t) for i, t in enumerate(cases)], "doc_id bigint, source string, text string")
    got = {r.doc_id: r.kind for r in truncation.endings(docs).collect()}
    assert [got[i] for i in range(len(cases))] == list(cases.values())
