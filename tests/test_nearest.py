"""The block-wise cosine against a plain sum over the postings, and what it shuffles."""

import math
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from entitylink.operators import candidates, nearest


def records(spark, side, n):
    words = ["alpha", "bravo", "delta", "gamma", "kilo", "lima", "omega", "sigma", "tango", "zulu"]
    rows = [("X" if i % 3 else "Y", f"{side}-{i:04d}", f"{words[i * i % 7]} {words[i % 10]} {words[i % 9]}", f"{i % 40} {words[i % 4]} street" if i % 5 else "") for i in range(n)]
    return spark.createDataFrame(rows, "country string, entity_id string, cn string, ca string")


def plain(queries, pool, k, least):
    """By one dictionary a token."""
    from entitylink.operators import index

    counts = lambda df: {(r.country, r.entity_id): Counter() for r in df.collect()} | as_counts(index.term_frequency(df).collect())
    def as_counts(rows):
        out = defaultdict(Counter)
        for r in rows:
            out[r.country, r.entity_id][r.token] += r.tf
        return dict(out)
    q, c = counts(queries), counts(pool)
    banned = {(r.country, r.token) for r in index.banned_tokens(index.term_frequency(pool), pool).collect()}
    unit = {}
    for key, v in [*q.items(), *c.items()]:
        kept = {t: n for t, n in v.items() if (key[0], t) not in banned}
        norm = math.sqrt(sum(n * n for n in kept.values()))
        unit[key] = {t: n / norm for t, n in kept.items()}
    found = {}
    for a in q:
        scores = [(-round(s, 9), b[1]) for b in c if b[0] == a[0] and (s := sum(u * unit[b].get(t, 0) for t, u in unit[a].items())) > least]
        found |= {(a[1], cid): (turn, -s) for turn, (s, cid) in enumerate(sorted(scores)[:k], 1)}
    return found


@pytest.mark.parametrize("blocks", [(7, 11), (32_768, 131_072)])
def test_blocks_give_the_plain_result(spark, monkeypatch, blocks):
    monkeypatch.setattr(nearest, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(nearest, "CANDIDATE_BLOCK", blocks[1])
    queries, pool = records(spark, "S1", 40), records(spark, "S2", 90)
    found = {(r.s1_id, r.cid): (r.rank, round(r.score, 9)) for r in candidates.cosine_topk(queries, pool, 6).collect()}
    expected = plain(queries, pool, 6, 0.008)
    assert expected and {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    assert all(abs(found[k][1] - expected[k][1]) < 1e-8 for k in expected)


def test_ties_in_a_block_by_id_and_no_shared_token():
    q = pa.table({"entity_id": ["q1", "q2"], "tokens": ["aa bb", "zz"]})
    c = pa.table({"entity_id": ["c3", "c1", "c2", None], "tokens": ["aa", "aa", "bb cc", "cc"]})
    assert nearest.best_of_block(q, c, 2, 0.008).to_pydict()["cid"] == ["c1", "c2"]
    assert nearest.best_of_block(q.slice(0, 0), c, 2, 0.008).num_rows == 0


def test_no_row_for_each_shared_token(spark):
    """Rows of the postings' join were shuffled once for each token a pair shares."""
    plan = candidates.cosine_topk(records(spark, "S1", 5), records(spark, "S2", 5))._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan


def test_union_takes_the_first_channel_once(spark):
    queries, pool = records(spark, "S1", 30), records(spark, "S2", 60)
    rows = candidates.union_channels(queries, pool, 3).collect()
    assert len({(r.s1_id, r.cid) for r in rows}) == len(rows)
    cosine = {(r.s1_id, r.cid): r.rank for r in candidates.cosine_topk(queries, pool, 3).collect()}
    exact = {(r.s1_id, r.cid) for r in candidates.exact_name(queries, pool).collect()}
    for r in rows:
        key = (r.s1_id, r.cid)
        if key in cosine:
            assert (r.channel, r.rank) == ("cosine", cosine[key])
        elif key in exact:
            assert (r.channel, r.score, r.rank) == ("exact", 1.0, 0)
        else:
            assert (r.channel, r.score, r.rank) in {("stem", 0.98, 0), ("compact", 0.95, 0), ("rare", 0.85, 1), ("anchor", 0.8, 2)}


def test_hard_negatives_read_the_pairs_once(spark):
    from entitylink.operators import training

    pairs = spark.createDataFrame([("a", f"c{i}", i % 3, int(i == 5)) for i in range(9)], "s1_id string, cid string, rank int, label int")
    found = training.hard_negatives(pairs, 2)
    assert sorted(r.cid for r in found.collect()) == ["c0", "c3", "c5"]
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_missed_positives_block_only_records_with_true_pairs(spark, tmp_path, monkeypatch):
    from entitylink.plans import catalog

    for n, rows in ((1, [("S1-1", "alpha"), ("S1-2", "bravo")]), (2, [("S2-1", "alpha"), ("S2-2", "kilo")]), (3, [("S3-1", "bravo")])):
        spark.createDataFrame([(*r, "", "X") for r in rows], "entity_id string, business_name string, business_address string, country string").write.parquet(f"{tmp_path}/source{n}.parquet")
    spark.createDataFrame([("S1-1", "S2-1, S2-2"), ("S1-2", "")], "source1_entity_id string, matched_entity_ids string").write.parquet(f"{tmp_path}/known_matches.parquet")
    seen, real = [], candidates.union_channels

    def union(queries, pool, *rest):
        seen.extend(r.entity_id for r in queries.collect())
        return real(queries, pool, *rest)

    monkeypatch.setattr(candidates, "union_channels", union)
    assert [(r.s1_id, r.cid) for r in catalog.queries()["missed_positives"](spark, str(tmp_path)).collect()] == [("S1-1", "S2-2")]
    assert seen == ["S1-1"]
