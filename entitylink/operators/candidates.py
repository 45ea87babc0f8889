"""Candidate retrieval inside each country: cosine top-k and five hash channels, united with the first channel winning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.tokens import blocking_tokens, selective_words
from . import index, meeting, nearest

CHANNELS = {"cosine": 0, "exact": 1, "stem": 2, "compact": 3, "rare": 4, "anchor": 5}
# Score and rank of what the hash channels find.
GIVEN = {"exact": (1.0, 0), "stem": (0.98, 0), "compact": (0.95, 0), "rare": (0.85, 1), "anchor": (0.8, 2)}


def _first(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("turn") <= n)


def _token_texts(records: DataFrame) -> DataFrame:
    """``country, entity_id, tokens``: the blocking tokens of a record in one text, parted by blanks, which no token contains."""
    texts = records.select("country", "entity_id", F.array_join(blocking_tokens(F.col("cn"), F.col("ca")), " ").alias("tokens")).filter("tokens <> ''")
    return texts.groupBy("country", "entity_id").agg(F.array_join(F.collect_list("tokens"), " ").alias("tokens"))


def _block_scores(queries: DataFrame, candidates: DataFrame, k: int, min_score: float) -> DataFrame:
    """``s1_id, cid, score``: the best of each query in each block of its country's candidates."""
    size = lambda df, block, name: df.groupBy("country").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias(name))
    blocks = size(queries, nearest.QUERY_BLOCK, "qs").join(size(candidates, nearest.CANDIDATE_BLOCK, "cs"), "country")
    q, c = _token_texts(queries), _token_texts(candidates)
    cells = c.select("country", F.explode(F.array_distinct(F.split("tokens", " "))).alias("token"))
    dropped = index.banned_tokens(cells, candidates).groupBy("country").agg(F.array_join(F.collect_list("token"), " ").alias("tokens"))
    blocks = F.broadcast(blocks)  # a row a country
    own = lambda of: F.pmod(F.xxhash64("entity_id"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))
    keys = ["country", "qb", "cb"]
    left = q.join(blocks, "country").withColumn("qb", own("qs")).withColumn("cb", every("cs"))
    right = c.join(blocks, "country").withColumn("cb", own("cs")).withColumn("qb", every("qs"))
    rest = dropped.join(blocks, "country").withColumn("entity_id", F.lit(None).cast("string")).withColumn("cb", every("cs")).withColumn("qb", every("qs"))
    # blocks are work, not bytes: their number of partitions is fixed, else a few small ones would be run in one task
    tasks = 4 * int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = lambda df: df.select(*keys, "entity_id", "tokens").repartition(tasks, *keys).groupBy(*keys)

    def best(one, other):
        return nearest.best_of_block(one, other, k, min_score)

    return dealt(left).cogroup(dealt(right.select(*keys, "entity_id", "tokens").unionByName(rest.select(*keys, "entity_id", "tokens")))).applyInArrow(best, "s1_id string, cid string, score double")


def cosine_topk(queries: DataFrame, candidates: DataFrame, k: int = 25, min_score: float = 0.008) -> DataFrame:
    """``s1_id, cid, score, rank`` of the ``k`` candidates of highest cosine of raw token counts, in the query's country.

    Tokens in too many candidates are dropped on both sides. The query's norm counts tokens that no candidate has. Ties by candidate id.
    """
    scored = _block_scores(queries, candidates, k, min_score)
    best = _first(scored, ["s1_id"], [F.desc(F.round("score", nearest.DIGITS)), F.asc("cid")], k)
    return best.select("s1_id", "cid", "score", F.col("turn").alias("rank"))


def _bucket(queries: DataFrame, entries: DataFrame, keys: list[str], cap: int) -> DataFrame:
    """Queries joined to the first ``cap`` entries of their bucket; a pair of several buckets comes several times. The cap is applied to
    the bucket, before the join: its size doesn't multiply with the queries of the same key."""
    head = _first(entries, keys, [F.asc("cid")], cap).drop("turn")
    return queries.join(head, keys).select("s1_id", "cid")


def _channel(pairs: DataFrame, name: str) -> DataFrame:
    score, rank = GIVEN[name]
    return pairs.distinct().select("s1_id", "cid", F.lit(score).alias("score"), F.lit(rank).alias("rank"))


def _q(queries: DataFrame, key: Column, name: str = "key") -> DataFrame:
    return queries.select("country", F.col("entity_id").alias("s1_id"), key.alias(name))


def _c(candidates: DataFrame, key: Column, name: str = "key") -> DataFrame:
    return candidates.select("country", F.col("entity_id").alias("cid"), key.alias(name))


def _exact_pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    cn = F.col("cn")
    return _bucket(_q(queries, cn).filter("key <> ''"), _c(candidates, cn).filter("key <> ''"), ["country", "key"], 50)


def _stem_pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    stem = text.legal_stem(F.col("cn"))
    entries = _c(candidates.filter(stem != F.col("cn")), stem).filter("length(key) >= 3")
    return _bucket(_q(queries, stem).filter("length(key) >= 3"), entries, ["country", "key"], 40)


def _compact_pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    cp = text.compact(F.col("cn"))
    return _bucket(_q(queries, cp).filter("length(key) >= 4"), _c(candidates, cp).filter("length(key) >= 4"), ["country", "key"], 40)


def _rare_pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    q = queries.select("country", F.col("entity_id").alias("s1_id"), F.explode(F.array_distinct(selective_words(F.col("cn")))).alias("word"))
    return _bucket(q, index.selective_index(candidates), ["country", "word"], 25)


def _anchor_pairs(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    q = queries.filter("ca <> ''").select(
        "country", F.col("entity_id").alias("s1_id"), F.array_union(text.numbers(F.col("cn")), text.numbers(F.col("ca"))).alias("nums"),
        F.array_distinct(F.slice(selective_words(F.col("ca")), 1, 8)).alias("ws"),
    )
    q = q.select("country", "s1_id", F.explode("nums").alias("num"), "ws").select("country", "s1_id", "num", F.explode("ws").alias("word"))
    return q.join(index.anchor_buckets(candidates), ["country", "num", "word"]).select("s1_id", "cid")


def exact_name(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    return _channel(_exact_pairs(queries, candidates), "exact")


def legal_stem(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """One-sided: a candidate is found by its stem only if the stem differs from its name."""
    return _channel(_stem_pairs(queries, candidates), "stem")


def compact_name(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    return _channel(_compact_pairs(queries, candidates), "compact")


def rare_token(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    return _channel(_rare_pairs(queries, candidates), "rare")


def address_anchor(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    return _channel(_anchor_pairs(queries, candidates), "anchor")


def _all_hits(queries: DataFrame, candidates: DataFrame, k: int, min_score: float) -> DataFrame:
    """``s1_id, cid, prio, score, rank`` of all channels. Scores and ranks are fixed in all but the cosine, which goes before the others."""
    every = cosine_topk(queries, candidates, k, min_score).select("s1_id", "cid", F.lit(CHANNELS["cosine"]).alias("prio"), "score", "rank")
    for name, pairs in (("exact", _exact_pairs), ("stem", _stem_pairs), ("compact", _compact_pairs), ("rare", _rare_pairs), ("anchor", _anchor_pairs)):
        found = pairs(queries, candidates).select("s1_id", "cid", F.lit(CHANNELS[name]).alias("prio"))
        every = every.unionByName(found, allowMissingColumns=True)
    return every


def _first_channel(every: DataFrame, *more: str) -> DataFrame:
    first = every.groupBy(*more, "s1_id", "cid").agg(F.min("prio").alias("prio"), F.max("score").alias("score"), F.max("rank").alias("rank"))
    of = lambda values, other: reduce(lambda c, name: F.when(F.col("prio") == CHANNELS[name], F.lit(values[name])).otherwise(c), values, other)
    return first.select(
        *more, "s1_id", "cid", of({name: name for name in CHANNELS}, F.lit("")).alias("channel"),
        of({name: v[0] for name, v in GIVEN.items()}, F.col("score")).alias("score"), of({name: v[1] for name, v in GIVEN.items()}, F.col("rank")).alias("rank"),
    )


def union_channels(queries: DataFrame, candidates: DataFrame, k: int = 25, min_score: float = 0.008) -> DataFrame:
    """``s1_id, cid, channel, score, rank``: all channels, each pair once with the score and rank of its first channel.

    Only the channel's number is shuffled with a pair of a hash channel.
    """
    return _first_channel(_all_hits(queries, candidates, k, min_score))


def union_with_texts(queries: DataFrame, candidates: DataFrame, k: int = 25, min_score: float = 0.008) -> DataFrame:
    """The same pairs with the texts of both sides, in the rows of ``meeting.with_texts``: the one shuffle that makes pairs single also
    takes them to their texts."""
    return meeting.with_texts(_first_channel(meeting.by_cell(_all_hits(queries, candidates, k, min_score)), "cell"), queries, candidates)
