"""Mixing sources to target weights by balanced sampling (the cube method).

The total is the largest at which every source can hold its weighted share within its repeats; only sources of fewer than FEW documents don't
hold it down. With ``total``, it is what is asked for. A source that can't fill its share gives all it has, repeats included, and the others share
the rest by weight. Every document of a source then has the same expected number of copies: a whole part, given to all, and a fraction, which is
the probability of one copy more. The cube method turns these probabilities into choices that keep two totals of each source, of documents and of
tokens: it moves the probabilities of three documents at a time along the direction that changes neither total until one of them is 0 or 1
(flight). Blocks of documents fly independently, what is left of them flies again in fewer blocks, until each source has at most
two undecided documents, which are rounded to the nearest totals (landing).
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .encode import DEFAULT_VOCABULARY, spread, token_counter
from .shared import Stage

#: Documents of one block. A source of any size is spread over as many blocks as it needs.
BLOCK = 4000
#: Sources of fewer documents are too coarse to be balanced; they don't set the total.
FEW = 30
_CLOSE = 1e-9


def fly(prob: np.ndarray, tokens: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Probabilities after the flight: sum and token-weighted sum are as before, at most two lie strictly between 0 and 1."""
    p, t = [float(x) for x in prob], [float(x) for x in tokens]
    pending = [i for i in range(len(p)) if _CLOSE < p[i] < 1 - _CLOSE]
    draws = iter(rng.random(len(pending) + 1).tolist())
    three: list[int] = []
    at = 0
    while True:
        while len(three) < 3 and at < len(pending):
            three.append(pending[at])
            at += 1
        if len(three) < 2 or len(three) == 2 and t[three[0]] != t[three[1]]:
            break
        a, b = t[three[0]], t[three[1]]
        c = t[three[2]] if len(three) == 3 else a
        u = (1.0, -1.0, 0.0) if len(three) == 2 or a == b == c else (c - b, a - c, b - a)
        up = down = math.inf
        for i, d in zip(three, u):
            if d > 0:
                up, down = min(up, (1 - p[i]) / d), min(down, p[i] / d)
            elif d < 0:
                up, down = min(up, -p[i] / d), min(down, (p[i] - 1) / d)
        step = up if next(draws) * (up + down) < down else -down
        for i, d in zip(three, u):
            x = p[i] + step * d
            p[i] = 0.0 if x < _CLOSE else 1.0 if x > 1 - _CLOSE else x
        three = [i for i in three if 0.0 < p[i] < 1.0]
    return np.array(p)


def land(prob: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """The choice for a few undecided documents whose token total, and then whose number, is nearest to what is expected."""
    goal, count = float((prob * tokens).sum()), float(prob.sum())
    every = itertools.product((0.0, 1.0), repeat=len(prob))
    return np.array(min(every, key=lambda c: (abs(float(np.dot(c, tokens)) - goal), abs(sum(c) - count), c)))


def _fly_blocks(df: DataFrame, seed: int, level: int) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        rng = np.random.default_rng([seed, level, int(pdf.block.iloc[0]), abs(hash_text(pdf.source.iloc[0]))])
        order = rng.permutation(len(pdf))
        p, t = pdf.prob.to_numpy()[order], pdf.tokens.to_numpy()[order]
        out = pdf.iloc[order].assign(prob=fly(p, t, rng))
        return out[["doc_id", "source", "tokens", "prob"]]

    # a fixed number of partitions: few bytes are much work here, which merging partitions by bytes would put into one task
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, "source", "block").groupBy("source", "block").applyInPandas(run, "doc_id bigint, source string, tokens bigint, prob double")


def hash_text(text: str) -> int:
    """A number of a text that is the same in every process."""
    return int.from_bytes(text.encode("utf-8")[:6].ljust(6, b"\0"), "big") + len(text)


def _land_all(df: DataFrame) -> DataFrame:
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("doc_id", kind="stable")
        return pdf.assign(prob=land(pdf.prob.to_numpy(), pdf.tokens.to_numpy()))[["doc_id", "source", "tokens", "prob"]]

    return df.groupBy("source").applyInPandas(run, "doc_id bigint, source string, tokens bigint, prob double")


def sized(documents: DataFrame, targets: DataFrame, vocabulary: str = DEFAULT_VOCABULARY) -> DataFrame:
    """``doc_id, source, tokens`` of documents of the wanted sources, each once; those without tokens (null, empty) are left out."""
    wanted = targets.filter("target_weight > 0 and coalesce(max_repeats, 1) > 0").select("source").distinct()
    count = token_counter(documents.sparkSession, vocabulary)
    docs = documents.select("doc_id", "source", "text").join(F.broadcast(wanted), "source", "left_semi")
    counted = spread(docs).select("doc_id", F.struct("source", count(F.col("text")).alias("tokens")).alias("d")).filter("d.tokens > 0")
    return counted.groupBy("doc_id").agg(F.max("d").alias("d")).select("doc_id", "d.source", "d.tokens")


def quotas(docs: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """``source, max_repeats, goal, copies``: token goal and expected copies of a document, of every source that has documents.
    Repeated target rows count once. One row a source: the windows are over the small target table."""
    t = targets.filter("target_weight > 0 and coalesce(max_repeats, 1) > 0").groupBy("source").agg(F.max("target_weight").alias("weight"), F.max(F.coalesce("max_repeats", F.lit(1))).alias("max_repeats"))
    have = docs.groupBy("source").agg(F.sum("tokens").alias("have"), F.count(F.lit(1)).alias("n")).join(F.broadcast(t), "source")
    have = have.withColumn("most", F.col("max_repeats") * F.col("have") / F.col("weight"))
    if total is None:
        # tokens for each unit of weight
        level = have.agg(F.coalesce(F.min(F.when(F.col("n") >= FEW, F.col("most"))), F.min("most")).alias("level"))
    else:
        # sources below the level give all they have, the others level x weight; with k of them full the level is what they leave over the weights of the rest
        by = Window.orderBy("most", "source")
        full = have.withColumns({"before": F.coalesce(F.sum(F.col("most") * F.col("weight")).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "weights": F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))})
        fits = full.withColumn("level", (total - F.col("before")) / F.col("weights"))
        level = fits.agg(F.coalesce(F.min(F.when(F.col("level") <= F.col("most"), F.struct("most", "level")))["level"], F.max("most")).alias("level"))
    q = have.crossJoin(F.broadcast(level)).withColumn("goal", F.col("weight") * F.least("most", F.greatest("level", F.lit(0.0))))
    return q.select("source", "max_repeats", "goal", (F.col("goal") / F.col("have")).alias("copies"))


def mixture(documents: DataFrame, targets: DataFrame, stage: Stage, seed: int = 7, vocabulary: str = DEFAULT_VOCABULARY, total: int | None = None) -> DataFrame:
    """``doc_id, source, tokens, copies``: the documents of the mixture, each with its number of copies.

    The targets are a small fixed table (one row a source) and are broadcast. Sources of only one of the tables give nothing. Null
    and empty texts are never used, repeated rows count once. An empty table gives an empty mixture. The same seed gives the same mixture.
    ``total`` asks for a number of tokens; beyond what all sources have within their repeats, all of it is used.
    """
    docs = stage.put("sized", sized(documents, targets, vocabulary))
    q = stage.put("quotas", quotas(docs, targets, total))
    planned = docs.join(F.broadcast(q.select("source", "copies", "max_repeats")), "source")
    whole = F.floor(F.col("copies") + _CLOSE)
    planned = stage.put("planned", planned.select("doc_id", "source", "tokens", whole.cast("int").alias("whole"), F.greatest(F.lit(0.0), F.col("copies") - whole).alias("prob")))
    undecided = planned.filter(f"prob > {_CLOSE}").select("doc_id", "source", "tokens", "prob")
    chosen = None
    for level in range(8):
        sizes = undecided.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
        blocked = undecided.join(F.broadcast(sizes), "source").withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit(level)), F.col("blocks")))
        flown = stage.put(f"flown{level}", _fly_blocks(blocked.select("doc_id", "source", "tokens", "prob", "block"), seed, level))
        sure = flown.filter("prob = 1")
        chosen = sure if chosen is None else chosen.unionByName(sure)
        undecided = flown.filter("prob > 0 and prob < 1")
        if undecided.groupBy("source").count().filter("count > 2").isEmpty():
            break
    chosen = chosen.unionByName(_land_all(undecided).filter("prob = 1")).select("doc_id", F.lit(1).alias("extra")).groupBy("doc_id").agg(F.max("extra").alias("extra"))
    return planned.join(chosen, "doc_id", "left").select("doc_id", "source", "tokens", (F.col("whole") + F.coalesce("extra", F.lit(0))).alias("copies")).filter("copies > 0")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source, target_share, present_share, actual_share, tokens, documents, uses, most_copies`` of every target source: its weight over all weights
    and over those of the sources in the mixture, and what it reached; 0 for one without documents."""
    t = targets.groupBy("source").agg(F.max(F.greatest(F.coalesce("target_weight", F.lit(0.0)), F.lit(0.0))).alias("weight"))
    by = mixed.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("uses"), F.max("copies").alias("most_copies"))
    both = t.join(by, "source", "left")
    sums = both.agg(F.sum("weight").alias("weights"), F.sum(F.when(F.col("tokens") > 0, F.col("weight"))).alias("present"), F.sum("tokens").alias("all_tokens"))
    share = lambda n, m: F.coalesce(F.try_divide(n, m), F.lit(0.0))
    return both.crossJoin(F.broadcast(sums)).select(
        "source", share("weight", "weights").alias("target_share"), F.when(F.col("tokens") > 0, share("weight", "present")).otherwise(0.0).alias("present_share"), share("tokens", "all_tokens").alias("actual_share"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "documents", "uses", "most_copies")],
    )
