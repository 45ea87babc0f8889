"""Candidate-side index tables: term and document frequencies, pruning, norms, selective words, address anchors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.tokens import blocking_tokens, selective_words

DF_CEILING = 0.03
MAX_WORD_FREQUENCY = 60
ANCHOR_BUCKET = 30


def cleaned(records: DataFrame) -> DataFrame:
    """``country, entity_id, cn, ca``."""
    return records.select("country", "entity_id", text.clean(F.col("business_name")).alias("cn"), text.clean(F.col("business_address")).alias("ca"))


def term_frequency(records: DataFrame) -> DataFrame:
    tokens = records.select("country", "entity_id", F.explode(blocking_tokens(F.col("cn"), F.col("ca"))).alias("token"))
    return tokens.groupBy("country", "entity_id", "token").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(tf: DataFrame) -> DataFrame:
    return tf.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df"))


def banned_tokens(tf: DataFrame, records: DataFrame, ceiling: float = DF_CEILING) -> DataFrame:
    """``country, token`` in more than the ceiling's share of a country's records. A record has a bounded number of tokens, so at most
    that number divided by the ceiling can be banned in a country, whatever the data's size."""
    size = records.groupBy("country").agg(F.count(F.lit(1)).alias("n"))
    limit = size.select("country", F.greatest(F.lit(1), F.floor(F.col("n") * ceiling)).alias("most"))
    return document_frequency(tf).join(limit, "country").filter(F.col("df") > F.col("most")).select("country", "token")


def pruned(tf: DataFrame, banned: DataFrame) -> DataFrame:
    return tf.join(banned, ["country", "token"], "left_anti")


def norms(tf: DataFrame) -> DataFrame:
    return tf.groupBy("country", "entity_id").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("norm"))


def word_frequency(records: DataFrame) -> DataFrame:
    w = records.select("country", F.explode(F.array_distinct(selective_words(F.col("cn")))).alias("word"))
    return w.groupBy("country", "word").agg(F.count(F.lit(1)).alias("freq"))


def selective_index(records: DataFrame, most: int = MAX_WORD_FREQUENCY) -> DataFrame:
    """``country, word, cid`` for name words in at most ``most`` records of a country."""
    rare = word_frequency(records).filter(F.col("freq") <= most).select("country", "word")
    w = records.select("country", F.col("entity_id").alias("cid"), F.explode(F.array_distinct(selective_words(F.col("cn")))).alias("word"))
    return w.join(rare, ["country", "word"])


def anchors(records: DataFrame, first_words: int) -> DataFrame:
    """``country, entity_id, num, word, at``: address numbers with two or more digits beside the first address words. Repeated words
    stay, they take a place in a bucket."""
    a = records.filter("ca <> ''").select("country", "entity_id", text.numbers(F.col("ca")).alias("nums"), F.slice(selective_words(F.col("ca")), 1, first_words).alias("ws"))
    return (
        a.select("country", "entity_id", F.explode("nums").alias("num"), "ws").filter(F.length("num") >= 2)
        .select("country", "entity_id", "num", F.posexplode("ws").alias("at", "word"))
    )


def anchor_buckets(records: DataFrame, size: int = ANCHOR_BUCKET) -> DataFrame:
    """``country, num, word, cid`` of the first ``size`` entries of each bucket, in the order of source and id."""
    order = Window.partitionBy("country", "num", "word").orderBy("entity_id", "at")
    return anchors(records, 6).withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= size).select("country", "num", "word", F.col("entity_id").alias("cid")).distinct()
