"""Matching records of several sources without a common key: a cascade of exact joins on weaker and weaker attributes.

Attributes of a record: its organisation (variants.py), the spelling of its name, and the components of its address
(addresses.py). Each rule joins source-1 records and candidates exactly on one combination; pairs that an earlier rule has
found are taken out of the later ones by an anti-join, so every pair carries the strongest rule it fulfils. It is pairs and not
records that are taken out: several source-1 records may describe one establishment, and a candidate that is resolved with one
of them may meet the other only by a weaker rule.

The confidence of a rule is its precision among the labelled source-1 records, smoothed by one right and one wrong pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .addresses import FIELDS, locations
from .components import match_lists
from .shared import Stage, records
from .variants import organisations

_UNITS = "(a.unit = b.unit or a.unit = '' or b.unit = '')"
_KINDS = "(a.kind = b.kind or a.kind = '' or b.kind = '') and (a.direction = b.direction or a.direction = '' or b.direction = '')"
#: Rules from the strongest to the weakest: name, attributes that must be equal and real on both sides, further condition.
RULES = [
    ("name and place", ["sid", "place"], "true"),
    ("organisation, number, postal code", ["org", "number", "postal"], _UNITS),
    ("organisation, number, street", ["org", "number", "street"], f"{_UNITS} and {_KINDS} and (a.postal = '' or b.postal = '') and (a.city = b.city or a.city = '' or b.city = '' or levenshtein(a.city, b.city, 3) >= 0)"),
    ("organisation, number, city", ["org", "number", "city"], f"{_UNITS} and {_KINDS} and (a.postal = '' or b.postal = '') and levenshtein(a.street, b.street, 4) >= 0"),
    ("brand, number, postal code", ["folded", "given", "number", "postal"], f"{_UNITS} and (a.line = b.line or a.line = '' or b.line = '')"),
    ("line, number, postal code", ["line", "number", "postal"], f"{_UNITS} and (a.given = b.given or substring(a.given, 1, 1) = b.given or a.given = substring(b.given, 1, 1)) and levenshtein(a.folded, b.folded, 4) >= 0"),
    ("organisation, address missing", ["org"], "a.bare or b.bare"),
]
#: Rules of lower confidence give no pairs of p5_found.
LEAST_CONFIDENCE = 0.5


#: What the rules look at. Records that are equal in it are one profile.
SEEN = ("sid", "org", "folded", "given", "line", "bare", "place", *FIELDS)


def described(live: DataFrame, stage: Stage) -> DataFrame:
    """``id, as_s1, as_cand, profile`` and what the rules look at of every record with a name; ``profile`` is the number of its spelling and place."""
    recs = stage.put("records", records(live, roles=True))
    named = recs.filter(F.col("name").isNotNull())
    orgs = stage.put("orgs", organisations(recs.select("name", "addr"), stage, keep_parts=True))
    places = locations(recs.filter(F.col("addr").isNotNull()).select("addr"), stage)
    full = named.join(orgs, "name").join(places, "addr", "left")
    full = full.withColumn("bare", F.col("place").isNull()).withColumns({c: F.coalesce(c, F.lit("")) for c in ("place", *FIELDS)})
    return stage.put("described", full.select("id", "as_s1", "as_cand", F.xxhash64("sid", "place").alias("profile"), *SEEN))


def profiles(about: DataFrame) -> DataFrame:
    """One row for each profile, its number as ``id``; on a side if one of its records is."""
    return about.groupBy(F.col("profile").alias("id"), *SEEN).agg(F.max("as_s1").alias("as_s1"), F.max("as_cand").alias("as_cand"))


def record_pairs(found: DataFrame, s1: DataFrame, cand: DataFrame) -> DataFrame:
    """``s1_id, cand_id, rule`` of the records ``id, profile`` of both sides, from pairs of profiles ``pa, pb, rule``."""
    one, two = s1.select(F.col("id").alias("s1_id"), F.col("profile").alias("pa")), cand.select(F.col("id").alias("cand_id"), F.col("profile").alias("pb"))
    return found.join(one, "pa").join(two, "pb").filter("s1_id <> cand_id").drop("pa", "pb")


def cascade(s1: DataFrame, cand: DataFrame, stage: Stage) -> DataFrame:
    """``s1_id, cand_id, rule``: each pair of rows of both sides with the number of the first rule that finds it."""
    found = None
    for number, (_, keys, test) in enumerate(RULES):
        a, b = s1.alias("a"), cand.alias("b")
        if keys == ["org"]:
            # one side has no address; each branch is an equi-join whose one side is only the records without
            hits = _ids(a.filter("a.bare").join(b, F.expr("a.org = b.org"))).unionByName(_ids(a.filter("not a.bare").join(b.filter("b.bare"), F.expr("a.org = b.org"))))
        else:
            real = " and ".join(f"{{0}}.{k} <> ''" for k in keys if k not in ("sid", "org", "given")) or "true"
            on = " and ".join(f"a.{k} = b.{k}" for k in keys)
            hits = _ids(a.filter(real.format("a")).join(b.filter(real.format("b")), F.expr(on)).filter(test))
        if found is not None:
            hits = hits.join(found, ["s1_id", "cand_id"], "left_anti")
        hits = stage.put(f"rule{number}", hits.withColumn("rule", F.lit(number)))
        found = hits if found is None else found.unionByName(hits)
    return found


def _ids(joined: DataFrame) -> DataFrame:
    return joined.select(F.col("a.id").alias("s1_id"), F.col("b.id").alias("cand_id"))


def confidences(found: DataFrame, s1: DataFrame, cand: DataFrame, known: DataFrame) -> DataFrame:
    """``rule, labelled, right, confidence`` of every rule: (right + 1) / (labelled + 2) over pairs of labelled source-1 records."""
    truth = match_lists(known).filter(F.col("m").isNotNull()).select(F.col("s1").alias("s1_id"), F.col("m").alias("cand_id")).distinct().withColumn("right", F.lit(1))
    entities = match_lists(known).select(F.col("s1").alias("id")).distinct()
    judged = record_pairs(found, s1.join(entities, "id", "left_semi"), cand).join(truth, ["s1_id", "cand_id"], "left")
    by = judged.groupBy("rule").agg(F.count(F.lit(1)).alias("labelled"), F.count("right").alias("right"))
    every = found.sparkSession.range(len(RULES)).select(F.col("id").cast("int").alias("rule"))
    return every.join(by, "rule", "left").fillna(0).withColumn("confidence", (F.col("right") + 1) / (F.col("labelled") + 2))


def same_establishment(live: DataFrame, known: DataFrame, stage: Stage) -> DataFrame:
    """``s1_id, cand_id, rule, confidence``. A record without a name pairs with nothing; without labels every rule has confidence
    one half. An empty table gives an empty result.

    Each pair of profiles goes through the cascade once, however many records have them; it becomes pairs of records at the end.
    """
    about = described(live, stage)
    alike = stage.put("profiles", profiles(about))
    found = cascade(alike.filter("as_s1"), alike.filter("as_cand"), stage).withColumnsRenamed({"s1_id": "pa", "cand_id": "pb"})
    s1, cand = about.filter("as_s1"), about.filter("as_cand")
    rules = confidences(found, s1, cand, known).select("rule", "confidence")
    return record_pairs(found.join(F.broadcast(rules), "rule"), s1, cand).select("s1_id", "cand_id", "rule", "confidence")
