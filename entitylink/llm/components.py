"""Connected components of a match graph by hash-to-min."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Stage


#: Members of one holder from which its set is split over several tasks.
HOT_SET = 1_000_000


def _retire(sets: DataFrame, stage: Stage, turn: int) -> tuple[DataFrame, DataFrame]:
    """The relation without the vertices whose only partner, in either column, is a smaller one; and these with that partner.

    Such a vertex has the group of its partner whatever comes later, so it takes no part in further rounds.
    """
    ends = sets.select(F.inline(F.array(F.struct(F.col("h").alias("v"), F.col("m").alias("o")), F.struct(F.col("m").alias("v"), F.col("h").alias("o")))))
    # ``least`` and ``most`` combine map-side: a vertex with many partners costs one row a partition
    alone = ends.groupBy("v").agg(F.min("o").alias("least"), F.max("o").alias("most")).filter("least = most and least < v")
    leaves = stage.put(f"leaves{turn}", alone.select("v", F.col("least").alias("to")))
    # a leaf's rows are (leaf, partner) and (partner, leaf): both go with one anti-join on the larger end
    rest = sets.withColumn("v", F.greatest("h", "m")).join(leaves.select("v"), "v", "left_anti").select("h", "m")
    return stage.put("sets", rest), leaves


def _with_least(sets: DataFrame, low: DataFrame) -> DataFrame:
    """Each row of the sets with the least vertex of its holder; sets of more than HOT_SET members are spread over several tasks."""
    hot = low.filter(F.col("n") > HOT_SET).select("h", F.ceil(F.col("n") / HOT_SET).alias("parts"))
    if hot.isEmpty():
        return sets.join(low.select("h", "low"), "h")
    part = lambda of: F.pmod(of, F.coalesce("parts", F.lit(1)))
    left = sets.join(hot, "h", "left").withColumn("part", part(F.xxhash64("m"))).drop("parts")
    right = low.join(hot, "h", "left").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1)))
    return left.join(right.select("h", "low", "part"), ["h", "part"]).drop("part")


def hash_to_min(edges: DataFrame, vertices: DataFrame, stage: Stage, a: str = "a", b: str = "b", vertex: str = "v", max_rounds: int = 60) -> DataFrame:
    """``vertex, group``: every vertex with the smallest vertex that it is linked to directly or indirectly.

    Each vertex holds a cluster set, first itself and its neighbours. In a round it sends the whole set to the set's
    smallest member and that member to all others. The sets are kept as rows (holder, member), never as arrays, so a set
    as large as the graph is spread over all tasks; the minimum is combined map-side. Before each round, vertices that only one
    smaller vertex knows are retired with a pointer to it; a component that is settled consists of such vertices only, so the
    loop ends when no row is left. At the end the pointers are followed from the last round to the first. Edges with a null end
    are ignored, self-loops and repeated edges change nothing, vertices without edges are their own group.
    """
    e = edges.select(F.col(a).alias("h"), F.col(b).alias("m")).filter("h is not null and m is not null and h <> m")
    sets, leaves = _retire(e.select(F.least("h", "m").alias("h"), F.greatest("h", "m").alias("m")).distinct(), stage, 0)
    retired = [leaves]
    for turn in range(1, max_rounds):
        if sets.isEmpty():
            break
        if turn == 1:
            sets = sets.unionByName(sets.select(F.col("m").alias("h"), F.col("h").alias("m")))
        low = stage.put("low", sets.groupBy("h").agg(F.min("m").alias("least_m"), F.count(F.lit(1)).alias("n")).select("h", F.least("h", "least_m").alias("low"), "n"))
        told = _with_least(sets, low)
        # the whole set, with the holder itself, goes to the least member; the least member goes to all of the set
        sent = (
            told.select(F.inline(F.array(F.struct(F.col("low").alias("h"), F.col("m")), F.struct(F.col("m").alias("h"), F.col("low").alias("m")))))
            .unionByName(low.select(F.inline(F.array(F.struct(F.col("low").alias("h"), F.col("h").alias("m")), F.struct(F.col("h"), F.col("low").alias("m"))))))
            .filter("h <> m")
            .distinct()
        )
        sets, leaves = _retire(stage.put("sent", sent), stage, turn)
        retired.append(leaves)
    else:
        raise RuntimeError(f"components are not stable after {max_rounds} rounds")
    found = None
    for leaves in reversed(retired):
        here = leaves.select(F.col("v").alias("vertex"), F.col("to").alias("group"))
        if found is not None:
            here = here.alias("x").join(found.alias("y"), F.expr("x.group = y.vertex"), "left").select("x.vertex", F.coalesce("y.group", "x.group").alias("group"))
            here = here.unionByName(found)
        found = stage.put("found", here)
    known = vertices.select(F.col(vertex).alias("vertex")).filter("vertex is not null").distinct()
    return known.join(found, "vertex", "left").select("vertex", F.coalesce("group", "vertex").alias("group"))


def match_lists(results: DataFrame) -> DataFrame:
    """``s1, m``: one row per id of a list, ids trimmed and in upper case, empty items dropped; a null ``m`` keeps an S1 id with an empty or null list."""
    clean = lambda c: F.upper(F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))
    items = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), clean), lambda x: x != "")
    return results.select(clean(F.col("source1_entity_id")).alias("s1"), F.explode_outer(F.array_distinct(items)).alias("m"))


def match_groups(results: DataFrame, stage: Stage) -> DataFrame:
    """``entity_id, group_id``: one row per id in either column of ``matching_results``.

    All rows and runs count. A null or blank S1 id is no vertex, the ids of its list still are.
    """
    pairs = stage.put("pairs", match_lists(results).withColumn("s1", F.nullif("s1", F.lit(""))).distinct())
    vertices = pairs.select(F.explode(F.array("s1", "m")).alias("v"))
    found = hash_to_min(pairs, vertices, stage, "s1", "m")
    return found.select(F.col("vertex").alias("entity_id"), F.col("group").alias("group_id"))


def group_matches(spark: SparkSession, results: DataFrame) -> DataFrame:
    return match_groups(results, Stage(spark, "p4"))
