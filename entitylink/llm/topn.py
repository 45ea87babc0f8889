"""Top N items within every group, with a total order as the tie rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(items: DataFrame, group: list[str], order: list[Column], n: int, rank_as: str = "position") -> DataFrame:
    """The first ``n`` rows of each group in the given order, with their position from 1.

    ``row_number`` with a bound lets the optimiser put a group limit before the shuffle, so that each input partition
    sends at most ``n`` rows of a group, however many rows the group has. The order should be total; equal rows are
    otherwise kept in any order. Rows whose group is null form one group. An empty table gives an empty result.
    """
    return items.withColumn(rank_as, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col(rank_as) <= n)


def best_candidates(live: DataFrame, n: int = 5) -> DataFrame:
    """``s1_id, cand_id, blocking_score, blocking_rank, position``: the ``n`` best candidates of each S1 record.

    Rows with a null id, or a null or NaN score, are left out. A candidate counts once with its highest score and, among
    its rows with that score, its lowest non-null rank. Order: score descending, rank ascending with null last,
    ``cand_id`` ascending.
    """
    scored = live.select("s1_id", "cand_id", "blocking_score", "blocking_rank").filter(
        F.col("s1_id").isNotNull() & F.col("cand_id").isNotNull() & F.col("blocking_score").isNotNull() & ~F.isnan("blocking_score")
    )
    by_score = [F.desc("blocking_score"), F.asc_nulls_last("blocking_rank")]
    single = top_n(scored, ["s1_id", "cand_id"], by_score, 1, "turn").drop("turn")
    return top_n(single, ["s1_id"], [*by_score, F.asc("cand_id")], n)
