"""Checks of result files: each rule is a table of offending rows or ids; the report counts them and shows a few."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.records import id_items

HEADERS = {"matching": ["source1_entity_id", "matched_entity_ids"], "candidate": ["source1_entity_id", "candidate_entity_ids"]}


def check_header(first_line: str | None, kind: str) -> list[str]:
    """Messages about the first line of a file; none if it is right."""
    if first_line is None or not first_line.strip("\r\n"):
        return ["file is empty"]
    if "\t" not in first_line and "," in first_line:
        return ["header is separated by commas, not tabs"]
    found = [c.strip().lower() for c in first_line.rstrip("\r\n").split("\t")]
    return [] if found == HEADERS[kind] else [f"header must be {HEADERS[kind]}, is {found}"]


def malformed(lines: DataFrame) -> DataFrame:
    """``value`` of non-blank lines without a tab."""
    return lines.filter((F.trim("value") != "") & (F.instr("value", "\t") == 0)).select("value")


def duplicate_rows(df: DataFrame, owner: str) -> DataFrame:
    return df.groupBy(F.col(owner).alias("s1_id")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def repeated_items(df: DataFrame, owner: str, items: str) -> DataFrame:
    x = id_items(F.col(items))
    return df.select(F.col(owner).alias("s1_id"), (F.size(x) - F.size(F.array_distinct(x))).alias("extra")).filter("extra > 0")


def bad_prefix(df: DataFrame, owner: str, items: str) -> DataFrame:
    """``s1_id, cid, rule``: ids of source 1 in a list, and ids of no known source."""
    item = df.select(F.col(owner).alias("s1_id"), F.explode(id_items(F.col(items))).alias("cid"))
    rule = F.when(F.col("cid").startswith("S1-"), "self_match").when(~F.col("cid").startswith("S2-") & ~F.col("cid").startswith("S3-"), "bad_prefix")
    return item.withColumn("rule", rule).filter("rule is not null").distinct()


def unknown_ids(df: DataFrame, owner: str, items: str, known: DataFrame) -> DataFrame:
    item = df.select(F.explode(id_items(F.col(items))).alias("cid")).distinct()
    return item.join(known.select(F.col("entity_id").alias("cid")), "cid", "left_anti")


def missing(df: DataFrame, owner: str, required: DataFrame) -> DataFrame:
    return required.select(F.col("entity_id").alias("s1_id")).distinct().join(df.select(F.col(owner).alias("s1_id")), "s1_id", "left_anti")


def unexpected(df: DataFrame, owner: str, required: DataFrame) -> DataFrame:
    return df.select(F.col(owner).alias("s1_id")).distinct().join(required.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_anti")


def not_candidates(df: DataFrame, owner: str, items: str, listed: DataFrame) -> DataFrame:
    """``s1_id, cid`` of matches that the candidate lists (pairs ``s1_id, cid``) don't hold."""
    item = df.select(F.col(owner).alias("s1_id"), F.explode(id_items(F.col(items))).alias("cid")).distinct()
    return item.join(listed, ["s1_id", "cid"], "left_anti")


def counters(df: DataFrame, items: str) -> DataFrame:
    """``rows, empty_lists, ids`` of a result file."""
    n = F.size(id_items(F.col(items)))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(n == 0).alias("empty_lists"), F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("ids"))


def exit_status(found: DataFrame) -> int:
    """1 if a report holds an error, 0 if it holds warnings only or nothing."""
    return 0 if found.filter("severity = 'error'").isEmpty() else 1


def report(df: DataFrame, owner: str, items: str, required: DataFrame, known: DataFrame, examples: int = 5, listed: DataFrame | None = None, lines: DataFrame | None = None) -> DataFrame:
    """``rule, severity, n, examples``: every rule with its count and the first offending ids in order. With candidate pairs, matches
    outside them give a warning; with the file's lines, lines without a tab give an error."""
    parts = {
        "duplicate_row": duplicate_rows(df, owner).select(F.col("s1_id").alias("id")), "repeated_item": repeated_items(df, owner, items).select(F.col("s1_id").alias("id")).distinct(),
        "missing": missing(df, owner, required).select(F.col("s1_id").alias("id")), "unexpected": unexpected(df, owner, required).select(F.col("s1_id").alias("id")),
        "unknown": unknown_ids(df, owner, items, known).select(F.col("cid").alias("id")),
    }
    if listed is not None:
        parts["match_not_candidate"] = not_candidates(df, owner, items, listed).select(F.concat_ws(":", "s1_id", "cid").alias("id"))
    if lines is not None:
        parts["malformed"] = malformed(lines).select(F.substring("value", 1, 60).alias("id"))
    every = bad_prefix(df, owner, items).select("rule", F.col("cid").alias("id")).distinct()
    for rule, part in parts.items():
        every = every.unionByName(part.select(F.lit(rule).alias("rule"), "id"))
    turn = F.row_number().over(Window.partitionBy("rule").orderBy("id"))
    counts = every.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    shown = every.withColumn("turn", turn).filter(F.col("turn") <= examples).groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("examples"))
    return counts.join(shown, "rule").select("rule", F.when(F.col("rule") == "match_not_candidate", "warning").otherwise("error").alias("severity"), "n", "examples")
