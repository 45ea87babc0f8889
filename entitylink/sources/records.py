"""Record, ground-truth and result tables: Parquet or tab-separated text, and the tab-separated sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])


def read_tsv(spark: SparkSession, path: str | list[str], schema: T.StructType = RECORD) -> DataFrame:
    """A tab-separated file with a header and no quoting. Rows with too few fields are dropped: the last column is null there."""
    df = spark.read.schema(schema).csv(path, sep="\t", header=True, quote="", escape="", mode="PERMISSIVE")
    return df.filter(F.col(schema.names[-1]).isNotNull())


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """One source with nulls as empty strings, trimmed country, rows without a country dropped, one row per id: of a repeated id with
    differing texts the least of each."""
    raw = read_table(spark, sf_dir, f"source{number}")
    return (
        raw.filter(F.col("entity_id").isNotNull() & F.col("country").isNotNull())
        .select("entity_id", F.coalesce("business_name", F.lit("")).alias("business_name"), F.coalesce("business_address", F.lit("")).alias("business_address"), F.trim("country").alias("country"))
        .groupBy("entity_id").agg(*[F.min(c).alias(c) for c in ("business_name", "business_address", "country")])
    )


def id_items(c: Column) -> Column:
    """The ids of a comma list, trimmed, empty items dropped."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def id_list_pairs(df: DataFrame, owner: str, items: str, item_as: str = "cid", outer: bool = False) -> DataFrame:
    """``s1_id, cid`` from a comma list; with ``outer`` an owner with an empty list keeps one row with a null id."""
    spread = F.explode_outer if outer else F.explode
    return df.select(F.col(owner).alias("s1_id"), spread(F.array_distinct(id_items(F.col(items)))).alias(item_as))


def countries(s1: DataFrame) -> DataFrame:
    return s1.select("country").distinct()


def of_countries(records: DataFrame, s1: DataFrame) -> DataFrame:
    """Records whose country occurs in source 1. The countries go to the records: dealt out by country, a large one would be one task from here on."""
    return records.join(F.broadcast(countries(s1)), "country", "left_semi")


def candidate_pool(records: DataFrame, needed: DataFrame, cap: int) -> DataFrame:
    """All needed ids and the first ``cap`` others by id: a bounded pool for training, not for inference."""
    wanted = records.join(needed, "entity_id", "left_semi")
    others = records.join(needed, "entity_id", "left_anti").orderBy("entity_id").limit(cap)
    return wanted.unionByName(others)


def write_lists(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Owner and comma list as tab-separated text with a header, no quoting, empty lists as empty fields."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, sep="\t", header=True, quote="", emptyValue="")
