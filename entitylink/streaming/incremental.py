"""Matching of source-1 files as they arrive against a fixed candidate side."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import api
from ..operators import index
from ..sources.records import RECORD


def arriving(spark: SparkSession, folder: str, fmt: str = "parquet") -> DataFrame:
    """A stream of source-1 records from a folder."""
    reader = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 8)
    return reader.option("sep", "\t").option("header", True).option("quote", "").csv(folder) if fmt == "tsv" else reader.format(fmt).load(folder)


def match_stream(stream: DataFrame, others: DataFrame, model: PipelineModel, threshold: float, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Writes matches of each micro-batch below ``out``, one folder a batch, so a batch that is run again replaces its own rows.
    The candidate side is cleaned once, before the first batch, and kept for all of them."""
    pool = index.cleaned(others).persist()

    def step(batch: DataFrame, number: int) -> None:
        s1 = batch.dropDuplicates(["entity_id"]).na.fill("")
        matches, _ = api.match(s1, index.cleaned(s1), pool, model, threshold)
        matches.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
