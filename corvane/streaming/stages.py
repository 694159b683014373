"""Stages over a stream of new post files: each file is read once, whatever fails or restarts in between."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_available(spark: SparkSession, source: str, schema: str, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_trigger: int = 100) -> None:
    """Runs a stage over the Parquet files of `source` that the checkpoint hasn't seen, and appends its rows to `out`."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    query = stage(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def run_batches(spark: SparkSession, source: str, schema: str, write: Callable[[DataFrame, int], None], checkpoint: str, files_per_trigger: int = 100) -> None:
    """The same with a function of a batch and its number, for stages that write more than one table."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
