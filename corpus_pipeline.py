"""The corpus pipeline: language ID, near-dedup, decontamination, mixing, packing. Each stage works on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corvane.llm import decontaminate, language, mixing, near_dup, packing
from corvane.llm.common import scratch_folder, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or unlike every learned language, go."""
    return language.in_a_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document of the least id stays."""
    return near_dup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as their source's target asks, in the order of training positions."""
    return mixing.curriculum(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids with cumulative segment lengths and position resets."""
    return packing.packed(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination), ("mix", mix), ("pack", pack)]

#: None: SQL can express neither the language model nor the signatures nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents; each stage's rows are written as Parquet in the shared folder and read again."""
    docs, base = table(spark, sf_dir, "documents"), scratch_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
