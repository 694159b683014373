"""Completeness checks of month partitions, resuming, and stage counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.sources.scratch import written


def years_of(text: str, first: int = 2007, last: int = 2023) -> list[int]:
    """'2010' or '2010-2012' as years, which must lie in the supported range."""
    ends = [int(x) for x in str(text).split("-")]
    if len(ends) > 2 or ends[0] > ends[-1] or ends[0] < first or ends[-1] > last:
        raise ValueError(f"years {text!r}: one year or first-last, within {first}-{last}")
    return list(range(ends[0], ends[-1] + 1))


def expected_months(spark: SparkSession, years: list[int]) -> DataFrame:
    return spark.range(len(years) * 12).select((F.element_at(F.array(*map(F.lit, years)), (F.col("id") / 12).cast("int") + 1)).alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month"))


def missing_months(rows: DataFrame, time: Column, years: list[int]) -> DataFrame:
    """(year, month) of the years without a row."""
    there = rows.select(F.year(time).alias("year"), F.month(time).alias("month")).distinct()
    return expected_months(rows.sparkSession, years).join(there, ["year", "month"], "left_anti")


def with_source_row(rows: DataFrame, file: str, order: list) -> DataFrame:
    """The 1-based number of each row in its file.

    Rows are range-sorted by file and order and written once; a row's number is its place in its part plus the sizes of the file's
    parts before. So a large file is numbered by many tasks. Parts are a few for each task; their sizes alone are summed in one window.
    """
    place = F.monotonically_increasing_id() % (1 << 33)
    parts = written(rows.orderBy(file, *order).select("*", F.spark_partition_id().alias("__part"), place.alias("__at")), "sorted")
    sizes = parts.groupBy(F.col(file).alias("__file"), F.col("__part").alias("__of")).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy("__file").orderBy("__of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__file", "__of", (before - F.col("__first") + 1).alias("__start"))
    joined = parts.join(starts, parts[file].eqNullSafe(starts["__file"]) & (parts["__part"] == starts["__of"]))
    return joined.withColumn("source_row", F.col("__at") + F.col("__start")).drop("__part", "__at", "__file", "__of", "__start")


def resumed(rows: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The rows that a stage hasn't written yet."""
    return rows.join(done.select(*keys), keys, "left_anti")


def stage_counts(rows: DataFrame, passed: Column, by: list[str]) -> DataFrame:
    """total, passed and missing rows."""
    return rows.groupBy(*by).agg(F.count("*").alias("total"), F.count_if(passed).alias("passed"), F.count_if(F.col("text").isNull()).alias("missing"))
