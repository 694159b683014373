"""Stratified annotation samples, exact splits and dedupe. Random choices order by a hash, so reruns agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hash_order(id_: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed), id_.cast("string")))


def first_by_id(rows: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def reservoir(rows: DataFrame, stratum: str, k: int, order: list) -> DataFrame:
    """The first k rows of each stratum. Spark keeps only k rows of each in every task before it shuffles."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(stratum).orderBy(*order))).where(F.col("__n") <= k).drop("__n")


def per_stratum(sample: int, strata: int) -> int:
    """How many rows each of the three kinds of sample takes from each stratum."""
    return sample // strata // 3


def stratified_sample(rows: DataFrame, stratum: str, count_col: str, id_col: str, k: int, seed: str = "sample:") -> DataFrame:
    """Top, bottom and random k of each stratum, with sample_type; ties go to the earlier id. A row may be in more than one."""
    kinds = (("top", [F.desc(count_col), id_col]), ("bottom", [F.asc(count_col), id_col]), ("random", [hash_order(F.col(id_col), seed), id_col]))
    parts = [reservoir(rows, stratum, k, order).withColumn("sample_type", F.lit(kind)) for kind, order in kinds]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def numbered(sample: DataFrame, order: list, start: int = 100_000) -> DataFrame:
    """Unique six-digit ids in the given order. The sample is a bounded table, so one window over it is fine."""
    return sample.withColumn("sample_id", F.row_number().over(Window.orderBy(*order)) + F.lit(start - 1))


def for_annotators(sample: DataFrame, annotators: list[str], id_col: str, seed: str = "shuffle:") -> DataFrame:
    """The same rows for each annotator, with each one's own shuffled position."""
    each = sample.withColumn("annotator", F.explode(F.array(*map(F.lit, annotators))))
    order = [F.md5(F.concat(F.lit(seed), "annotator", F.lit(":"), F.col(id_col).cast("string"))), id_col]
    return each.withColumn("position", F.row_number().over(Window.partitionBy("annotator").orderBy(*order)))


def write_annotators(sample: DataFrame, path: str, annotators: int = 2, file_col: str = "file", keywords_col: str = "keywords") -> None:
    """For each annotator a CSV of the shuffled rows (random_id, text) and one of their keys (random_id, file, original_id, keywords,
    sample_type). sample: (sample_id, text, id, sample_type, file and keywords); it is a bounded table, so each file is one task's."""
    named = for_annotators(sample, [f"annot{k}" for k in range(annotators)], "sample_id")
    keywords = F.col(keywords_col) if dict(sample.dtypes)[keywords_col] == "string" else F.array_join(keywords_col, ",")
    for k in range(annotators):
        own = named.where(F.col("annotator") == f"annot{k}").orderBy("position")
        key = own.select(F.col("sample_id").alias("random_id"), F.col(file_col).alias("file"), F.col("id").alias("original_id"), keywords.alias("keywords"), "sample_type")
        for rows, name in ((own.select(F.col("sample_id").alias("random_id"), "text"), f"annot{k}"), (key, f"annot{k}_key")):
            rows.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/{name}")


def exact_split(rows: DataFrame, id_col: str, parts: tuple[tuple[str, float], ...] = (("train", 0.8), ("valid", 0.1)), rest: str = "test", seed: str = "split:") -> DataFrame:
    """Splits of exact sizes floor(p n), in hash order; the rest goes to the last.

    The rank of a hash is found in two steps, so that no task sorts the whole table: sizes of the 4096 buckets of its first
    three digits, and the place within a bucket.
    """
    keyed = rows.withColumn("__key", hash_order(F.col(id_col), seed)).withColumn("__bucket", F.substring("__key", 1, 3))
    sizes = keyed.groupBy("__bucket").agg(F.count("*").alias("__size"))
    starts = sizes.select("__bucket", (F.sum("__size").over(Window.orderBy("__bucket")) - F.col("__size")).alias("__before"), F.sum("__size").over(Window.partitionBy()).alias("__all"))
    ranked = keyed.join(F.broadcast(starts), "__bucket").withColumn("__rank", F.row_number().over(Window.partitionBy("__bucket").orderBy("__key", id_col)) + F.col("__before"))
    edges, total = [], F.lit(0)
    for name, p in parts:
        total = total + F.floor(F.col("__all") * F.lit(p))
        edges.append((name, total))
    split = F.lit(rest)
    for name, edge in reversed(edges):
        split = F.when(F.col("__rank") <= edge, name).otherwise(split)
    return ranked.withColumn("split", split).drop("__key", "__bucket", "__before", "__all", "__rank")
