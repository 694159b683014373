"""Term lists, count maps, labels, ratings, the author cache and model tables."""

from __future__ import annotations

import sqlite3

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corvane.functions.text import clean_author
from corvane.operators.evaluation import either
from corvane.operators.features import location_features


def load_terms(spark: SparkSession, path: str, keep_mark: bool = False) -> list[str]:
    """The lines of a term or pattern list, lower-cased; only line ends are stripped, as edge spaces count; blank lines go.

    A byte-order mark is dropped, unless keep_mark: then it stays part of the first term, which so hardly ever matches.
    A list is configuration of a few hundred lines; it is read to the driver.
    """
    lines = spark.read.text(path, wholetext=True).first()
    text = (lines[0] if lines else "") if keep_mark else (lines[0] if lines else "").removeprefix("﻿")
    return [t for line in text.split("\n") if (t := line.strip("\r").lower()).strip()]


def load_sides(spark: SparkSession, folder: str, group: str, sides: tuple[str, str], advanced: bool = False) -> list[tuple[str, list[str]]]:
    return [(side, load_terms(spark, f"{folder}/{group}_{side}{'_adv' if advanced else ''}.txt")) for side in sides]


#: Social groups and their sides, the marginalised first.
GROUPS = {"sexuality": ("gay", "straight"), "age": ("old", "young"), "weight": ("fat", "thin"), "ability": ("disabled", "abled"), "race": ("black", "white"), "skin_tone": ("dark", "light")}


def positive(counts: Column) -> Column:
    return F.map_filter(counts, lambda _, n: n > 0)


def json_counts(cell: Column) -> Column:
    """A JSON object of counts as a map of its positive whole numbers; null if it is none."""
    return positive(F.from_json(cell, "map<string,bigint>"))


def hour_counts(cell: Column) -> Column:
    """A map of hours as 'HH' for the hours 0 to 23 with positive counts."""
    hours = F.map_filter(cell, lambda h, n: (n > 0) & h.try_cast("int").between(0, 23))
    return F.transform_keys(hours, lambda h, _: F.lpad(h.cast("int").cast("string"), 2, "0"))


#: Where a line or row stands in its files: by path, then block, then in reading order, which Spark keeps within a block.
PLACE = "struct(_metadata.file_path, _metadata.file_block_start, monotonically_increasing_id()) AS place"


def read_counts(spark: SparkSession, path: str, columns: tuple[str, ...], prefix: str, training: bool = True, hours: bool = False, users: DataFrame | None = None) -> DataFrame:
    """(author, feature, cnt) from JSON lines with a map of counts under the first of `columns` that is there; the last line of an author counts.

    With `users` (author), only theirs are read on.
    """
    fields = ", ".join(f"{c} MAP<STRING,BIGINT>" for c in columns)
    rows = spark.read.schema(f"author STRING, {fields}").json(path).selectExpr("*", PLACE)
    counts = F.coalesce(*map(F.col, columns))
    rows = rows.select(clean_author(F.col("author"), training).alias("author"), (hour_counts(counts) if hours else positive(counts)).alias("counts"), "place").where("author <> ''")
    if users is not None:
        rows = rows.join(users.select("author").distinct(), "author", "left_semi")
    rows = rows.groupBy("author").agg(F.max_by("counts", "place").alias("counts"))
    return rows.select("author", F.explode("counts").alias("feature", "cnt")).withColumn("feature", F.concat(F.lit(prefix), "feature"))


def read_vocabulary(spark: SparkSession, path: str, users: DataFrame | None = None) -> DataFrame:
    """(author, feature, cnt) of word counts: JSON lines {author, vocab}, or a whole .json file that is a list of those or an object author -> vocab.

    A whole file is one record, as it can't be split; large vocabularies come as lines. Authors that repeat in a list are added up.
    """
    if path.lower().endswith(".jsonl"):
        return read_counts(spark, path, ("vocab",), "w:", training=False, users=users)
    whole = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", "array<struct<author:string,vocab:map<string,bigint>>>")
    named = F.transform(F.map_entries(F.from_json("value", "map<string,map<string,bigint>>")), lambda e: F.struct(e["key"].alias("author"), e["value"].alias("vocab")))
    rows = whole.select(F.inline(F.when(F.startswith(F.ltrim("value"), F.lit("[")), listed).otherwise(named)))
    rows = rows.select(clean_author(F.col("author")).alias("author"), F.explode(positive(F.col("vocab"))).alias("feature", "cnt")).where("author <> ''")
    if users is not None:
        rows = rows.join(users.select("author").distinct(), "author", "left_semi")
    return rows.groupBy("author", F.concat(F.lit("w:"), "feature").alias("feature")).agg(F.sum("cnt").alias("cnt"))


def geo_vocabulary(words: DataFrame, homes: DataFrame, *small: DataFrame) -> DataFrame:
    """(location, feature, cnt) of the training users (author, location) from their words and their small feature tables (subreddits, hours)."""
    parts = words
    for t in small:
        parts = parts.unionByName(t)
    return location_features(parts, homes)


def read_homes(spark: SparkSession, path: str, user_col: str = "author", place_col: str = "geohash_5", lower: bool = True) -> DataFrame:
    """(author, location) from a CSV; the last row of a user counts."""
    rows = spark.read.option("header", True).csv(path).selectExpr("*", PLACE)
    rows = rows.select(clean_author(F.col(user_col), lower).alias("author"), F.trim(place_col).alias("location"), "place").where("author <> '' AND location <> ''")
    return rows.groupBy("author").agg(F.max_by("location", "place").alias("location"))


def read_split_users(spark: SparkSession, path: str, id_col: str, candidates: list[str]) -> DataFrame:
    """(author, feature, cnt) of the users of a split's CSV, a row each."""
    return row_counts(spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path), id_col, candidates)


def write_split(rows: DataFrame, path: str) -> None:
    """Rows with a column `split`, a folder for each."""
    rows.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def read_split_items(spark: SparkSession, path: str, cast: str | None = None) -> DataFrame:
    """(item) of a split's file: the first cells of a CSV of users or texts, or the lines of a list of labels, cast if asked and possible."""
    if "label" in path.rpartition("/")[2]:
        item = F.trim("value")
        return spark.read.text(path).select((F.coalesce(item.try_cast(cast), F.lit(None).cast(cast)) if cast else item).alias("item"))
    rows = spark.read.option("multiLine", True).option("escape", '"').csv(path)
    return rows.select(F.col(rows.columns[0]).alias("item")).where("item IS NOT NULL")


def row_counts(rows: DataFrame, id_col: str, candidates: list[str]) -> DataFrame:
    """(author, feature, cnt): of the first candidate column that is a JSON object of counts; else of the other columns as a wide bag of words."""
    parsed = F.coalesce(*[json_counts(F.col(c)) for c in candidates if c in rows.columns], F.lit(None).cast("map<string,bigint>"))
    wide = [c for c in rows.columns if c not in (id_col, *candidates)]
    bag = F.map_from_arrays(F.array(*map(F.lit, wide)), F.array(*[F.col(c).try_cast("double").cast("bigint") for c in wide])) if wide else F.lit(None).cast("map<string,bigint>")
    return rows.select(F.col(id_col).alias("author"), F.explode(F.coalesce(parsed, positive(bag))).alias("feature", "cnt")).where("cnt > 0")


def display_names(rows: DataFrame, place: str, city: str, state: str) -> DataFrame:
    """(location, name): the most common of 'City, ST', the city or the place itself; ties by name."""
    name = F.when((F.coalesce(F.col(city), F.lit("")) != "") & (F.coalesce(F.col(state), F.lit("")) != ""), F.concat(city, F.lit(", "), state)).when(F.coalesce(F.col(city), F.lit("")) != "", F.col(city)).otherwise(F.col(place))
    each = rows.groupBy(F.col(place).alias("location"), name.alias("name")).agg(F.count("*").alias("n"))
    return each.withColumn("__n", F.row_number().over(Window.partitionBy("location").orderBy(F.desc("n"), "name"))).where("__n = 1").select("location", "name")


def read_ratings(spark: SparkSession, path: str, text_at: int = 1) -> DataFrame:
    """(doc_id, text, rating) of one rater's CSV; 'x' means 0. The rating is in the last column."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    doc, text, rating = rows.columns[0], rows.columns[text_at], rows.columns[-1]
    return rows.select(F.col(f"`{doc}`").try_cast("int").alias("doc_id"), F.trim(f"`{text}`").alias("text"), F.when(F.trim(f"`{rating}`") == "x", 0).otherwise(F.trim(f"`{rating}`").try_cast("int")).alias("rating")).where("doc_id IS NOT NULL")


def main_annotations(spark: SparkSession, folder: str, group: str, raters: int = 2) -> DataFrame:
    """(doc_id, text, label) of the raters' files: the first one's text; label 1 if any of them found the post relevant."""
    each = [read_ratings(spark, f"{folder}/relevance_sample_{group}_{k}_rated.csv") for k in range(raters)]
    return each[0].select("doc_id", "text").join(either(*each), "doc_id")


def retraining_annotations(spark: SparkSession, folder: str, group: str) -> DataFrame:
    """(doc_id, text, label) of the one file of further ratings, whose text is in the third column."""
    return read_ratings(spark, f"{folder}/{group}_retraining_sample_rated.csv", 2).withColumnRenamed("rating", "label")


def cache_from_sqlite(spark: SparkSession, path: str) -> DataFrame:
    """An author cache in SQLite as a table; for taking over an older cache, which one machine has held."""
    with sqlite3.connect(path) as db:
        rows = db.execute("SELECT author, location, updated_at FROM author_location").fetchall()
    return spark.createDataFrame(rows, "author string, location string, updated_at long")


def save_model(path: str, **tables: DataFrame) -> None:
    """The tables of a location model (params, overrides, vocab, priors), each as Parquet."""
    for name, rows in tables.items():
        rows.write.mode("overwrite").parquet(f"{path}/{name}")


def load_model(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables; without priors, locations are equally likely."""
    model = {name: spark.read.parquet(f"{path}/{name}") for name in ("params", "overrides", "vocab")}
    try:
        model["priors"] = spark.read.parquet(f"{path}/priors")
    except Exception as error:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(error):
            raise
        n = model["params"].count()
        model["priors"] = model["params"].select("location", F.lit(1.0 / max(1, n)).alias("prior"))
    return model
