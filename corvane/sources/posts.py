"""Posts: raw NDJSON dumps, curated CSV files, and the view of posts over the synthetic tables."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from corvane.functions.text import clean_author, comment_text, feature_text, parent_id, post_time, submission_text, without_nul

RAW_COMMENT = "id STRING, parent_id STRING, body STRING, author STRING, created_utc STRING, subreddit STRING, score BIGINT"
RAW_SUBMISSION = "id STRING, title STRING, selftext STRING, author STRING, created_utc STRING, subreddit STRING, score BIGINT"
#: The base columns of a curated file, as files name them and as the engine does.
CURATED = (("id", "id"), ("parent id", "parent_id"), ("text", "text"), ("author", "author"), ("time", "time"), ("subreddit", "subreddit"), ("score", "score"), ("matched patterns", "matched_patterns"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, text, lang, subreddit, author, time) of documents and the events of the same number."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    joined = docs.join(events, docs["doc_id"] == events["event_id"])
    return joined.select(F.col("doc_id").alias("id"), "text", "lang", F.col("source").alias("subreddit"), F.concat(F.lit("u"), "user_id").alias("author"), F.col("ts").alias("time"))


class ZstdLines(DataSource):
    """format("lines_zst"): (value, file), the lines of zstd frames of any window up to 2 GiB, one partition for each file of option "paths"
    (a JSON list of paths or URIs of any store that Arrow reads). Frames can't be entered in the middle, so a file is one task, read as a
    stream; convert large months once to Parquet. Bytes that are no UTF-8 are left out."""

    @classmethod
    def name(cls) -> str:
        return "lines_zst"

    def schema(self) -> str:
        return "value STRING, file STRING"

    def reader(self, schema: StructType) -> DataSourceReader:
        return ZstdLinesReader(json.loads(self.options["paths"]))


class ZstdLinesReader(DataSourceReader):
    #: Lines of an Arrow batch.
    BATCH = 8192

    def __init__(self, paths: list[str]) -> None:
        self.paths = paths

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition):
        import io
        from itertools import batched

        import pyarrow as pa
        import zstandard
        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(partition.value)
        name = path.rpartition("/")[2]
        with store.open_input_stream(path, compression=None) as f, zstandard.ZstdDecompressor(max_window_size=2**31).stream_reader(f, read_across_frames=True) as stream:
            lines = (line.rstrip("\n") for line in io.TextIOWrapper(stream, encoding="utf-8", errors="ignore", newline="\n"))
            for held in batched(lines, self.BATCH):
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array([name] * len(held), pa.string())], ["value", "file"])


def raw_posts(spark: SparkSession, paths: list[str], kind: str = "comments", large_windows: bool = False, quarantine: str | None = None) -> DataFrame:
    """Raw posts with the file they are from. Spark decodes zstd itself; frames of over 128 MiB windows need `large_windows`.

    Lines that don't parse are left out; with `quarantine` they are appended to the table at that path, with their file.
    """
    schema = RAW_COMMENT if kind == "comments" else RAW_SUBMISSION
    if large_windows:
        spark.dataSource.register(ZstdLines)
        lines = spark.read.format("lines_zst").option("paths", json.dumps(paths)).load()
    else:
        lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file"))
    good, bad = quarantined(lines, schema)
    if quarantine:
        bad.write.mode("append").parquet(quarantine)
    return good


def quarantined(lines: DataFrame, schema: str) -> tuple[DataFrame, DataFrame]:
    """Of JSON lines (value, file): the parsed rows, and the lines that don't parse, with their file."""
    parsed = lines.withColumn("__row", F.from_json("value", schema + ", __broken STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__broken"}))
    whole = F.col("__row").isNotNull() & F.col("__row.__broken").isNull() & F.startswith(F.ltrim("value"), F.lit("{"))
    return parsed.where(whole).select("file", "__row.*").drop("__broken"), parsed.where(~F.coalesce(whole, F.lit(False))).select("file", F.col("value").alias("line"))


def normalised(raw: DataFrame, kind: str = "comments") -> DataFrame:
    """The base columns of a curated post, without matched_patterns."""
    text = comment_text(F.col("body")) if kind == "comments" else submission_text(F.col("title"), F.col("selftext"))
    parent = parent_id(kind, F.col("parent_id") if kind == "comments" else F.lit(""))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return raw.select(empty("id"), parent.alias("parent_id"), text.alias("text"), empty("author"), post_time(F.col("created_utc")).alias("time"), empty("subreddit"), F.coalesce("score", F.lit(0)).alias("score"))


def read_curated(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Curated CSV files: a byte-order mark, quoted line feeds and doubled quotes are handled, NUL characters dropped; rows without text go."""
    rows = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(paths)
    names = dict(CURATED)
    rows = rows.select(*[without_nul(F.col(f"`{c}`")).alias(names.get(c, c)) for c in rows.columns])
    return rows.where(F.col("text").isNotNull()) if "text" in rows.columns else rows


def write_curated(rows: DataFrame, path: str) -> None:
    """CSV with the files' own column names; nulls as empty cells."""
    names = {own: name for name, own in CURATED}
    out = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(names.get(c, c)) for c in rows.columns])
    out.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def feature_posts(raw: DataFrame, kind: str = "comments") -> DataFrame:
    """(id, author, text, subreddit, time) of raw posts for author features: the text keeps its case."""
    missing = F.lit(None).cast("string")
    text = feature_text(kind, F.col("body"), missing, missing) if kind == "comments" else feature_text(kind, missing, F.col("title"), F.col("selftext"))
    return raw.select("id", clean_author(F.col("author")).alias("author"), text.alias("text"), "subreddit", post_time(F.col("created_utc")).alias("time"))


def write_stage(rows: DataFrame, path: str, keys: tuple[str, ...] = ("year", "month"), append: bool = False) -> None:
    """A stage's table, partitioned by month; only the months at hand are replaced, or, on resuming, added to."""
    if append:
        rows.write.mode("append").partitionBy(*keys).parquet(path)
        return
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
