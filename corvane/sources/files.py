"""Month files: finding those of some years, by listing through Spark, so that any store works."""

from __future__ import annotations

import re
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The prefixes of file names by kind.
PREFIX = {"comments": "RC", "submissions": "RS"}


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, name, year, month, length) of the files of a folder and those below it; contents aren't read."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder).select("path", "length")
    name = F.element_at(F.split("path", "/"), -1)
    part = lambda k: F.regexp_extract(name, r"(\d{4})-(\d{2})", k).try_cast("int")
    return rows.select("path", name.alias("name"), part(1).alias("year"), part(2).alias("month"), "length")


def month_files(files: DataFrame, kind: str, years: list[int]) -> dict[tuple[int, int], list[str]]:
    """The sorted paths of each month of the years; a month may have several. Raises FileNotFoundError if there is none at all.

    The listing is one row for each month file, so a driver can hold it.
    """
    kept = files.where(F.startswith("name", F.lit(PREFIX[kind])) & F.col("year").isin(years)).select("year", "month", "path")
    out: dict[tuple[int, int], list[str]] = defaultdict(list)
    for r in kept.orderBy("path").collect():
        out[r["year"], r["month"]].append(r["path"])
    if not out:
        raise FileNotFoundError(f"no {PREFIX[kind]} files of {years}")
    return dict(sorted(out.items()))


def missing_files(found: dict[tuple[int, int], list[str]], years: list[int]) -> list[str]:
    return [f"{y}-{m:02d}" for y in years for m in range(1, 13) if (y, m) not in found]


def to_do(found: dict[tuple[int, int], list[str]], done: set[str]) -> dict[tuple[int, int], list[str]]:
    """Without the months whose output stem (RC_2010-01) is done."""
    stem = lambda path: re.sub(r"\.[^/]*$", "", path.rpartition("/")[2])
    left = {month: [p for p in paths if stem(p) not in done] for month, paths in found.items()}
    return {month: paths for month, paths in left.items() if paths}


def job_slice(items: list, size: int, index: int) -> list:
    """The index-th slice of so many items, for schedulers that number their jobs; out of range raises IndexError."""
    if index < 0 or index * size >= max(1, len(items)):
        raise IndexError(f"job {index}: {len(items)} items make {-(-len(items) // size)} jobs")
    return items[index * size : (index + 1) * size]


def slug(text: str) -> str:
    return re.sub(r"[^a-z0-9]+", "-", str(text).lower()).strip("-")


def job_tag(resource: str, group: str, years: list[int]) -> str:
    return "_".join((slug(resource), slug(group), f"{years[0]}-{years[-1]}" if len(years) > 1 else str(years[0])))
