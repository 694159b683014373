"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.sources.scratch import application_folder, scratch_folder, written

#: Maps a UTF-8 byte to itself if it belongs to a word, A-Z to a-z and every other byte to a space.
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))

__all__ = ["WORD_BYTES", "blocks", "free_name", "lean", "mix64", "once", "scratch_folder", "settled", "table", "unit", "words_of", "written"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken, out = {c.lower() for f in frames for c in f.columns}, f"__{name}"
    while out.lower() in taken:
        out += "_"
    return out


def lean(run: Callable) -> Callable:
    """run, a function from the batches of a task to its results, which at the end gives freed memory back to the system.

    Spark keeps Python workers idle beside later stages; allocators would keep what the largest batch took, on top of a full JVM.
    """

    @wraps(run)
    def whole(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library only
            trim(0)

    return whole


def words_of(text: str | None) -> list[bytes]:
    """The maximal runs of 0-9, a-z and non-ASCII after lower-casing A-Z, as UTF-8."""
    return [] if text is None else text.encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and written to the shared checkpoint folder: later readers survive the loss of any executor."""
    application_folder(df.sparkSession)  # sets the checkpoint folder where it is unset
    return df.checkpoint(eager=True)


def once(rows: DataFrame, name: str) -> DataFrame:
    """rows, but equal ones only once. Their hashes are dealt out, and whole rows only where a hash is met again."""
    own = free_name("hash", rows)
    hashed = rows.withColumn(own, F.xxhash64(*rows.columns))
    again = written(hashed.groupBy(own).count().where("count > 1").select(own), name)
    return hashed.join(again, own, "left_anti").unionByName(hashed.join(again, own, "left_semi").distinct()).drop(own)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over uint64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def unit(x: np.ndarray) -> np.ndarray:
    """Doubles in (0, 1] from uint64."""
    return ((x >> np.uint64(11)).astype(np.float64) + 1.0) * (1.0 / 9007199254740992.0)


def blocks(lengths, most: int):
    """Slices (start, stop) of consecutive items whose lengths add up to at most `most`; a longer item stands alone."""
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if len(lengths) > start:
        yield start, len(lengths)
