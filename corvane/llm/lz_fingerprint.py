"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases: from left to right, each phrase is the shortest stretch of bytes that is not yet in the
dictionary, and joins it. Phrases are hashed, and the `SIZE` least hashes are the fingerprint. The least SIZE hashes of two
fingerprints together are a random sample of the phrases of both texts, and the part of the sample that both hold estimates the
Jaccard similarity of their phrase sets, which follows how well one text compresses the other.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import mix64

SIZE = 128
#: Documents of one run of neighbours that are sorted and read by one task.
RUN_ROWS, MOST_RUNS = 256, 20_000


class Parse:
    """A dictionary of phrases as a trie, and the place in it that the bytes read so far have led to.

    Nodes are numbered as they are made, the root is 0; `made` holds, in that order, each node's parent times 256 plus its byte.
    """

    def __init__(self, made: dict[int, int] | None = None, node: int = 0) -> None:
        self.made, self.node = made or {}, node

    def read(self, data: bytes) -> Parse:
        made, get, node = self.made, self.made.get, self.node
        n = len(made)
        for byte in data:
            key = node << 8 | byte
            node = get(key)
            if node is None:  # a new phrase ends here
                n += 1
                made[key] = n
                node = 0
        self.node = node
        return self

    def fork(self) -> Parse:
        return Parse(self.made.copy(), self.node)

    def fingerprint(self) -> np.ndarray:
        """The SIZE least distinct 32-bit hashes of the phrases, ascending; all of them if they are fewer."""
        keys = np.concatenate([[0], np.fromiter(self.made, np.int64, len(self.made))])
        up, value, power = keys >> 8, (keys & 255).astype(np.uint64) + np.uint64(1), 0xD1342543DE82EF95
        value[0] = 0
        while up.any():  # a polynomial over the path to the root, whose known part doubles each time
            value = value + value[up] * np.uint64(power)
            up, power = up[up], power * power % (1 << 64)
        return np.unique(mix64(value[1:]) >> np.uint64(32))[:SIZE].astype(np.uint32)


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def fingerprint(text: str | None) -> np.ndarray:
    return Parse().read(encoded(text)).fingerprint()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated Jaccard similarity of two phrase sets; of two empty ones 1."""
    least = np.union1d(a, b)[:SIZE]
    if not len(least):
        return 1.0
    both = np.isin(least, a, assume_unique=True) & np.isin(least, b, assume_unique=True)
    return float(both.sum()) / len(least)


def written_out(prints: np.ndarray) -> str:
    return prints.astype(">u4").tobytes().hex()


def read_back(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u4").astype(np.uint32)


def fingerprinted(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with a column fingerprint: hexadecimal, 8 digits a hash; "" for a null or empty text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([written_out(fingerprint(t.as_py())) for t in batch], pa.string())

    return docs.withColumn("fingerprint", F.arrow_udf(run, "string")(F.col(text_col)))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(run, id, text, is_end): runs of neighbours by descending id, each closed by a copy (is_end) of the row that follows it; the last by the first of all.

    The runs are cut at ids that occur, found by approximate percentiles; so the row that follows a run is the one at the next
    cut, and it alone is copied. One shuffle deals the runs out; no order over the whole table is taken in one task.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n, top = rows.agg(F.count("*"), F.max("id")).first()
    runs = min(MOST_RUNS, max(1, math.ceil(n / RUN_ROWS)))
    inner = rows.agg(F.percentile_approx("id", [k / runs for k in range(1, runs)], 10 * runs)).first()[0] if runs > 1 and top is not None else []
    cuts = np.array(sorted({*inner, top} - {None}), np.int64)  # run k holds the ids above cuts[k - 1] up to cuts[k]; null ids are in run 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            missing = batch.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            run = np.where(missing, 0, np.searchsorted(cuts, ids))
            ends = np.flatnonzero(~missing & (cuts[np.minimum(run, len(cuts) - 1)] == ids)) if len(cuts) else np.empty(0, np.int64)
            take = np.concatenate([np.arange(len(ids)), ends])
            is_end = np.arange(len(take)) >= len(ids)
            run = np.concatenate([run, (run[ends] + 1) % max(1, len(cuts))])
            if not len(cuts) and len(ids):  # ids are all null: any row may be the first
                take, is_end, run = np.concatenate([take, take]), np.repeat([False, True], len(ids)), np.zeros(2 * len(ids), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(run.astype(np.int32)), batch.column(0).take(pa.array(take)), batch.column(1).take(pa.array(take)), pa.array(is_end)], ["run", "id", "text", "is_end"])

    dealt = rows.mapInArrow(deal, "run int, id long, text string, is_end boolean")
    return dealt.repartition("run").sortWithinPartitions("run", "is_end", F.col("id").desc_nulls_last(), "text")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    before = None  # run, id, text, its parse up to the middle, fingerprint
    for batch in batches:
        out = []
        for run, name, text, is_end in zip(*(batch.column(k) for k in range(4)), strict=True):
            run, name, text = run.as_py(), name.as_py(), text.as_py()
            if before is None and is_end.as_py():
                continue  # another copy of the end
            kept = len(text) - len(text) // 2
            middle = Parse().read(encoded(text[:kept]))
            prints = middle.fork().read(encoded(text[kept:])).fingerprint()
            if before is not None and before[0] == run:
                _, own, whole, own_middle, own_prints = before
                half = len(whole) // 2
                edited = whole[: len(whole) - half] + text[:half]
                edited_prints = own_middle.read(encoded(text[:half])).fingerprint()
                out.append((own, len(whole), hashlib.sha256(encoded(edited)).hexdigest(), written_out(own_prints), written_out(edited_prints), likeness(own_prints, edited_prints), likeness(own_prints, prints)))
            before = None if is_end.as_py() else (run, name, text, middle, prints)
        yield pa.RecordBatch.from_arrays([pa.array(list(x), kind) for x, kind in zip(zip(*out, strict=True) if out else [()] * 7, KINDS, strict=True)], NAMES)


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def report(docs: DataFrame) -> DataFrame:
    """One row for each document: its fingerprint, that of its edited text, and how like they and the next document's are.

    The next document is that of the next lower id, after the last the first; rows of one id go by their text, null ids last.
    The edited text has the last half (rounded down) of the code points replaced by as many from the start of the next
    document, or all it has. Null texts are empty; a lone document is its own next. An empty table gives no rows.
    """
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return with_next(docs, "doc_id", "text").mapInArrow(_compare, schema)
