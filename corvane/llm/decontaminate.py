"""Benchmark decontamination: a broadcast hash set of the benchmark's word n-grams, looked up in every window of every document.

Words are the runs of 0-9, a-z and non-ASCII after lower-casing A-Z. A window is `width` consecutive words of an item; an item
of fewer words, but not none, is one window. A document's word is hit if it is inside an occurrence of a window.

The benchmark's windows go to the executors as sorted hashes with their places in the items' words; a hash that is met is verified
word by word. A benchmark of more than `most_chars` characters is split by hash of its rows into as many parts as keep each part
near that size. The documents are scanned once for each part, and each scan is written before the next part is broadcast; so
what the driver and a worker hold at once never exceeds the bound, give or take the hash and the longest item.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import blocks, free_name, lean, mix64, words_of, written

#: Of the benchmark's characters that are held at once, 8 million take about 60 MB, and 240 MB if no word recurs.
WIDTH, MOST_CHARS, CHARS = 10, 8_000_000, 4_000_000
POWERS = [np.uint64(pow(0xD1342543DE82EF95, j + 1, 1 << 64)) for j in range(64)]
HITS = "struct<n_words:bigint,hits:array<struct<start:int,stop:int>>,items:array<string>,contaminated:boolean>"


class Windows:
    """The windows of some benchmark items: a vocabulary, the items' words one after another, and for each length the windows' hashes, sorted, with their places."""

    def __init__(self, items: list[tuple[str, str | None]], width: int) -> None:
        self.ids: dict[bytes, int] = {}
        self.names, parts, lengths = [], [], []
        for item, text in items:
            own = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            self.names.append(item)
            parts.append(np.array(own, np.int32))
            lengths.append(len(own))
        self.words = np.concatenate([*parts, np.zeros(0, np.int32)])
        self.starts = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int64)
        mixed = mix64(self.words.astype(np.uint64))
        self.hashes: dict[int, np.ndarray] = {}
        self.places: dict[int, np.ndarray] = {}
        for n in sorted({min(width, k) for k in lengths} - {0}):
            at = np.concatenate([np.arange(s, s + k - n + 1) for s, k in zip(self.starts, lengths, strict=False) if min(width, k) == n])
            h = sum(mixed[at + j] * POWERS[j] for j in range(n))
            order = np.argsort(h, kind="stable")
            self.hashes[n], self.places[n] = h[order], at[order]

    def items_with(self, n: int, h: np.uint64, own: np.ndarray) -> set[str]:
        """The items that hold these n words."""
        first, last = np.searchsorted(self.hashes[n], h), np.searchsorted(self.hashes[n], h, "right")
        at = self.places[n][first:last]
        same = at[(self.words[at[:, None] + np.arange(n)] == own).all(1)]
        return {self.names[k] for k in np.unique(np.searchsorted(self.starts, same, "right") - 1).tolist()}

    def find(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """For each text its number of words, its hit stretches of words (start, stop), and the items met."""
        split = [words_of(t) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(w) + 1 for w in split])])
        ids = np.zeros(starts[-1], np.int64)  # 0: not a word of the benchmark, or between texts
        for w, s in zip(split, starts, strict=False):
            ids[s : s + len(w)] = np.fromiter(map(self.ids.get, w, repeat(0)), np.int64, len(w))
        found = [(len(w), [], set()) for w in split]
        known = ids > 0
        run = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(known, out=run[1:])
        mixed = mix64(ids.astype(np.uint64))
        for n, hashes in self.hashes.items():
            at = np.flatnonzero(run[n:] - run[:-n] == n)  # windows of known words only
            if not at.size:
                continue
            h = sum(mixed[at + j] * POWERS[j] for j in range(n))
            met = hashes[np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)] == h
            verified: dict[bytes, set[str]] = {}  # a window that recurs is verified once
            docs = np.searchsorted(starts, at[met], "right") - 1
            for i, doc, value in zip(at[met].tolist(), docs.tolist(), h[met], strict=True):
                own = ids[i : i + n]
                key = own.tobytes()
                if key not in verified:
                    verified[key] = self.items_with(n, value, own)
                if items := verified[key]:
                    found[doc][1].append((i - int(starts[doc]), i - int(starts[doc]) + n))
                    found[doc][2].update(items)
        return found


def merged(stretches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(stretches):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [(a, b) for a, b in out]


def spans_removed(text: str | None, hits: list[tuple[int, int]]) -> str | None:
    """The text without its hit stretches of words, from the first character of a stretch's first word to the last of its last."""
    if not hits:
        return text
    data = text.encode("utf-8", "surrogatepass")
    edges, inside = [], False
    for i, c in enumerate(data):
        word = 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 or c > 127
        if word != inside:
            edges.append(i)
            inside = word
    if inside:
        edges.append(len(data))
    out, at = [], 0
    for start, stop in hits:
        out.append(data[at : edges[2 * start]])
        at = edges[2 * stop - 1]
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def _finder(windows: Broadcast):
    kind = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("items", pa.list_(pa.string())), ("contaminated", pa.bool_())])

    @lean
    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, before in batches:
            texts, had, done = text.to_pylist(), before.to_pylist(), []
            for start, stop in blocks([len(t or "") for t in texts], CHARS):
                for (n, stretches, met), old in zip(windows.value.find(texts[start:stop]), had[start:stop], strict=True):
                    if old:
                        stretches = [*stretches, *((x["start"], x["stop"]) for x in old["hits"])]
                        met = met.union(old["items"])
                    hits = merged(stretches)
                    done.append({"n_words": n, "hits": [{"start": a, "stop": b} for a, b in hits], "items": sorted(met), "contaminated": bool(hits)})
            yield pa.array(done, kind)

    return find


def hit(docs: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", width: int = WIDTH, most_chars: int = MOST_CHARS, out_col: str = "__hits") -> DataFrame:
    """docs with out_col: struct of n_words, hits (stretches of words, merged), items (as strings, sorted as strings), contaminated.

    A null or wordless document has none. Items without words never hit; a null item id is named "". Repeated items count once,
    repeated documents each. An empty benchmark hits nothing; empty docs give no rows. Columns of docs are kept; one named out_col is replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / most_chars))
    out = docs.withColumn(out_col, F.lit(None).cast(HITS))
    for part in range(parts):
        rows = items.where(F.expr(f"pmod(xxhash64(item, text), {parts}) = {part}")).collect()  # at most most_chars, give or take the hash
        windows = spark.sparkContext.broadcast(Windows([(r.item, r.text) for r in rows], width))
        del rows
        out = out.withColumn(out_col, F.arrow_udf(_finder(windows), HITS)(F.col(text_col), F.col(out_col)))
        if parts > 1:
            out = written(out, "hits")
            windows.destroy()
    return out


def report(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """One row for each document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = hit(docs.select(doc_id, "text"), benchmark).select(doc_id, "__hits")
    return found.select(
        doc_id,
        F.col("__hits.n_words").alias("n_words"),
        F.expr("aggregate(__hits.hits, 0L, (a, x) -> a + x.stop - x.start)").alias("n_hit"),
        F.size("__hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__hits.items", ","), 256).alias("items_sha256"),
        F.col("__hits.contaminated").alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame, remove: str = "documents") -> DataFrame:
    """docs without their contaminated rows (remove="documents") or without the hit stretches of their texts (remove="spans")."""
    own = free_name("hits", docs)
    found = hit(docs, benchmark, out_col=own)
    if remove == "documents":
        return found.where(f"NOT `{own}`.contaminated").drop(own)

    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for text, hits in batches:
            yield pa.array([spans_removed(t, [(x["start"], x["stop"]) for x in h["hits"]]) for t, h in zip(text.to_pylist(), hits.to_pylist(), strict=True)], pa.string())

    return found.withColumn("text", F.arrow_udf(cut, "string")(F.col("text"), F.col(own))).drop(own)


#: The report in SQL.
ORACLE = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT item, least(10, len(w)) AS n, w[i : i + least(10, len(w)) - 1] AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, lengths WHERE len(w) >= n)),
met AS (SELECT p.doc_id, p.i, p.n, x.item FROM places p JOIN windows x ON p.n = x.n AND p.g = x.g),
hit_words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM met) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
