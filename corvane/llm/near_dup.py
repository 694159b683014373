"""Near-duplicate classes of documents: ProbMinHash signatures, banding, exact verification, connected components.

Documents are sets of shingles of five words (runs of 0-9, a-z and non-ASCII, A-Z lower-cased). Candidates come from ProbMinHash
signatures, where every shingle of a document weighs the same, however often it recurs; two documents are linked if the exact Jaccard similarity of their shingle
sets is 0.8 or more, and a class is a connected component of the links. No step holds more than a bounded group in one task:

1. One pass of Python over the texts gives each document a key of its words and its band hashes.
2. Equal keys collapse into the copy of the least id, so that copies meet in one aggregation and never in pairs.
3. In each bucket (a band hash held by two or more), every member is paired with one pivot only: the member that shares
   buckets with most others. For a family of edited copies that is the text they were edited from.
4. The distinct pairs are verified on the whole texts; the links give components.
5. That leaves open the members that failed against their pivot and belong to another component than it: they are compared
   with all other members of the bucket, in blocks of bounded size over many tasks. Verification has noted which shingles of
   the pivot each member lacks and which others it has, and these differences give the exact similarity of any two members
   without their texts; so no pairs are ever listed but links.

A link is lost only where all bands miss it: about 3 in a million at a similarity of 0.8, fewer above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import blocks, free_name, lean, settled, words_of, written
from corvane.llm.shingles import band_hashes, prob_min_hash, shingle_hashes, weighted

THRESHOLD, BANDS, ROWS = 0.8, 32, 5
#: Characters whose shingles are held at a time; members of a bucket, and bytes of their differences, that meet in one block on either
#: side; shingles marked in a matrix at a time; members of a bucket that are verified beside one copy of their pivot's text.
CHARS, BLOCK, BLOCK_BYTES, COLUMNS, RAYS = 4_000_000, 1024, 16_000_000, 4096, 4096


def key_of(text: str | None) -> bytes | None:
    """The same for texts of the same words; None without words."""
    return hashlib.blake2b(b" ".join(w), digest_size=16).digest() if (w := words_of(text)) else None


def _keys(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        yield pa.array([key_of(t.as_py()) for t in batch], pa.binary())


def _signer(bands: int, rows: int):
    @lean
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            for start, stop in blocks([len(t or "") for t in texts], CHARS):
                part = texts[start:stop]
                keys = [key_of(t) for t in part]
                sets = [weighted(t) for t in part]
                owner = np.repeat(np.arange(len(part)), [len(s[0]) for s in sets])
                signature = prob_min_hash(np.concatenate([s[0] for s in sets]), np.concatenate([s[1] for s in sets]), owner, len(part), bands * rows)
                hashes = band_hashes(signature, bands, rows)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * bands), pa.array(hashes.ravel()))
                yield pa.RecordBatch.from_arrays([ids[start:stop], pa.array(keys, pa.binary()), lists], ["id", "key", "bands"])

    return sign


def _verifier():
    """Of pairs (id, pivot, text, pivot's text): the similarity, the numbers of shingles, and the differences."""

    @lean
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, None)
        for batch in batches:
            out = {k: [] for k in ("similarity", "n", "n_pivot", "lacks", "adds")}
            for ta, tb in zip(batch.column(2), batch.column(3), strict=True):
                own, text = np.unique(shingle_hashes(words_of(ta.as_py()))), tb.as_py()
                if last[0] != text:
                    last = (text, np.unique(shingle_hashes(words_of(text))))
                lacks = np.flatnonzero(~np.isin(last[1], own, assume_unique=True)).astype("<u4")
                adds = np.setdiff1d(own, last[1], assume_unique=True).astype("<u8")
                both = len(own) - len(adds)
                out["similarity"].append(both / max(1, len(own) + len(last[1]) - both))
                out["n"].append(len(own))
                out["n_pivot"].append(len(last[1]))
                out["lacks"].append(lacks.tobytes())
                out["adds"].append(adds.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out["similarity"], pa.float64()), pa.array(out["n"], pa.int32()), pa.array(out["n_pivot"], pa.int32()), pa.array(out["lacks"], pa.binary()), pa.array(out["adds"], pa.binary())], ["id", "pivot", *out])

    return verify


def _overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many members each set of a shares with each of b; only a slice of the members stands in memory at a time."""
    out = np.zeros((len(a), len(b)), np.float32)
    met = np.intersect1d(np.concatenate(a), np.concatenate(b))
    for i in range(0, len(met), COLUMNS):
        part = met[i : i + COLUMNS]
        marks = []
        for sets in (a, b):
            marks.append(np.zeros((len(sets), len(part)), np.float32))
            for k, x in enumerate(sets):
                x = x[np.searchsorted(x, part[0]) : np.searchsorted(x, part[-1], "right")]
                at = np.minimum(np.searchsorted(part, x), len(part) - 1)
                marks[-1][k, at[part[at] == x]] = 1
        out += marks[0] @ marks[1].T
    return out


def _crossing(threshold: float):
    """Of each block of members of a bucket, one link at most from each asking member to each other component."""

    @lean
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for block in batch.column(0):
                rows = block.as_py()
                asking, others = [x for x in rows if x["asks"]], [x for x in rows if not x["asks"]]
                lacks = [[np.frombuffer(x["lacks"], "<u4") for x in side] for side in (asking, others)]
                adds = [[np.frombuffer(x["adds"], "<u8") for x in side] for side in (asking, others)]
                n, m = (np.array([x["n"] for x in side])[:, None] for side in (asking, others))
                gone = np.array([len(x) for x in lacks[0]])[:, None] + np.array([len(x) for x in lacks[1]]) - _overlaps(*lacks)
                both = rows[0]["n_pivot"] - gone + _overlaps(*adds)
                apart = np.array([x["component"] for x in asking])[:, None] != np.array([x["component"] for x in others])
                links = {}
                for i, j in zip(*np.nonzero(apart & (both >= threshold * (n + m.T - both) - 1e-6)), strict=True):
                    links[i, others[j]["component"]] = asking[i]["id"], others[j]["id"]
                a += [x for x, _ in links.values()]
                b += [x for _, x in links.values()]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return compare


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Distinct pairs (id, pivot) with what the whole texts (id, text, one row each) of both tell about them.

    pairs has the size n of their bucket too. The rays of a pivot of many are dealt to ceil(n / RAYS) copies of its text.
    """
    salts = F.expr(f"ceil(n / {RAYS})")
    pairs = written(pairs.groupBy("id", "pivot").agg(F.max("n").alias("n")).select("id", "pivot", salts.alias("salts"), F.pmod(F.xxhash64("id"), salts).alias("salt")), "pairs")
    dealt = ["pivot", "salts", "salt"]
    # Texts are dealt out by id at every size, so that what a small input shows holds for a large one.
    pivots = pairs.select(*dealt).distinct().hint("merge").join(texts.select(F.col("id").alias("pivot"), F.col("text").alias("tb")), "pivot")
    joined = pairs.hint("merge").join(texts.select("id", F.col("text").alias("ta")), "id").join(pivots.hint("merge"), dealt)
    found = joined.select("id", "pivot", "ta", "tb").where("ta IS NOT NULL AND tb IS NOT NULL")
    return found.mapInArrow(_verifier(), "id long, pivot long, similarity double, n int, n_pivot int, lacks binary, adds binary")


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of the edges (a, b); the component is its least id.

    Alternating large-star and small-star rounds (Kiveris et al., 2014) until the edges are stars round the least ids; each
    round is written out. Minima are aggregated, so that no node's neighbours are ever gathered.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before or not state[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select("v", "v")).distinct()
        before = state
        both = edges.union(edges.select("v", "u"))
        large = both.join(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = written(large.distinct(), "large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = written(large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least).distinct(), "edges")


class Nodes:
    """The documents as nodes: a row's id, but where rows repeat an id each of its different texts is a node of its own.

    signed: (id, key, bands) of every row with an id, those without words included. again: the ids that repeat (usually none or few).
    """

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, bands: int, rows: int) -> None:
        self.rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
        texts = self.rows.where("id IS NOT NULL")
        signed = written(texts.mapInArrow(_signer(bands, rows), "id long, key binary, bands array<long>"), "signed")
        again = written(signed.groupBy("id").count().where("count > 1").select("id"), "again")
        self.again = None if again.isEmpty() else again
        self.texts, self.signed = texts, signed.withColumn("node", F.col("id"))
        if self.again is not None:
            own = lambda t: t.join(again.select("id", F.lit(True).alias("repeats")), "id", "left")
            node = F.when(F.col("repeats") & F.col("key").isNotNull(), F.xxhash64("id", "key")).otherwise(F.col("id"))
            self.signed = written(own(signed).withColumn("node", node).drop("repeats"), "signed")
            rest = own(texts).where("repeats").withColumn("key", F.arrow_udf(_keys, "binary")(F.col("text"))).withColumn("node", node)
            self.texts = texts.join(again, "id", "left_anti").unionByName(rest.groupBy("node").agg(F.min("text").alias("text")).withColumnRenamed("node", "id"))


def classed(docs: DataFrame, id_col: str, text_col: str, threshold: float, bands: int, rows: int) -> tuple[DataFrame, Nodes]:
    """(id, key, node, copy_of, class_id, kept), one row for each row with an id: the node of its class that has the least id is kept."""
    nodes = Nodes(docs, id_col, text_col, bands, rows)
    signed, texts = nodes.signed, nodes.texts

    worded = signed.where("key IS NOT NULL")
    # Where no id repeats, nodes are ids, and their minimum needs no structs, which Spark would sort to aggregate.
    least = lambda rows, by: rows.groupBy(by).agg(F.min("id").alias("id")).withColumn("node", F.col("id")) if nodes.again is None else rows.groupBy(by).agg(F.min(F.struct("id", "node")).alias("l")).select(by, "l.*")
    first = written(least(worded, "key").select("key", F.col("id").alias("copy_of"), F.col("node").alias("lead")), "first")
    copies = written(worded.select("id", "key", "node").distinct().join(first, "key").select("id", "key", "node", "copy_of", "lead"), "copies")
    leads = worded.join(copies.where("node = lead").select("node"), "node", "left_semi")

    banded = leads.select(F.col("node").alias("id"), F.explode("bands").alias("bucket")).distinct()
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = written(banded.join(shared, "bucket"), "members")
    central = members.groupBy("id").agg(F.sum("n").alias("weight"))
    pivots = members.join(central, "id").groupBy("bucket").agg(F.max_by("id", F.struct("weight", -F.col("id"))).alias("pivot"))
    stars = written(members.join(pivots, "bucket"), "stars")
    rays = written(verified(stars.where("id <> pivot").select("id", "pivot", "n"), texts), "rays")
    links = rays.where(F.col("similarity") >= threshold).select(F.col("id").alias("a"), F.col("pivot").alias("b"))
    found = written(components(links), "components")

    placed = written(stars.join(found, "id", "left").select("bucket", "id", "pivot", F.coalesce("component", "id").alias("component")), "placed")
    centre = placed.where("id = pivot").select("bucket", F.col("component").alias("centre"))
    opened = placed.join(centre, "bucket").withColumn("asks", F.expr("component <> centre"))
    open_buckets = opened.groupBy("bucket").agg(F.count("*").alias("members"), F.count_if("asks").alias("asking")).where("members > 2 AND asking > 0").select("bucket")
    rays = rays.withColumn("bytes", F.length("lacks") + F.length("adds"))
    opened = opened.join(open_buckets, "bucket", "left_semi").where("id <> pivot").join(rays, ["id", "pivot"])
    # So many blocks on either side that none holds over BLOCK members or BLOCK_BYTES of differences, give or take the hash.
    blocks_of = lambda which: F.greatest(F.ceil(F.count_if(which) / BLOCK), F.ceil(F.sum(F.when(which, F.col("bytes")).otherwise(0)) / BLOCK_BYTES), F.lit(1))
    sizes = opened.groupBy("bucket").agg(blocks_of(F.lit(True)).alias("blocks"), blocks_of(F.col("asks")).alias("asking_blocks"))
    what = ["bucket", "id", "component", "n", "n_pivot", "lacks", "adds"]
    opened = opened.join(sizes, "bucket").select(*what, "asks", "blocks", "asking_blocks")
    mine = lambda n: F.expr(f"pmod(xxhash64(id), {n})")
    every = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1L)"))
    asked = opened.select(*what, F.lit(False).alias("asks"), mine("blocks").alias("there"), every("asking_blocks").alias("here"))
    asking = opened.where("asks").select(*what, F.lit(True).alias("asks"), every("blocks").alias("there"), mine("asking_blocks").alias("here"))
    block = F.collect_list(F.struct("id", "component", "n", "n_pivot", "lacks", "adds", "asks"))
    grouped = asked.unionByName(asking).groupBy("bucket", "there", "here").agg(block.alias("block"))
    later = grouped.where("exists(block, x -> x.asks) AND exists(block, x -> NOT x.asks)").select("block").mapInArrow(_crossing(threshold), "a long, b long")
    later = written(later.distinct(), "later")
    if not later.isEmpty():
        found = written(components(links.union(later)), "components")

    found = found.withColumnRenamed("id", "lead")
    own = copies.join(found, "lead", "left").withColumn("component", F.coalesce("component", "lead"))
    kept = least(own, "component").select("component", F.col("id").alias("class_id"), F.col("node").alias("kept"))
    own = written(own.join(kept, "component").select("node", "copy_of", "class_id", "kept").distinct(), "classes")
    alone = lambda c: F.coalesce(c, F.col("id"))
    every_row = signed.select("id", "key", "node").join(own, "node", "left")
    return every_row.select("id", "key", "node", alone("copy_of").alias("copy_of"), alone("class_id").alias("class_id"), F.coalesce("kept", "node").alias("kept")), nodes


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, copy_of, class_id), one row for each row: the least id of the documents of the same words, and of the class.

    A document without words (null, empty, only punctuation) is alone in its class. Rows that repeat an id are documents of their own
    where their words differ, and so may be of different classes. A null id has a null class. An empty table gives an empty result.
    """
    found, nodes = classed(docs, id_col, text_col, threshold, bands, rows)
    nowhere = nodes.rows.where("id IS NULL").select("id", F.col("id").alias("copy_of"), F.col("id").alias("class_id"))
    return found.select("id", "copy_of", "class_id").union(nowhere).withColumnRenamed("id", id_col)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row for each class: one of its least id. Rows of the same id and words are one document, of which one row stays (of
    those without words as well); rows of a null id all stay."""
    found, nodes = classed(docs, id_col, text_col, THRESHOLD, BANDS, ROWS)
    name = free_name("kept", docs)
    kept = settled(found.where("node = kept").select(F.col("id").alias(name), "key").distinct())
    if nodes.again is None:
        out = docs.join(kept.select(name), docs[id_col] == kept[name]).drop(name)
    else:
        again = nodes.again.select(F.col("id").alias(name))
        once = docs.join(again, docs[id_col] == again[name], "left_anti")
        once = once.join(kept.select(name), once[id_col] == kept[name]).drop(name)
        # Rows of one id and the same words are one document: one of them is chosen by its content.
        rest = docs.join(again, docs[id_col] == again[name], "left_semi").select(F.struct(*docs.columns).alias("row"), F.arrow_udf(_keys, "binary")(F.col(text_col)).alias("own"))
        rest = rest.join(kept, (F.col(f"row.{id_col}") == F.col(name)) & F.col("own").eqNullSafe(F.col("key"))).groupBy(name, "own").agg(F.min("row").alias("row"))
        out = once.unionByName(rest.select("row.*"))
    return out.unionByName(docs.where(F.col(id_col).isNull()))
