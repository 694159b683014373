"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from its code point. An n-gram's vector is the product of its letters'
vectors, each rotated by its distance from the end (binding permuted letters); a text's vector is the sum of those of its
n-grams (bundling), and a language's prototype is the sum of its training texts' vectors, each scaled to length 1. A text
gets the language whose prototype has the highest cosine with its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm.common import free_name, lean, once, written

DIMENSIONS, GRAM, SEED = 512, 3, 20260101
#: The bound of the training sample, in documents of each language; rows of the table of n-gram vectors that are held at a time.
TRAIN_ROWS, HELD_GRAMS = 1000, 60_000
#: What rejects a text: this quantile of the strengths of its language's training texts, less so many standard deviations of the noise.
#: A language with fewer training texts than LEAST_TEXTS takes the quantile of all languages' texts, if that is lower.
LOW, NOISE, LEAST_TEXTS = 0.01, 2.0, 100


@cache
def letter_vector(code: int, dimensions: int = DIMENSIONS) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, dimensions, np.int8) * np.int8(2) - np.int8(1)


def gram_codes(text: str | None) -> np.ndarray:
    """uint64 codes, 21 bits a letter, of the n-grams of the lower-cased text; what lies between letters counts as one space. Empty without letters."""
    lower = (text or "").lower()
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32)
    is_letter = _letters(codes)
    if not is_letter.any():
        return np.empty(0, np.uint64)
    codes = np.where(is_letter, codes, np.uint32(32))
    keep = np.ones(len(codes), bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]
    codes = np.concatenate([[32], codes[keep][0 if is_letter[0] else 1 :], [32][: int(is_letter[-1])]]).astype(np.uint64)
    out = codes[: len(codes) - GRAM + 1].copy()
    for j in range(1, GRAM):
        out = (out << np.uint64(21)) | codes[j : len(codes) - GRAM + 1 + j]
    return out


_ALPHA = np.zeros(0x110000, np.int8)  # 0: not known yet, 1: no letter, 2: a letter


def _letters(codes: np.ndarray) -> np.ndarray:
    kinds = _ALPHA[codes]
    if not kinds.all():
        for c in np.unique(codes[kinds == 0]).tolist():
            _ALPHA[c] = 2 if chr(c).isalpha() else 1
        kinds = _ALPHA[codes]
    return kinds == 2


class Grams:
    """The vectors of n-grams met so far; when there are too many, all are forgotten, to be made again."""

    def __init__(self, dimensions: int = DIMENSIONS) -> None:
        self.rows: dict[int, int] = {}
        self.table = np.zeros((1024, dimensions), np.int8)

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        known = [self.rows.get(c, -1) for c in codes.tolist()]
        if min(known) < 0:
            if len(self.rows) + len(codes) > HELD_GRAMS:
                self.rows, known = {}, [-1] * len(codes)
            for k, c in enumerate(codes.tolist()):
                if known[k] < 0:
                    known[k] = self.rows[c] = len(self.rows)
                    if known[k] >= len(self.table):
                        self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                    v = np.ones(self.table.shape[1], np.int8)
                    for j in range(GRAM):
                        v = v * np.roll(letter_vector(c >> 21 * j & 0x1FFFFF, len(v)), j)
                    self.table[known[k]] = v
        return self.table[known]


def text_vector(text: str | None, grams: Grams) -> np.ndarray | None:
    """The bundled vector scaled to length 1; None without letters, or if the sum is 0."""
    return sized_vector(text, grams)[0]


def sized_vector(text: str | None, grams: Grams) -> tuple[np.ndarray | None, float]:
    """The text's vector, and its size: the number of equally frequent n-grams that would scatter as much; 0 without letters."""
    codes = gram_codes(text)
    if not len(codes):
        return None, 0.0
    found, counts = np.unique(codes, return_counts=True)
    v = np.zeros(grams.table.shape[1], np.float32)
    for i in range(0, len(found), 4096):
        v += counts[i : i + 4096].astype(np.float32) @ grams.vectors(found[i : i + 4096]).astype(np.float32)
    length = np.linalg.norm(v)
    return (v / length if length else None), len(codes) ** 2 / float((counts.astype(np.float64) ** 2).sum())


def strength(cosine: float, size: float) -> float:
    """The part of a text's vector along the prototype over the part across it, for one n-gram: much the same for long and short texts of a language."""
    c = min(max(cosine, 0.0), 0.9999)
    return c / ((1 - c * c) * size) ** 0.5


def least_cosine(low: float, size: float, dimensions: int) -> float:
    """The cosine of a text of this size and the strength `low`, less NOISE standard deviations of the cosine of its part across the prototype."""
    c2 = low * low * size / (1 + low * low * size)
    return c2**0.5 - NOISE * ((1 - c2) / dimensions) ** 0.5


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages, ascending, and their prototypes (a row each), of labelled texts (lang, text)."""
    names, made = sums_of(labelled, dimensions)
    return names, scaled(made)


def scaled(made: np.ndarray) -> np.ndarray:
    sizes = np.linalg.norm(made, axis=1, keepdims=True)
    return (made / np.where(sizes > 0, sizes, 1)).astype(np.float32)


def sums_of(labelled: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages, ascending, and the sums of their texts' vectors."""

    @lean
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, sums = Grams(dimensions), {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if (v := text_vector(text, grams)) is not None:
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(list(sums), pa.string()), "part": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))})

    parts = labelled.select("lang", "text").mapInArrow(bundle, "lang string, part array<double>")
    rows = parts.select("lang", F.posexplode("part").alias("k", "x")).groupBy("lang", "k").agg(F.sum(F.round("x", 6).cast("decimal(28,6)")).cast("double").alias("x"))
    rows = rows.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("v")).orderBy("lang").collect()  # one row for each language
    return [r["lang"] for r in rows], np.array([[x["x"] for x in r["v"]] for r in rows], np.float64).reshape(len(rows), dimensions)


def levels(labelled: DataFrame, names: list[str], sums: np.ndarray) -> dict[str, float]:
    """For each language the low strength of its training texts, each measured against the other texts of its language.

    Strengths are rounded to a millionth and counted, so that the quantile is that of every text without a task that holds one number for each.
    """
    held = labelled.sparkSession.sparkContext.broadcast((names, sums))

    @lean
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, grams = dict(zip(*held.value, strict=True)), Grams(held.value[1].shape[1])
        for batch in batches:
            langs, found = [], []
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                v, size = sized_vector(text, grams)
                if v is not None and (length := np.linalg.norm(others := own[lang] - v)) > 1e-3:
                    langs.append(lang)
                    found.append(strength(float(others @ v) / length, size))
            yield pa.RecordBatch.from_pydict({"lang": pa.array(langs, pa.string()), "strength": pa.array(found, pa.float64())})

    each = labelled.select("lang", "text").mapInArrow(measure, "lang string, strength double")
    counts = each.groupBy("lang", F.round("strength", 6).alias("strength")).agg(F.count("*").alias("n"))
    rows = counts.rollup("lang").agg(F.percentile("strength", LOW, F.col("n")).alias("low"), F.sum("n").alias("n")).collect()  # one row for each language, and one for all
    low, n = {r["lang"]: r["low"] for r in rows}, {r["lang"]: r["n"] for r in rows}
    return {x: low[x] if n.get(x, 0) >= LEAST_TEXTS else min(low.get(x) or 0.0, low.get(None) or 0.0) for x in names}


def training_sample(docs: DataFrame, id_col: str, rows: int = TRAIN_ROWS) -> DataFrame:
    """(lang, text) of at most `rows` documents of each language: those of the least hash of their id and text. Repeated rows are one document.

    The hashes are chosen without their texts. A language's count says which part of the hashes holds its first `rows`, with room
    to spare, and only hashes in that part are ranked; so no task ranks a language's every document.
    """
    every = docs.where("lang IS NOT NULL").select("lang", "text", F.pmod(F.xxhash64(F.col(id_col), "text"), F.lit(1 << 62)).alias("hash"))
    share = every.groupBy("lang").agg(F.count("*").alias("all")).select("lang", (F.lit(float(1 << 62)) * (rows + 8 * rows**0.5 + 64) / F.col("all")).alias("most"))
    share = written(share, "shares")  # a row for each language: broadcast if Spark finds it small, so that documents aren't dealt out by language
    near = every.select("lang", "hash").join(share, "lang").where("hash <= most").select("lang", "hash").distinct()
    first = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("hash")))
    # rows times languages: small enough to be broadcast by Spark's own check of its size
    chosen = written(first.where(f"n <= {rows}").select("lang", "hash"), "chosen")
    return every.join(chosen, ["lang", "hash"], "left_semi").groupBy("lang", "hash").agg(F.min("text").alias("text")).select("lang", "text")


def training_texts(docs: DataFrame, id_col: str) -> DataFrame:
    """(lang, text) of every document that has a language. Repeated rows are one document."""
    return once(docs.where("lang IS NOT NULL").select("lang", F.col(id_col).alias("id"), "text"), "repeated").select("lang", "text")


def predicted(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text", low: dict[str, float] | None = None) -> DataFrame:
    """docs with lang_pred and score: the language of the highest cosine (ties: the first by name) and that cosine, 0 if negative.

    A text that is null or has no letter is `und` with score 0; so is every text if no language was learned. With the levels
    `low` of the languages, a text that is less like its language than they and its length let expect is `und` with its score.
    """
    languages, rows = model
    held = docs.sparkSession.sparkContext.broadcast((languages, rows))

    @lean
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, profile = held.value
        grams = Grams(profile.shape[1])
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
        for batch in batches:
            langs, scores = [], []
            for text in batch:
                v, size = sized_vector(text.as_py(), grams) if names else (None, 0.0)
                if v is None and size:
                    v = np.zeros(profile.shape[1], np.float32)
                if v is None:
                    langs.append("und")
                    scores.append(0.0)
                else:
                    cosines = profile @ v
                    best = int(cosines.argmax())
                    like = low is None or float(cosines[best]) >= least_cosine(low[names[best]], size, profile.shape[1])
                    langs.append(names[best] if like else "und")
                    scores.append(round(min(1.0, max(0.0, float(cosines[best]))), 6))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], fields=list(kind))

    own = free_name("language", docs)
    out = docs.withColumn(own, F.arrow_udf(predict, "struct<lang:string,score:double>")(F.col(text_col)))
    return out.withColumns({"lang_pred": F.col(f"{own}.lang"), "score": F.col(f"{own}.score")}).drop(own)


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def report(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, held_out, lang_pred, score. A null doc_id has no remainder: it is neither held out nor learned from."""
    learn = docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    model = prototypes(training_sample(learn, "doc_id"))
    return predicted(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def in_a_language(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs without those of no language: no letters, or less like every language than its own texts are. Without a learned language, those with letters stay.

    Prototypes and levels are those of every document that may be learned from: two passes over them before the one that predicts.
    """
    learn = training_texts(docs.where(F.crc32(F.col(id_col).cast("string")) % 3 != 1), id_col)
    names, sums = sums_of(learn)
    named = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    if not names:
        return named.where(has_letters(F.col("text"))).select("__row.*")
    return predicted(named, (names, scaled(sums)), low=levels(learn, names, sums)).where("lang_pred <> 'und'").select("__row.*")


def has_letters(text):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([len(gram_codes(t.as_py())) > 0 for t in batch], pa.bool_())

    return F.arrow_udf(run, "boolean")(text)
