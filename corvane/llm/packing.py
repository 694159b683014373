"""Token-ID output: documents become token ids, and ids fill fixed-length rows by best-fit-decreasing packing.

Each task packs the documents of its own partition, a buffer of about `buffer_tokens` at a time, so that memory is bounded,
nothing is shuffled, and documents stay near the training order they came in. A document is its ids and the separator's; one of
more than `row_tokens` is cut into full rows and a rest, so that its parts in order give it back whole. Pieces go in by
descending length, each to the open row with the least room that holds it. That row comes from a segment tree over capacities:
leaf c counts the open rows with c free places, and the least non-empty leaf from the piece's length on is found in two walks.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import blocks, lean

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The published pre-token pattern of this vocabulary, and the id after its last, which is free and serves as separator.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
ROW_TOKENS, BUFFER_TOKENS, CHARS = 2048, 4_000_000, 1_000_000
PACKED = "partition int, buffer int, row int, n_tokens int, ids binary, cu_seqlens array<int>, position_resets array<int>, doc_ids array<long>, parts array<int>"


@functools.cache
def encoding(vocabulary: str = VOCABULARY):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Longer runs of white space are cut out before the tokenizer's pattern engine, whose stack they would overflow, sees the text.
LONG_SPACE = regex.compile(r"\s{10000,}")


def encode(text: str, vocabulary: str = VOCABULARY) -> list[int]:
    """The token ids of any text. A long run of white space is one pre-token but for its last character, if text follows, which
    begins the next one; so the text before it, the run, and the rest from that character on are encoded by themselves.
    """
    coder = encoding(vocabulary)
    if len(text) < 10_000 or not (found := LONG_SPACE.search(text)):
        return coder.encode_ordinary(text)
    out, at = [], 0
    while found:
        start, stop = found.span()
        stop -= stop < len(text)
        out += coder.encode_ordinary(text[at:start])
        out += encode_piece(text[start:stop], vocabulary)
        at, found = stop, LONG_SPACE.search(text, found.end())
    return out + coder.encode_ordinary(text[at:])


def encode_piece(piece: str, vocabulary: str = VOCABULARY) -> list[int]:
    """The token ids of one pre-token, by byte-pair merges alone."""
    return encoding(vocabulary)._core_bpe.encode_single_piece(piece.encode("utf-8", "replace"))


class Rooms:
    """Open rows by free places, 0 to `most`; a segment tree counts those of each range."""

    def __init__(self, most: int) -> None:
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, free: int, by: int) -> None:
        k = free + self.leaves
        while k:
            self.count[k] += by
            k >>= 1

    def put(self, row: int, free: int) -> None:
        self.rows[free].append(row)
        self._add(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """A row of the least room that is `need` or more, with that room; it is no longer open."""
        k = need + self.leaves
        if not self.count[k]:
            while k > 1 and (k & 1 or not self.count[k + 1]):  # up, until a subtree to the right has rows
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:
                k = 2 * k if self.count[2 * k] else 2 * k + 1
        free = k - self.leaves
        self._add(free, -1)
        return self.rows[free].pop(), free


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows of indices into lengths (each from 1 to capacity), in the order they were put in."""
    rooms, rows = Rooms(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        if (found := rooms.take(lengths[i])) is None:
            rows.append([i])
            row, free = len(rows) - 1, capacity - lengths[i]
        else:
            row, free = found[0], found[1] - lengths[i]
            rows[row].append(i)
        if free:
            rooms.put(row, free)
    return rows


def pack(docs: list[tuple[int | None, np.ndarray]], capacity: int) -> Iterator[tuple[np.ndarray, list[int], list[int | None], list[int]]]:
    """Of documents (id, ids): rows of ids, cumulative segment lengths from 0, and each segment's document and part number."""
    pieces = [(d, k, ids[k * capacity : (k + 1) * capacity]) for d, ids in docs for k in range(-(-len(ids) // capacity))]
    for row in best_fit([len(p[2]) for p in pieces], capacity):
        own = [pieces[i] for i in row]
        yield np.concatenate([p[2] for p in own]), np.concatenate([[0], np.cumsum([len(p[2]) for p in own])]).tolist(), [p[0] for p in own], [p[1] for p in own]


def _packer(vocabulary: str, separator: int, capacity: int, buffer_tokens: int):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, buffer, held, docs = TaskContext.get().partitionId(), 0, 0, []

        def flush() -> pa.RecordBatch:
            out = []
            for r, (ids, ends, names, parts) in enumerate(pack(docs, capacity)):
                full = np.full(capacity, separator, "<i4")
                full[: len(ids)] = ids
                out.append({"partition": partition, "buffer": buffer, "row": r, "n_tokens": len(ids), "ids": full.tobytes(), "cu_seqlens": ends, "position_resets": ends[:-1], "doc_ids": names, "parts": parts})
            return pa.RecordBatch.from_pylist(out, SCHEMA)

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, stop in blocks([len(t or "") for t in texts], CHARS):
                for name, text in zip(names[start:stop], texts[start:stop], strict=True):
                    ids = np.array([*encode(text or "", vocabulary), separator], np.int32)
                    docs.append((name, ids))
                    held += len(ids)
                if held >= buffer_tokens:
                    yield flush()
                    buffer, held, docs = buffer + 1, 0, []
        if docs:
            yield flush()

    return run


SCHEMA = pa.schema([("partition", pa.int32()), ("buffer", pa.int32()), ("row", pa.int32()), ("n_tokens", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())), ("position_resets", pa.list_(pa.int32())), ("doc_ids", pa.list_(pa.int64())), ("parts", pa.list_(pa.int32()))])


def packed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, separator: int = SEPARATOR, row_tokens: int = ROW_TOKENS, buffer_tokens: int = BUFFER_TOKENS) -> DataFrame:
    """Packed rows. (partition, buffer) names a matrix, `row` its row: ids (little-endian int32, row_tokens of them, the separator
    after the n_tokens used), cu_seqlens (cumulative segment lengths from 0), position_resets (where positions start again at
    0), doc_ids and parts (which document a segment is of, and which part of it).

    `vocabulary` is a file each executor has at that path. A null or empty text is its separator alone. Null and repeated ids
    are kept as they are. An empty table gives no rows. A text of any length and any runs of white space, letters or marks is encoded whole.
    """
    return docs.select(F.col(id_col).cast("long").alias("d"), F.col(text_col).cast("string").alias("t")).mapInArrow(_packer(vocabulary, separator, row_tokens, buffer_tokens), PACKED)


def matrices(rows: list, row_tokens: int = ROW_TOKENS) -> dict[tuple[int, int], np.ndarray]:
    """Of collected rows of a few buffers: each buffer's id matrix."""
    by: dict[tuple[int, int], list] = {}
    for r in rows:
        by.setdefault((r["partition"], r["buffer"]), []).append(r)
    return {k: np.stack([np.frombuffer(r["ids"], "<i4") for r in sorted(v, key=lambda r: r["row"])]).reshape(-1, row_tokens) for k, v in by.items()}
