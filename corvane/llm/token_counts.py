"""Edit-aware token counts.

Byte-pair encoding works within pre-tokens, the matches of a pattern from left to right, so a text's count is the sum over its
pre-tokens. A document keeps a segment tree over runs of pre-tokens: each node has the characters and the tokens below it. An edit
finds its first and last run by characters, reads pre-tokens again from a little before the edit until they fall in step with
the old ones, counts only those, and updates the sums on the paths from the touched runs to the root. Runs that grow over twice
`RUN` pre-tokens are split.

Why that is exact: a match depends on the text from its start to at most `LOOK` characters after its end, and not on what is before
its start. So old pre-tokens that end LOOK or more before the edit stand; and as soon as a new pre-token ends after the edit
where an old one ended, all later ones are the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm.common import free_name
from corvane.llm.packing import PATTERN, VOCABULARY, encode_piece, encoding

LOOK, RUN = 4, 32
PRETOKEN = regex.compile(PATTERN)
#: Distinct pre-tokens whose counts a worker holds; beyond that it starts anew.
HELD = 400_000
#: Characters of the longest pre-token whose count is held.
MOST_HELD = 200


class Counts(dict):
    """Tokens of a pre-token, encoded when first asked for."""

    def __init__(self, vocabulary: str) -> None:
        super().__init__()
        self.vocabulary, self.encode = vocabulary, encoding(vocabulary).encode_ordinary

    def __missing__(self, piece: str) -> int:
        if len(piece) > MOST_HELD:  # rare and large: not held; a long run of white space mustn't meet the tokenizer's pattern engine
            return len(encode_piece(piece, self.vocabulary))
        if len(self) >= HELD:
            self.clear()
        n = self[piece] = len(self.encode(piece))
        return n


class CountedText:
    """A text with the segment tree over its runs of pre-tokens; `encoded` counts the pre-tokens that were encoded or looked up."""

    def __init__(self, text: str, counts: Counts) -> None:
        self.text, self.counts = text, counts
        pieces = PRETOKEN.findall(text)
        self.encoded = len(pieces)
        tokens, chars = list(map(counts.__getitem__, pieces)), list(map(len, pieces))
        # Runs keep the characters and tokens of their pre-tokens; where they start follows from the tree.
        each = list(zip(chars, tokens, strict=True))
        self.runs = [each[i : i + RUN] for i in range(0, len(each), RUN)] or [[]]
        self._build()

    def _build(self) -> None:
        self.leaves = 1 << (len(self.runs) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.leaves), [0] * (2 * self.leaves)
        for k in range(len(self.runs)):
            self._fill(k)
        for k in range(self.leaves - 1, 0, -1):
            self._sum(k)

    def _fill(self, run: int) -> None:
        self.chars[self.leaves + run] = sum(c for c, _ in self.runs[run])
        self.tokens[self.leaves + run] = sum(n for _, n in self.runs[run])

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def _find(self, char: int) -> tuple[int, int]:
        """The run that holds this character (the last that has any, if it is the end of the text) and where it starts."""
        k, start = 1, 0
        while k < self.leaves:
            k *= 2
            if char >= start + self.chars[k] and self.chars[k + 1]:
                start += self.chars[k]
                k += 1
        return k - self.leaves, start

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replaces text[start:stop] by `new`."""
        old, text = len(self.text), self.text[:start] + new + self.text[stop:]
        first, at = self._find(max(0, start - LOOK))
        # The pre-tokens of the first run that end LOOK or more before the edit stand.
        head = []
        for piece in self.runs[first]:
            if at + piece[0] + LOOK > start:
                break
            head.append(piece)
            at += piece[0]
        shift, edited = len(text) - old, start + len(new)
        # Ends of old pre-tokens, in new positions, from the edit's end on; runs are taken in as they are reached.
        last, behind = first, self._start(first)
        ends, tail = self._ends(first, behind), []
        made, pos = [], at
        step = None
        for match in PRETOKEN.finditer(text, at):
            made.append(match.end() - pos)
            pos = match.end()
            if pos < edited:
                continue
            while behind + self.chars[self.leaves + last] + shift < pos and last + 1 < len(self.runs):
                behind += self.chars[self.leaves + last]
                last += 1
                ends = self._ends(last, behind)
            if pos - shift >= stop and pos - shift in ends:
                step = ends[pos - shift]
                break
        if step is None:
            last = len(self.runs) - 1
        else:
            tail = self.runs[last][step + 1 :]
        self.text = text
        self.encoded += len(made)
        new_pieces, at2 = [], at
        for n in made:
            new_pieces.append((n, self.counts[text[at2 : at2 + n]]))
            at2 += n
        held = head + new_pieces + tail  # what stands keeps its counts
        if len(held) > 2 * RUN:  # too much for a leaf: the touched runs are dealt out anew and the sums taken again, without encoding
            self.runs[first : last + 1] = [held[i : i + RUN] for i in range(0, len(held), RUN)]
            self._build()
            return
        self.runs[first : last + 1] = [held, *([] for _ in range(last - first))]
        for k in range(first, last + 1):
            self._fill(k)
        for k in sorted({(self.leaves + k) >> up for k in range(first, last + 1) for up in range(1, self.leaves.bit_length())} - {0}, reverse=True):
            self._sum(k)

    def _start(self, run: int) -> int:
        k, start = run + self.leaves, 0
        while k > 1:
            if k & 1:
                start += self.chars[k - 1]
            k >>= 1
        return start

    def _ends(self, run: int, start: int) -> dict[int, int]:
        ends = {}
        for i, (n, _) in enumerate(self.runs[run]):
            start += n
            ends[start] = i
        return ends


def standard_edits(text: str) -> list[tuple[int, int, str]]:
    """The edits of the query, each given for the text as the ones before left it: a year set in at a quarter, 40 characters taken out at
    the half, the first 60 characters repeated at three quarters, and the last 10 replaced by a full stop."""
    n, out = len(text), []
    for start, stop, new in ((n // 4, n // 4, " 2026,"), (n // 2, n // 2 + 40, ""), (3 * n // 4, 3 * n // 4, text[:60]), (n - 10, n, ".")):
        start, stop = max(0, min(start, n)), max(0, min(stop, n))
        out.append((start, stop, new))
        n += len(new) - (stop - start)
    return out


def counted(docs: DataFrame, text_col: str = "text", vocabulary: str = VOCABULARY, edits=standard_edits) -> DataFrame:
    """docs with n_tokens, n_tokens_edited (after `edits`, a function of the text), n_pretokens and n_reread (pre-tokens read again for the edits).

    Whole texts of any length are counted; a null or empty one has no tokens, though its edits may give it some. Rows are counted
    each by itself, so repeated rows get equal counts; an empty table gives no rows. Columns of docs are kept, but for those named
    like the counts, which are replaced.
    """

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = Counts(vocabulary)
        for batch in batches:
            out = []
            for text in batch:
                tree = CountedText(text.as_py() or "", held)
                row = {"n_tokens": tree.n_tokens, "n_pretokens": tree.encoded}
                for start, stop, new in edits(tree.text):
                    tree.edit(start, stop, new)
                out.append(row | {"n_tokens_edited": tree.n_tokens, "n_reread": tree.encoded - row["n_pretokens"], "n_chars_edited": len(tree.text)})
            yield pa.array(out, pa.struct([(k, pa.int64()) for k in NAMES]))

    own = free_name("counts", docs)
    out = docs.withColumn(own, F.arrow_udf(count, "struct<" + ",".join(f"{k}:bigint" for k in NAMES) + ">")(F.col(text_col)))
    return out.withColumns({k: F.col(f"{own}.{k}") for k in NAMES}).drop(own)


NAMES = ("n_tokens", "n_tokens_edited", "n_pretokens", "n_reread", "n_chars_edited")


def report(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_chars and the counts."""
    return counted(docs.select("doc_id", "text")).select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"), *NAMES)
