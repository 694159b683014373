"""Keyword and regular-expression filters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MATCHES = "array<struct<side:string,term:string>>"


def term_sides(sides: Sequence[tuple[str, Sequence[str]]]) -> dict[str, str]:
    """term -> side of lists in side order. Terms are lower-cased and keep edge spaces; a term of both sides belongs to the later."""
    return {t.lower(): side for side, terms in sides for t in terms if t.strip()}


def keyword_matches(text: Column, sides: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The distinct (side, term) whose term occurs anywhere in the text, sorted; one automaton pass for all terms, in Arrow batches."""
    import ahocorasick

    terms = term_sides(sides)
    kind = pa.list_(pa.struct([("side", pa.string()), ("term", pa.string())]))

    def match(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automaton = ahocorasick.Automaton()
        for term, side in terms.items():
            automaton.add_word(term, (side, term))
        automaton.make_automaton()
        for batch in batches:
            found = [sorted({hit for _, hit in automaton.iter(t)}) if terms and (t := text.as_py()) else [] for text in batch]
            yield pa.array([[{"side": s, "term": t} for s, t in hits] for hits in found], kind)

    return F.arrow_udf(match, MATCHES)(text)


def keyword_matches_native(text: Column, sides: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The same without Python, one containment test for each term: for short lists."""
    terms = sorted((side, t) for t, side in term_sides(sides).items())
    listed = F.array(*[F.struct(F.lit(s).alias("side"), F.lit(t).alias("term")) for s, t in terms])
    return F.filter(listed, lambda m: F.contains(text, m["term"])) if terms else F.array().cast(MATCHES)


def keyword_filter(posts: DataFrame, sides, text_col: str = "text", native: bool = False) -> DataFrame:
    """The posts that hold a term, with their matches."""
    found = (keyword_matches_native if native else keyword_matches)(F.col(text_col), sides)
    return posts.withColumn("matches", found).where(F.size("matches") > 0)


def any_pattern(text: Column, patterns: Sequence[str]) -> Column:
    """Whether a pattern occurs, ignoring case, with Unicode classes; a balanced tree of ORs, as a deep one overflows the planner."""
    if not patterns:
        return F.lit(False)
    if len(patterns) == 1:
        return text.rlike("(?iuU)" + patterns[0])
    half = len(patterns) // 2
    return any_pattern(text, patterns[:half]) | any_pattern(text, patterns[half:])


def regex_filter(posts: DataFrame, patterns: Sequence[str], text_col: str = "text") -> DataFrame:
    """The posts in which a pattern of either side occurs, unchanged."""
    return posts.where(any_pattern(F.col(text_col), patterns))
