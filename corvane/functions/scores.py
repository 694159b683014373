"""Numeric functions over model outputs and counts, as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(x: Column, f: Callable[[Column], Column]) -> Column:
    """f(x) with x computed once: inside a lambda an outer expression would be computed anew for each element."""
    return F.element_at(F.transform(F.array(x), f), 1)


def softmax(x: Column) -> Column:
    """Of an array of doubles; shifted by its maximum."""
    powers = lambda v: let(F.array_max(v), lambda top: F.transform(v, lambda u: F.exp(u - top)))
    scaled = lambda p: let(F.aggregate(p, F.lit(0.0), lambda a, u: a + u), lambda total: F.transform(p, lambda u: u / total))
    return let(let(x, powers), scaled)


def double_softmax(x: Column) -> Column:
    """Emotion scores: the softmax of the softmax of the logits."""
    return softmax(softmax(x))


def argmax(x: Column) -> Column:
    """The 0-based place of the first maximum."""
    return (F.array_position(x, F.array_max(x)) - 1).cast("int")


#: Groups whose relevance takes a probability over the threshold.
THRESHOLD_GROUPS, THRESHOLD = ("race", "skin_tone"), 0.6


def is_relevant(group: str, p: Column) -> Column:
    """Class 1: for the threshold groups if its probability is over 0.6, else if it is the larger (ties: class 0)."""
    return p[1] > THRESHOLD if group in THRESHOLD_GROUPS else p[1] > p[0]


def ratio(a: Column, b: Column) -> Column:
    """a / b, and 0 where b is 0."""
    return F.when(b != 0, a / b).otherwise(0.0)


def lgamma_rise(a: Column, n: Column) -> Column:
    """ln gamma(a + n) - ln gamma(a) for a > 0 and whole n >= 0: the logarithm of the rising factorial; 0 for n = 0.

    Stirling's series at a + 8, in a form whose large terms cancel before they are computed, less the eight factors a to a + 7 that
    were added, taken in pairs: arithmetic alone, without arrays or branches, so that the compiler of the JVM keeps up.
    """
    at = a + 8.0
    series = lambda x: (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / (x * x)) / (x * x)) / (x * x)) / x
    low, high = a * (a + 7.0), (a + n) * (a + n + 7.0)
    added = (high / low) * ((high + 6.0) / (low + 6.0)) * ((high + 10.0) / (low + 10.0)) * ((high + 12.0) / (low + 12.0))
    return n * F.ln(at + n) + (at - 0.5) * F.log1p(n / at) - n + series(at + n) - series(at) - F.ln(added)
