"""Word shingles, their weights, and ProbMinHash signatures in numpy, for a batch of texts at a time."""

from __future__ import annotations

import zlib

import numpy as np

from corvane.llm.common import mix64, unit, words_of

GOLDEN = 0x9E3779B97F4A7C15
WIDTH = 5


def _powers(n: int) -> list[np.uint64]:
    return [np.uint64(pow(0xD1342543DE82EF95, j + 1, 1 << 64)) for j in range(n)]


def shingle_hashes(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """uint64 hashes of all windows of `width` words, with repeats; fewer words, but not none, are one window."""
    if not words:
        return np.empty(0, np.uint64)
    a = mix64(np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) + np.uint64(GOLDEN))
    n = min(width, len(words))
    h = np.zeros(len(words) - n + 1, np.uint64)
    for j, p in enumerate(_powers(n)):
        h += a[j : len(words) - n + 1 + j] * p
    return mix64(h + np.uint64(n))


def weighted(text: str | None, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles, ascending, each of weight 1: registers then agree with the probability of the plain Jaccard similarity that links are defined by."""
    found = np.unique(shingle_hashes(words_of(text), width))
    return found, np.ones(len(found))


def prob_min_hash(element: np.ndarray, weight: np.ndarray, owner: np.ndarray, owners: int, m: int) -> np.ndarray:
    """ProbMinHash signatures (owners x m, uint64) of weighted sets given as parallel arrays of elements, weights and owners.

    Each element is a Poisson process of the rate of its weight; its k-th arrival falls on a register drawn from its hash,
    and a register keeps the element that arrives first. All processes advance together, one arrival a round, and one ends
    as soon as its time has passed the latest register of its owner: no later arrival of it could be the first anywhere.
    Two sets agree in a register with the probability of their probability Jaccard similarity. An owner without elements has zeros.
    """
    first, who = np.full(owners * m, np.inf), np.zeros(owners * m, np.uint64)
    time = np.zeros(len(element))
    live, k = np.flatnonzero(weight > 0), 0
    latest = np.full(owners, np.inf)
    while live.size:
        k += 1
        e, own = element[live], owner[live]
        draw = mix64(e + np.uint64(k * GOLDEN & (1 << 64) - 1))
        t = time[live] - np.log(unit(draw)) / weight[live]
        time[live] = t
        register = own * m + (mix64(draw ^ np.uint64(GOLDEN)) % np.uint64(m)).astype(np.int64)
        early = t < first[register]
        at, t_early = register[early], t[early]
        np.minimum.at(first, at, t_early)
        won = t_early == first[at]
        who[at[won]] = e[early][won]
        here = np.unique(own)
        latest[here] = first.reshape(owners, m)[here].max(1)
        live = live[t < latest[own]]
    return who.reshape(owners, m)


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """int64 (owners x bands): a hash of each band of `rows` registers and of its number."""
    parts = signature.reshape(len(signature), bands, rows)
    h = np.zeros(parts.shape[:2], np.uint64)
    for j, p in enumerate(_powers(rows)):
        h += parts[:, :, j] * p
    return mix64(h + (np.arange(bands, dtype=np.uint64) + np.uint64(1)) * np.uint64(GOLDEN)).view(np.int64)
