"""Word and shingle hashes of many texts at once, in numpy.

A word is a run of ASCII letters, digits and non-ASCII characters; A-Z is lower-cased.
All texts of a batch are one byte array: running sums of a polynomial give every word
its hash by two look-ups, and shingles combine the hashes of consecutive words.
"""

from __future__ import annotations

import numpy as np

from cardledger.llm.common import WORD_BYTES

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_JOIN = 0xD6E8FEB86659FD93


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, dtype=_U)
    if n:
        powers[0] = 1
    return np.cumprod(powers, dtype=_U)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of the first word of every text and, last, of all words)."""
    joined = b" ".join([*texts, b""]).translate(WORD_BYTES)
    codes = np.frombuffer(b" " + joined + b" ", dtype=np.uint8)
    inside = (codes != 0x20).astype(np.int8)
    edges = np.diff(inside)
    starts = np.flatnonzero(edges == 1) + 1
    ends = np.flatnonzero(edges == -1) + 1
    sums = np.zeros(len(codes) + 1, dtype=_U)
    np.cumsum((codes.astype(_U) + _U(1)) * _powers(_BASE, len(codes)), out=sums[1:])
    words = (sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, len(codes))[starts]
    begins = np.cumsum([1, *[len(t) + 1 for t in texts]])
    return mixed(words ^ (ends - starts).astype(_U)), np.searchsorted(starts, begins)


def shingle_hashes(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every run of ``width`` words within a text, first shingle of every text).

    A text of fewer words, but not none, is one shingle of all its words.
    """
    counts = np.diff(first)
    rolled = np.zeros(max(len(words) - width + 1, 0), dtype=_U)
    for i in range(width):
        rolled = rolled * _U(_JOIN) + words[i : i + len(rolled)]
    full = np.maximum(counts - width + 1, 0)
    short = (counts > 0) & (counts < width)
    sizes = np.where(short, 1, full)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    found = np.empty(begins[-1], dtype=_U)
    place = np.arange(begins[-1]) - np.repeat(begins[:-1], sizes)
    start = np.repeat(first[:-1], sizes) + place
    long = ~np.repeat(short, sizes)
    found[long] = rolled[start[long]]
    for i in np.flatnonzero(short):
        h = 0
        for w in words[first[i] : first[i + 1]].tolist():
            h = (h * _JOIN + w) & 0xFFFFFFFFFFFFFFFF
        found[begins[i]] = h ^ int(counts[i])
    return mixed(found), begins


def sorted_sets(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values of every text in order, how often each occurs, first value of every text)."""
    values = values.copy()
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        values[a:b].sort()
    fresh = np.ones(len(values), dtype=bool)
    fresh[1:] = values[1:] != values[:-1]
    fresh[first[:-1][first[:-1] < len(values)]] = True
    at = np.flatnonzero(fresh)
    return values[at], np.diff(np.append(at, len(values))), np.searchsorted(at, first)
