"""Word and shingle hashes of many texts at once, for Arrow batches inside tasks.

The texts of a batch are one byte array. A word's hash is a polynomial of its
bytes modulo 2^64, taken from prefix sums, and then mixed; a shingle's hash
mixes the hashes of its words. Nothing here runs per byte or per word in
Python.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

import numpy as np

# Odd multipliers of published 64-bit mixing functions.
_BASE = 0x9E3779B97F4A7C15
_MIX_A = np.uint64(0xFF51AFD7ED558CCD)
_MIX_B = np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)

# Powers that a worker keeps: enough for a slice of texts of usual length.
_KEPT = (1 << 20) + (1 << 16)

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words(NamedTuple):
    """The words of a batch: their hashes, and where each text's words begin (one more than texts)."""

    hashes: np.ndarray
    starts: np.ndarray


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = (x ^ (x >> _SHIFT)) * _MIX_A
    x = (x ^ (x >> _SHIFT)) * _MIX_B
    return x ^ (x >> _SHIFT)


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    base, inverse = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    up, down = np.full(size, base), np.full(size, inverse)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(up, out=up), np.multiply.accumulate(down, out=down)


@functools.cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(_KEPT)


def _power_tables(least: int) -> tuple[np.ndarray, np.ndarray]:
    """At least ``least`` powers; those for a text longer than a slice are not kept after it."""
    return _kept_powers() if least <= _KEPT else _powers(least)


def words_of(texts: list[bytes]) -> Words:
    """Hashes of the lower-cased words of each text (UTF-8)."""
    # A blank between the texts ends the last word of each.
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)]
    ends_of_text = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    solid = np.concatenate(([False], ~_BLANK[data], [False]))
    edges = np.flatnonzero(solid[1:] != solid[:-1])
    begin, end = edges[0::2], edges[1::2]
    up, down = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
    starts = np.searchsorted(begin, np.concatenate(([0], ends_of_text)))
    return Words(hashes, starts)


def shingles_of(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words, and where each text's runs begin.

    A text with fewer words has one run of all of them; one without words none.
    """
    hashes, starts = words
    counts = np.diff(starts)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_starts = np.concatenate(([0], np.cumsum(runs)))
    at = np.repeat(starts[:-1] - out_starts[:-1], runs) + np.arange(out_starts[-1])
    length = np.repeat(np.minimum(counts, size), runs)
    padded = np.concatenate((hashes, np.zeros(size, dtype=np.uint64)))
    total = length.astype(np.uint64)
    for k in range(size):
        word = np.where(k < length, padded[at + k], np.uint64(0))
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + word)
    return total, out_starts
