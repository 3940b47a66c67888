"""Word shingles of texts as sorted sets of 64-bit hashes, by numpy over whole batches."""

from __future__ import annotations

import numpy as np

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
_RANDOM = np.random.default_rng(20_240_117)
_BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
CHUNK = 1 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The start and a hash of each word of the bytes, in order; ``A-Z`` counts as lower case."""
    starts, found, start = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], 0
    while start < len(flat):
        end = min(len(flat), start + CHUNK)
        while end < len(flat) and not SEPARATOR[flat[end - 1]]:
            end += 1  # chunks end at a separator
        part = flat[start:end]
        inside = ~SEPARATOR[part]
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if len(first):
            lengths = last - first
            at = np.flatnonzero(inside)
            ends = np.cumsum(lengths)
            place = np.arange(len(at)) - np.repeat(ends - lengths, lengths)
            value = _BYTE[LOWER[part[at]]] * _powers(int(lengths.max()))[place]
            starts.append(first + start)
            found.append(mix(np.add.reduceat(value, ends - lengths) + lengths.astype(np.uint64)))
        start = end
    return np.concatenate(starts), np.concatenate(found)


def text_words(flat: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The word hashes of each of several texts that lie one after another."""
    n = len(bounds) - 1
    apart = np.full(len(flat) + n, 0x20, np.uint8)  # a separator after each text
    apart[np.arange(len(flat)) + np.repeat(np.arange(n), np.diff(bounds))] = flat
    starts, hashes = word_hashes(apart)
    return np.split(hashes, np.searchsorted(starts, bounds[1:-1] + np.arange(1, n))) if n else []


def shingle_set(hashes: np.ndarray, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``words`` words; fewer words make one run; none, nothing."""
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    out = np.full(len(hashes) - width + 1, np.uint64(width) * _PLACE[63])
    for k in range(width):
        out += hashes[k : len(hashes) - width + 1 + k] * _PLACE[k]
    return np.unique(mix(out))
