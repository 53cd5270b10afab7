"""Hashes of words and word windows over whole Arrow batches, in numpy.

A word is a run of bytes other than 0x20 and 0x09-0x0D. Its hash is a polynomial in random byte values, so all words
of a batch come from one running sum; window hashes are polynomials in the word hashes. All arithmetic is modulo 2^64.
"""

from __future__ import annotations

import functools

import numpy as np

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BLOCK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit values of a seed."""
    with np.errstate(over="ignore"):
        start = mix(np.array([seed + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@functools.lru_cache(maxsize=4)
def _byte_values(seed: int, fold_case: bool) -> np.ndarray:
    values = stream(seed, 256)
    if fold_case:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


def base_of(seed: int) -> int:
    return int(stream(seed, 1)[0]) | 5


@functools.lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_spans(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the n + 1 word offsets of the documents."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(_SPACE[data], out=inside[1:-1])
    first = inside[1:-1] & ~inside[:-2]
    last = inside[1:-1] & ~inside[2:]
    cuts = ends[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[1:-1][cuts]
    last[cuts - 1] = inside[1:-1][cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, ends)


def word_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, seed: int, fold_case: bool = False) -> np.ndarray:
    """A 64-bit hash of each word; with ``fold_case`` A-Z counts as a-z."""
    values = _byte_values(seed, fold_case)
    base = base_of(seed)
    inverse = pow(base, -1, 1 << 64)
    out = np.empty(len(starts), np.uint64)
    at = 0
    with np.errstate(over="ignore"):
        while at < len(starts):
            origin = starts[at]
            to = max(int(np.searchsorted(stops, origin + _BLOCK, "right")), at + 1)
            size = int(stops[to - 1] - origin)
            room = _BLOCK if size <= _BLOCK else size
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(values[data[origin : origin + size]] * _powers(base, room)[:size], out=sums[1:])
            s, e = starts[at:to] - origin, stops[at:to] - origin
            out[at:to] = mix((sums[e] - sums[s]) * _powers(inverse, room)[s] + (e - s).astype(np.uint64))
            at = to
    return out


def windows(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of the ``size`` words from each position on; the last ``size - 1`` positions have none."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, mask = base_of(seed + 77), (1 << 64) - 1
    with np.errstate(over="ignore"):
        level, width, out, done = words, 1, None, 0
        rest = size
        while rest:
            if rest & 1:
                part = level[done : done + n]
                out = part.copy() if out is None else out + part * np.uint64(pow(base, done, 1 << 64))
                done += width
            rest >>= 1
            if rest:
                level = level[:-width] + level[width:] * np.uint64(pow(base, width, 1 << 64) & mask)
                width *= 2
        return mix(out + np.uint64(size))


def within(offsets: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which window starts lie wholly in one document (of ``n`` candidates)."""
    ok = np.ones(n, bool)
    for k in range(1, size):
        bad = offsets[1:-1] - k
        ok[bad[(bad >= 0) & (bad < n)]] = False
    return ok
