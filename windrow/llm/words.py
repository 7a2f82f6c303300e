"""Words of many texts at once, as NumPy arrays over their UTF-8 bytes.

Words are runs of bytes other than space and 0x09-0x0D; A-Z is lowered. A word's key is a 64-bit polynomial of random
byte values. Two different words share a key with a chance of about 2**-64 per pair.
"""

from __future__ import annotations

import numpy as np

_random = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 2**64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below count."""
    if len(_powers[0]) < count:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            steps = np.full(count, base, np.uint64)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:count], _powers[1][:count]


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def spans(data: np.ndarray, at: np.ndarray, breaks: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every word in ``data``, and the number of words of each text (texts begin at ``at``).

    ``breaks`` marks the bytes that part words.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at) - 1, np.int64)
    solid = ~breaks[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    begins = solid.copy()
    begins[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid
    ends[:-1] &= ~solid[1:] | edge[1:n]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return begin, end, np.diff(np.searchsorted(begin, at))


def keys(lowered: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(begin):
        return np.zeros(0, np.uint64)
    up, down = powers(len(lowered) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(lowered) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[lowered] * up[: len(lowered)], out=total[1:])
        found = (total[end] - total[begin]) * down[begin]
        return mix(found + (end - begin).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def word_keys(data: np.ndarray, at: np.ndarray, breaks: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Key of every word in order, and the number of words of each text."""
    begin, end, count = spans(data, at, breaks)
    return keys(LOWER[data], begin, end), count
