"""Words and shingles of UTF-8 bytes as 64-bit hashes, vectorised over one text."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_random = np.random.default_rng(20240229)
#: A random 64-bit value for each byte.
BYTE_VALUE = _random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: The same with A-Z read as a-z.
LOWER_VALUE = BYTE_VALUE.copy()
LOWER_VALUE[0x41:0x5B] = BYTE_VALUE[0x61:0x7B]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _table(name: str, factor: int, size: int) -> np.ndarray:
    """Powers of ``factor`` modulo 2**64, at least ``size`` of them."""
    if len(_powers[name]) < size:
        length = max(size, 1 << 16)
        powers = np.full(length, np.uint64(factor), dtype=np.uint64)
        powers[0] = 1
        _powers[name] = np.multiply.accumulate(powers)
    return _powers[name]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of a text's bytes."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    edges = np.diff(inside)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(text: bytes, values: np.ndarray = LOWER_VALUE) -> np.ndarray:
    """One 64-bit hash per word, A-Z read as a-z."""
    data = np.frombuffer(text, dtype=np.uint8)
    starts, ends = word_bounds(data)
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    down, up = _table("down", _INVERSE, len(data) + 1), _table("up", _BASE, len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * down[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * up[starts] + (ends - starts).astype(np.uint64))


def exact_word_hashes(text: bytes) -> np.ndarray:
    """One 64-bit hash per word, letters as they are."""
    return word_hashes(text, BYTE_VALUE)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words; a shorter text is one shingle."""
    h = word_hashes(text)
    if not len(h):
        return h
    size = min(words, len(h))
    joined = np.full(len(h) - size + 1, np.uint64(size), dtype=np.uint64)
    for k in range(size):
        joined = mix(joined * np.uint64(_BASE) + h[k:k + len(joined)])
    return np.unique(joined)
