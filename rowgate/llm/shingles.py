"""Word shingles of a text as 64-bit hashes, and MinHash values of a set of them."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_ONE = np.uint64(1)


def _stream(n: int, seed: int) -> np.ndarray:
    """n well-mixed 64-bit numbers, the same in every process."""
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = _stream(256, 11)
_PLACE = _stream(WORDS + 1, 12) | _ONE
_BASE = int(_stream(1, 13)[0]) | 5
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        grown = []
        for base in (_BASE, _INVERSE):
            values = np.ones(1, np.uint64)
            while len(values) < size:  # the second half is the first one times base**len
                step = np.uint64(pow(base, len(values), 1 << 64))
                values = np.concatenate([values, values * step])
            grown.append(values)
        _powers = (grown[0], grown[1])
    return _powers


def word_hashes(text: bytes) -> np.ndarray:
    """A hash per word: the polynomial of its bytes, from one running sum over the text."""
    x = np.frombuffer(text, dtype=np.uint8)
    if not len(x):
        return np.empty(0, np.uint64)
    inside = np.concatenate([[False], ~_BLANK[x], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    power, inverse = _powers_to(len(x) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[x] * power[: len(x)])])
    return _mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: bytes) -> np.ndarray:
    """The distinct shingles of five words, sorted. A text of one to four words is one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(1, len(words) - WORDS + 1)
    hashes = np.full(n, min(len(words), WORDS), dtype=np.uint64) * _PLACE[WORDS]
    for k in range(min(WORDS, len(words))):
        hashes += words[k : k + n] * _PLACE[k]
    return np.unique(_mix(hashes))


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def minhashes(shingles: np.ndarray, n: int) -> np.ndarray:
    """n MinHash values; the set is not empty."""
    factor, offset = _stream(n, 14) | _ONE, _stream(n, 15)
    best = np.full(n, np.iinfo(np.uint64).max, dtype=np.uint64)
    for first in range(0, len(shingles), 1024):
        some = np.multiply.outer(factor, shingles[first : first + 1024])
        some += offset[:, None]
        np.minimum(best, some.min(axis=1), out=best)
    return best


def tree_labels(shingles: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each tree, a hash of the first ``depth`` MinHash values of its own."""
    values = minhashes(shingles, trees * depth).reshape(trees, depth)
    label = np.arange(1, trees + 1, dtype=np.uint64)
    for level in range(depth):
        label = _mix(label * _PLACE[0] + values[:, level])
    return label.view(np.int64)
