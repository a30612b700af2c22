"""Hashes of word shingles of many texts at once, in numpy.

Bytes get random 64-bit values (A-Z those of a-z) and a word the polynomial of its bytes, taken as the
difference of two running sums. A shingle mixes the hashes of its words in order. Equal shingles have
equal hashes; two of n different ones share a hash with a chance of about n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np

SIZE = 5
CHUNK = 1 << 20

_random = np.random.default_rng(20240601)
_BYTES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[ord("A") : ord("Z") + 1] = _BYTES[ord("a") : ord("z") + 1]
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_PLACES = _random.integers(1, 2**63, SIZE + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base, and of its inverse modulo 2^64, up to n."""
    if not _powers or len(_powers[0]) < n:
        inverse = pow(_BASE, -1, 1 << 64)
        n = max(n, CHUNK + 1)
        one = np.ones(1, np.uint64)
        _powers[:] = [
            np.concatenate((one, np.full(n - 1, base, np.uint64))).cumprod(dtype=np.uint64) for base in (_BASE, inverse)
        ]
    return _powers


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of UTF-8 bytes that begin with white space."""
    up, down = _power_tables(len(data) + 1)
    inside = ~_WHITE[data]
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    starts = edges[0::2]
    ends = edges[1::2] if len(edges) % 2 == 0 else np.append(edges[1::2], len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), (_BYTES[data] * up[: len(data)]).cumsum(dtype=np.uint64)))
    return starts, mixed((sums[ends] - sums[starts]) * down[starts])


def chunks(texts: list[bytes]):
    """Ranges of texts whose bytes together are about CHUNK; a longer text is alone."""
    first, size = 0, 0
    for n, text in enumerate(texts):
        if n > first and size + len(text) > CHUNK:
            yield first, n
            first, size = n, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, len(texts)


def shingle_hashes(texts: list[bytes]):
    """Per text the hashes of its shingles in order, repeats included; a shorter text is one shingle."""
    for a, b in chunks(texts):
        data = np.frombuffer(b"".join(b" " + t for t in texts[a:b]), np.uint8)
        starts, words = word_hashes(data)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts[a : b - 1])])
        bounds = [*np.searchsorted(starts, begins).tolist(), len(words)]
        rolled = np.zeros(max(0, len(words) - SIZE + 1), np.uint64)
        for k in range(SIZE):
            rolled += words[k : k + len(rolled)] * _PLACES[k]
        rolled = mixed(rolled)
        for lo, hi in zip(bounds, bounds[1:], strict=False):
            if hi - lo >= SIZE:
                yield rolled[lo : hi - SIZE + 1]
            elif hi > lo:
                short = (words[lo:hi] * _PLACES[: hi - lo]).sum(dtype=np.uint64, keepdims=True)
                yield mixed(short + _PLACES[SIZE : SIZE + 1] * np.uint64(hi - lo))
            else:
                yield np.zeros(0, np.uint64)
