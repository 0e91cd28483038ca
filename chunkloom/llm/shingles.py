"""Words, shingles and MinHash signatures of a text, in numpy.

Words are runs of bytes other than space and 0x09 to 0x0D after A-Z have been
lower-cased.  Everything here works on one text; Spark hands texts over in Arrow
batches.
"""

from __future__ import annotations

import numpy as np

WORDS = 5

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASK = (1 << 64) - 1


def _numbers(count: int, seed: int) -> np.ndarray:
    """Fixed random 64-bit numbers."""
    return np.random.Generator(np.random.PCG64(seed)).integers(
        0, _MASK, size=count, dtype=np.uint64, endpoint=True
    )


_BYTE = _numbers(256, 1)
_FOLD = _numbers(WORDS, 2) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64, at least ``n`` of each."""
    if len(_POWERS[0]) < n:
        size = 1 << (n - 1).bit_length()
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, dtype=np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order, without a loop over words."""
    data = np.frombuffer(text.lower(), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    edge = np.diff(np.concatenate(([True], _SPACE[data], [True])).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _powers(len(data))
    sums = np.concatenate(
        (np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64))
    )
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingles(text: bytes) -> np.ndarray:
    """The distinct hashes of the text's five-word shingles, sorted.

    With fewer words the whole sequence is one; without any the set is empty.
    """
    words = word_hashes(text)
    if not len(words):
        return words
    n = max(len(words) - WORDS + 1, 1)
    folded = np.zeros(n, dtype=np.uint64)
    for k in range(min(WORDS, len(words))):
        folded += words[k : k + n] * _FOLD[k]
    return np.unique(mix(folded + np.uint64(min(WORDS, len(words)))))


class MinHash:
    """``size`` minima over a set of hashes, 16 bits of each."""

    def __init__(self, size: int, seed: int = 7):
        self.size = size
        self.seeds = _numbers(size, seed)[:, None]

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        least = np.full(self.size, _MASK, dtype=np.uint64)
        for i in range(0, len(hashes), 4096):
            x = (hashes[None, i : i + 4096] ^ self.seeds) * np.uint64(0xD6E8FEB86659FD93)
            x ^= x >> np.uint64(32)
            x *= np.uint64(0xD6E8FEB86659FD93)
            least = np.minimum(least, x.min(axis=1))
        return (mix(least) & np.uint64(0xFFFF)).astype(np.uint16)


def set_digest(hashes: np.ndarray) -> bytes:
    """16 bytes that stand for a set, from sums of its mixed members and its size."""
    a = np.sum(mix(hashes + np.uint64(1)), dtype=np.uint64)
    b = np.sum(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64) + np.uint64(len(hashes))
    return a.tobytes() + b.tobytes()
