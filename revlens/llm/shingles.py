"""Word shingles of a text as 64-bit hashes."""

from __future__ import annotations

import functools

import numpy as np
import xxhash

#: Remembered words per worker process; emptied when full.
MEMORY = 500_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(32))) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMORY:
            self.clear()
        own = xxhash.xxh3_64_intdigest(word)
        self[word] = own
        return own


@functools.lru_cache(maxsize=1)
def _words() -> _Words:
    """One memory per worker process."""
    return _Words()


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``size`` words.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z.  With fewer
    words the whole sequence is one shingle; without words the set is empty.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))
    size = min(size, len(h))
    runs = np.full(len(h) - size + 1, size, np.uint64)
    for j in range(size):
        runs = mix(runs) + h[j:len(h) - size + 1 + j]
    return np.unique(mix(runs))
