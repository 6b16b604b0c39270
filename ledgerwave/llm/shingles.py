"""Sets of hashed word shingles of a text, as sorted numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5  # words of a shingle
ALIKE, OF = 80, 100  # Jaccard similarity of 0.8 or more, in whole numbers

_K = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: bytes | None, width: int = WORDS) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words; a shorter text is one run,
    a text without words none. Words lie between ASCII white space; A-Z count as
    a-z."""
    found = (text or b"").lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    width = min(width, n)
    out = np.full(n - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        out = out * _K + h[k : n - width + 1 + k]
    return np.unique(mixed(out))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets have Jaccard similarity of 0.8 or more; empty sets never."""
    small, large = sorted((len(a), len(b)))
    if not small or OF * small < ALIKE * large:
        return False
    both = np.intersect1d(a, b, assume_unique=True).size
    return OF * both >= ALIKE * (len(a) + len(b) - both)
