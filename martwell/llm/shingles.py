"""Word shingles of whole texts as 64-bit hashes (inside Python tasks)."""

from __future__ import annotations

import numpy as np
import pandas as pd

WORDS = 5
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread function of 64-bit numbers (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Hash of every run of ``words`` words, in order (white space parts words,
    case does not count).  A shorter text with words is one shingle."""
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    h = pd.util.hash_array(np.array(found, dtype=object), categorize=False)
    n = max(1, len(h) - words + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(words, len(h))):
        out = out * _FACTOR + mixed(h[k : k + n])
    return mixed(out)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct hashes; 0 if both are empty."""
    both = np.intersect1d(a, b, assume_unique=True).size
    either = a.size + b.size - both
    return both / either if either else 0.0
