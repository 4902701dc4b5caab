"""Word shingles of whole texts as 64-bit hashes."""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from . import arrow_text as at

WIDTH = 5
FACTOR = np.uint64(0x9E3779B97F4A7C15)
SIGN = np.uint64(1 << 63)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its shingles: ``width`` words
    each, A-Z lower-cased; a shorter text has one of all its words, a text
    without words none. Signed, in the order of the unsigned values."""
    from pandas.util import hash_array
    bounds, codes, words = at.word_codes(pc.ascii_lower(texts))
    if not len(codes):
        return [np.zeros(0, np.int64)] * len(texts)
    w = hash_array(words.to_numpy(zero_copy_only=False), categorize=False)[codes]
    rolled = w[:max(len(w) - width + 1, 0)].copy()
    for i in range(1, width):
        rolled = rolled * FACTOR + w[i:len(w) - width + 1 + i]
    rolled = (mixed(rolled) ^ SIGN).view(np.int64)
    out = []
    ends = bounds.tolist()
    for a, b in zip(ends, ends[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            h = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for x in w[a:b]:
                    h = h * FACTOR + x
            out.append((mixed(np.array([h], np.uint64) + np.uint64(1)) ^ SIGN).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
    return out
