"""Sets of word shingles as sorted arrays of 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

#: Odd multipliers from the digits of the golden ratio and their kin, for mixing (fixed values).
MIX = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers well mixed; different numbers stay different."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX[1]
    x = x ^ (x >> np.uint64(27))
    x = x * MIX[2]
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, A-Z in lower case, and the bounds of each text in them. Words end at
    blanks and at the control characters tab to carriage return."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words, offsets = split.flatten(), split.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if not len(words):
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    coded = words.dictionary_encode()
    distinct = coded.dictionary.to_numpy(zero_copy_only=False)
    codes = coded.indices.to_numpy()
    real = (distinct != "")[codes]
    bounds = np.concatenate([[0], np.cumsum(real)])[offsets]
    return pd.util.hash_array(distinct, categorize=False)[codes[real]], bounds


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles. A text of fewer words has one
    shingle, all its words; a text without words has none."""
    words, bounds = word_hashes(texts)
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64) * MIX[0]) | np.uint64(1)
    n = max(len(words) - width + 1, 0)
    all_of_them = np.zeros(n, np.uint64)
    for j in range(width):
        all_of_them += words[j : j + n] * factors[j]
    all_of_them = mixed(all_of_them)
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if high - low >= width:
            yield np.unique(all_of_them[low : high - width + 1])
        elif high > low:
            k = high - low
            short = (words[low:high] * factors[:k]).sum(dtype=np.uint64, keepdims=True)
            yield mixed(short + np.uint64(width - k) * MIX[0])
        else:
            yield np.empty(0, np.uint64)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    both = np.intersect1d(a, b, assume_unique=True).size
    return 100 * both >= percent * (len(a) + len(b) - both) and both > 0
