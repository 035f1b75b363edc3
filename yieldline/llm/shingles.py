"""Sets of word shingles as 64-bit hashes, computed for a whole Arrow column at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from yieldline.llm.columns import flat, mixed, runs, word_hashes

# Bytes of text at once; the hash of byte ranges takes some 30 bytes for each.
SLICE = 2 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _chained(hashes: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """One hash for `count` words from each start on, in their order."""
    value = np.full(len(starts), count, np.uint64)
    for i in range(count):
        value = mixed(value * _STEP + hashes[starts + i])
    return value


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """For each row the sorted distinct hashes of its shingles.

    Words are runs of anything but U+0020 and U+0009 to U+000D, with A-Z lower-cased. A row with fewer than `words`
    words has one shingle, all of it; one without words has none.
    """
    data, offsets = flat(column)
    low = data.copy()
    low[(data >= 65) & (data <= 90)] += 32
    starts, ends = runs((low != 32) & ((low < 9) | (low > 13)), offsets)
    hashes = word_hashes(low, starts, ends)
    first = np.searchsorted(starts, offsets)
    per_row = np.diff(first)
    last = np.repeat(first[1:], per_row)
    index = np.arange(len(starts))
    whole = index + words <= last
    values = _chained(hashes, index[whole], words)
    until = np.concatenate([[0], np.cumsum(np.maximum(per_row - words + 1, 0))])
    sets = []
    for i, n in enumerate(per_row.tolist()):
        if n >= words:
            sets.append(np.unique(values[until[i] : until[i + 1]]))
        elif n:
            sets.append(_chained(hashes, first[i : i + 1], n))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
