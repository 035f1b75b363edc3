"""Arrow columns inside tasks: texts as one byte array with offsets, hashes of byte ranges, ragged gathers."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text that a task works on at once. A longer text is a slice of its own.
SLICE_BYTES = 6 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and where each row begins (one more entry at the end). Null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    buffers = column.buffers()
    if len(column) == 0 or buffers[1] is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of whole rows with about `limit` bytes of text."""
    for batch in batches:
        _, offsets = flat(batch.column(batch.schema.get_field_index(column)))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on, idle, while other stages need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= _MIX1
    values ^= values >> np.uint64(27)
    values *= _MIX2
    values ^= values >> np.uint64(31)
    return values


_BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, count: int) -> np.ndarray:
    """base ** 0, 1, 2 ... modulo 2**64, kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps, dtype=np.uint64)
        if len(known) > SLICE_BYTES:  # a very long text; do not hold on to its table
            _powers.pop(base)
    return known[:count]


class RangeHash:
    """64-bit hashes of any byte ranges of one array, equal for equal content wherever it lies."""

    def __init__(self, data: np.ndarray):
        terms = _BYTE_VALUES[data]
        terms *= _power(_BASE, len(data))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(terms, out=self._sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        values = self._sums[ends] - self._sums[starts]
        values *= _power(_INVERSE, len(self._sums))[starts]
        return mixed(values ^ ((ends - starts).astype(np.uint64) * _ODD))


# Two texts of 1,024 bytes can be built that `RangeHash` takes for one; below this length none are known.
LONG_WORD = 256


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words. Long ones are hashed by themselves, as range hashes of long texts can be made to collide."""
    values = RangeHash(data)(starts, ends)
    for i in np.flatnonzero(ends - starts >= LONG_WORD).tolist():
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        values[i] = int.from_bytes(digest, "little")
    return values


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that do not cross a row's end."""
    if not len(inside):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    rows = np.zeros(len(inside) + 1, bool)
    rows[offsets] = True
    before = np.empty(len(inside), bool)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | rows[:-1]))
    after = np.empty(len(inside), bool)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | rows[1:])) + 1
    return starts, ends


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """values[s : s + n] for each (s, n), one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column over bytes that are already there."""
    return pa.StringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )
