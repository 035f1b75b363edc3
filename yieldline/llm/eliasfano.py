"""Token ids as binary blocks with Elias-Fano encoded document boundaries.

A block holds the ids of consecutive documents in one array. The ends of the documents are a rising sequence below
U = number of ids: the lowest l = log2(U / n) bits of each are stored as they are, the rest as a bit vector in unary, about
2 + l bits a document in all. Every 64th set bit has a sample, so the i-th boundary is found by counting
in at most a few words. Document ids are a second such sequence.

Blocks are rows of a table written and read by Spark, so they live in any store that Spark reaches and a lost task
leaves nothing behind.
"""

from __future__ import annotations

import functools
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldline.llm.bpe import id_bytes
from yieldline.llm.columns import slices
from yieldline.llm.encoding import LowerCaseWordEncoder

SAMPLE = 64
# A block is closed once it has so many ids.
BLOCK_IDS = 1 << 20
# Larger slices and more remembered fragments than elsewhere: words of this vocabulary are dear to encode.
SLICE, REMEMBERED = 12 << 20, 150_000
MAGIC = b"EFB1"
BLOCKS = "shard int, block int, before long, n_docs long, n_ids long, payload binary"


class EliasFano:
    """A sequence of n rising whole numbers (ties allowed) from 0 to below 2**63."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        top = int(values[-1]) + 1 if len(values) else 1
        bits = max(0, (top // max(len(values), 1)).bit_length() - 1)
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(len(values))
        unary = np.zeros(int(ones[-1]) + 1 if len(ones) else 0, bool)
        unary[ones] = True
        low = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        return cls(
            len(values),
            bits,
            np.packbits(low.astype(bool).reshape(-1), bitorder="little"),
            np.packbits(unary, bitorder="little"),
            ones[::SAMPLE].astype("<u4"),
        )

    def _low(self, first: int, count: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(count, np.uint64)
        start = first * self.low_bits
        some = np.unpackbits(self.low[start // 8 : (start + count * self.low_bits + 7) // 8], bitorder="little")
        some = some[start % 8 : start % 8 + count * self.low_bits].reshape(count, self.low_bits).astype(np.uint64)
        return (some << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        return ((ones - np.arange(self.count)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(0, self.count)

    def select(self, index: int) -> int:
        """The value at `index`: from the sample before it, count set bits byte by byte."""
        place = int(self.samples[index // SAMPLE])
        left, byte = index % SAMPLE, place // 8
        word = int(self.high[byte]) >> (place % 8) << (place % 8)
        while word.bit_count() <= left:
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        one = byte * 8 + (word & -word).bit_length() - 1
        return (one - index) << self.low_bits | int(self._low(index, 1)[0])

    def to_bytes(self) -> bytes:
        parts = [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]
        return struct.pack("<QBQQQ", self.count, self.low_bits, *map(len, parts)) + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The sequence and how many bytes it took."""
        count, bits, *sizes = struct.unpack_from("<QBQQQ", data)
        ends = np.cumsum([struct.calcsize("<QBQQQ"), *sizes]).tolist()
        low, high, samples = (np.frombuffer(data[a:b], np.uint8) for a, b in zip(ends[:-1], ends[1:], strict=True))
        return cls(count, bits, low, high, samples.view("<u4")), ends[-1]


class Block:
    """Documents of one block: their keys (None first), boundaries and ids."""

    def __init__(self, keys: list[int | None], ends: np.ndarray, ids: np.ndarray):
        self.keys, self.ends, self.ids = keys, ends, ids

    def to_bytes(self, width: int) -> bytes:
        known = np.array([k for k in self.keys if k is not None], np.int64)
        first = int(known[0]) if len(known) else 0
        gaps = (known.astype(np.uint64) - np.uint64(first & (1 << 64) - 1)) if len(known) else known
        head = MAGIC + struct.pack("<BQq", width, len(self.keys) - len(known), first)
        return head + EliasFano.of(gaps).to_bytes() + EliasFano.of(self.ends).to_bytes() + self.ids.astype(f"<u{width}").tobytes()


class StoredBlock:
    """Reads a block's bytes; ids and boundaries are only looked at where asked for."""

    def __init__(self, payload: bytes):
        data = memoryview(payload)
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a block of token ids")
        width, self.without_key, self.first = struct.unpack_from("<BQq", data, 4)
        at = 4 + struct.calcsize("<BQq")
        self.gaps, used = EliasFano.from_bytes(data[at:])
        self.ends, more = EliasFano.from_bytes(data[at + used :])
        self.ids = np.frombuffer(data[at + used + more :], f"<u{width}")

    def keys(self) -> list[int | None]:
        return [None] * self.without_key + [int(g) + self.first for g in self.gaps.all()]

    def document(self, index: int) -> np.ndarray:
        """Ids of one document by two selects."""
        return self.ids[self.ends.select(index - 1) if index else 0 : self.ends.select(index)]


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> LowerCaseWordEncoder:
    return LowerCaseWordEncoder(path, REMEMBERED)


def write(docs: DataFrame, folder: str, path: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode every text, append `end_id`, and write blocks in ascending key order to `folder`.

    Texts are dealt by ranges of the key and sorted before they are encoded, so the ids are never shuffled. Null and empty
    texts are `end_id` alone. Rows without a key come first; rows with the same key follow in order of their text. Other
    columns are not read. An empty table writes no blocks.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard = _encoder(path), TaskContext.get().partitionId()
        width = 2 if encoder.library.get_vocab_size() <= 1 << 16 else 4
        before = number = 0
        for batch in slices(batches, text, SLICE):
            ids, offsets = encoder.column(batch.column(1))
            keys = batch.column(0).to_pylist()
            ids = np.insert(ids, offsets[1:], end_id)
            offsets = offsets + np.arange(len(offsets))
            first = 0
            while first < len(keys):
                last = int(np.searchsorted(offsets, offsets[first] + BLOCK_IDS))
                last = min(max(last, first + 1), len(keys))
                a, b = int(offsets[first]), int(offsets[last])
                payload = Block(keys[first:last], offsets[first + 1 : last + 1] - a, ids[a:b]).to_bytes(width)
                row = (shard, number, before, last - first, b - a, payload)
                yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True))], schema)
                before, number, first = before + b - a, number + 1, last

    names = [f.split()[0] for f in BLOCKS.split(", ")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in BLOCKS.split(", "))])
    rows = docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text))
    rows.repartitionByRange(key).sortWithinPartitions(key, text).mapInArrow(work, BLOCKS).write.parquet(folder)


def shard_starts(spark: SparkSession, folder: str) -> dict[int, int]:
    """Ids before each shard. One number per writing task comes to the driver."""
    totals = spark.read.schema(BLOCKS).parquet(folder).groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard")
    starts, at = {}, 0
    for shard, n in totals.collect():
        starts[shard], at = at, at + n
    return starts


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per stored document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32; from the files alone."""
    starts = shard_starts(spark, folder)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, before, payload in zip(*(batch.column(i) for i in range(3)), strict=True):
                block = StoredBlock(payload.as_py())
                ends = block.ends.all().astype(np.int64)
                begins = np.concatenate([[0], ends[:-1]])
                ids = id_bytes(block.ids)
                crcs = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
                base = starts[shard.as_py()] + before.as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block.keys(), pa.int64()), pa.array(begins + base), pa.array(ends - begins), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    stored = spark.read.schema(BLOCKS).parquet(folder).select("shard", "before", "payload")
    return stored.mapInArrow(work, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Per stored document: doc_id and its ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0):
                block = StoredBlock(payload.as_py())
                offsets = np.concatenate([[0], block.ends.all()]).astype(np.int32)
                lists = pa.ListArray.from_arrays(offsets, block.ids.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(block.keys(), pa.int64()), lists], names=["doc_id", "ids"])

    return spark.read.schema(BLOCKS).parquet(folder).select("payload").mapInArrow(work, "doc_id long, ids array<int>")
