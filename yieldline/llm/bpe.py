"""BPE encoding and decoding with forced boundaries (see `encoding.ForcedBoundaryEncoder`).

Byte pairs that occur inside no vocabulary token mark certain cuts. Each fragment between cuts is encoded on
its own, every distinct fragment of a slice once, and the ids are put together again.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.llm.columns import slices
from yieldline.llm.encoding import ForcedBoundaryEncoder


@functools.lru_cache(maxsize=2)
def byte_encoder(path: str) -> ForcedBoundaryEncoder:
    """One encoder per worker and vocabulary."""
    return ForcedBoundaryEncoder(path)


def id_bytes(ids: np.ndarray) -> memoryview:
    """Ids as little-endian unsigned 32-bit integers."""
    return memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")


def encode(docs: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """`docs` with a column of token ids (array of int). Null and empty text give an empty array.

    `path` is the vocabulary file, which every executor must have. Rows, their order and other columns stay;
    a column already named like `into` is replaced. No shuffle.
    """
    kept = docs.drop(into)
    schema = kept.withColumn(into, F.expr("CAST(array() AS array<int>)")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in slices(batches, text):
            ids, offsets = encoder.column(batch.column(batch.schema.get_field_index(text)))
            lists = pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, into])

    return kept.mapInArrow(work, schema)


def decode(rows: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """`rows` with the text of an id column, special tokens included. Null ids give an empty text."""
    kept = rows.drop(into)
    schema = kept.withColumn(into, F.lit("")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index(ids))
            offsets = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
            texts = encoder.decoded(lists.flatten().to_numpy(zero_copy_only=False), offsets.astype(np.int64))
            column = pa.array([t.decode() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, into])

    return kept.mapInArrow(work, schema)


def round_trip_digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of the ids and of the text decoded from them, without shipping either back to the JVM.

    Columns: key, n_tokens, ids_sha256, decoded_sha256. One row per input row; a null text is empty.
    """
    schema = f"{key} long, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in slices(batches, text):
            ids, offsets = encoder.column(batch.column(1))
            whole = id_bytes(ids)
            spans = list(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(offsets), pa.int64()),
                    pa.array([hashlib.sha256(whole[4 * a : 4 * b]).hexdigest() for a, b in spans], pa.string()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in encoder.decoded(ids, offsets)], pa.string()),
                ],
                names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col(key).cast("long").alias(key), F.col(text).cast("string").alias(text)).mapInArrow(work, schema)
