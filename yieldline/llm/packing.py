"""Packing documents into sequences of a fixed length with a bounded number of open windows.

Each task reads its documents once. Whole windows of a long document are sequences of their own; the rest goes to the
open window that it fits best. Where none fits and all `open_windows` are in use, the fullest is closed. What is
still open at the end of a task is merged with the leftovers of other tasks, a fixed number of tasks at a time.
Windows hold lengths only, so a task's memory does not grow with its input.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.llm.bpe import byte_encoder, id_bytes
from yieldline.llm.columns import slices
from yieldline.session import new_folder

# Tasks whose leftovers are merged together: at most TOGETHER * open_windows windows meet in one group.
TOGETHER = 64
PIECES = "part long, window long, leftover boolean, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, offset long"


class OpenWindows:
    """Windows that still take pieces, ordered by the room they have left."""

    def __init__(self, size: int, most: int):
        self.size, self.most, self.made = size, most, 0
        self.free: list[tuple[int, int]] = []

    def place(self, length: int) -> tuple[int, int]:
        """Window and offset for a piece of at most `size`."""
        at = bisect.bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, window = self.free.pop(at)
        else:
            if len(self.free) == self.most:
                self.free.pop(0)
            room, window = self.size, self.fresh()
        if room > length:
            bisect.insort(self.free, (room - length, window))
        return window, self.size - room

    def fresh(self) -> int:
        self.made += 1
        return self.made - 1


def pack(
    docs: DataFrame, path: str, size: int = 2048, end_id: int = 1, open_windows: int = 64, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents with their place: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and `end_id`; null and empty text are `end_id` alone. Repeated rows and rows without a key are
    packed like any other. An empty table gives no pieces. Other columns of `docs` are not read.
    """
    spark = docs.sparkSession

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = byte_encoder(path), TaskContext.get().partitionId()
        windows = OpenWindows(size, open_windows)
        names = [f.split()[0] for f in PIECES.split(", ")]
        for batch in slices(batches, text):
            ids, offsets = encoder.column(batch.column(1))
            keys = batch.column(0).to_pylist()
            rows = []
            for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                own = id_bytes(np.append(ids[a:b], np.uint32(end_id)))
                total = b - a + 1
                for start in range(0, total, size):
                    length = min(size, total - start)
                    window, offset = windows.place(length) if length < size else (windows.fresh(), 0)
                    crc = zlib.crc32(own[4 * start : 4 * (start + length)])
                    rows.append((part, window, False, keys[i], start, length, crc, total, offset))
            yield _table(rows, names)
        yield _table([(part, w, True, None, 0, size - room, 0, 0, 0) for room, w in windows.free], names)

    folder = new_folder(spark, "packing")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias(text))
    rows.mapInArrow(work, PIECES).write.parquet(folder)
    written = spark.read.schema(PIECES).parquet(folder)
    moved = merged_leftovers(written.where("leftover").select("part", "window", F.col("length").alias("used")), size)
    return (
        written.where("NOT leftover")
        .join(moved, ["part", "window"], "left")
        .select(
            "doc_id",
            "start",
            "length",
            "ids_crc32",
            "doc_tokens",
            F.coalesce("sequence_id", F.expr("shiftleft(part, 32) + window")).alias("sequence_id"),
            (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
        )
    )


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.bool_() if n == "leftover" else pa.int64() for n in names]
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def merged_leftovers(leftovers: DataFrame, size: int) -> DataFrame:
    """Sequence and offset of each leftover window, best fit from the longest on within TOGETHER tasks."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["used", "part", "window"], ascending=[False, True, True])
        windows = OpenWindows(size, len(group) + 1)
        places = [windows.place(int(used)) for used in group["used"]]
        first = (1 << 62) + (int(group["part"].iloc[0]) // TOGETHER << 32)
        return pd.DataFrame(
            {
                "part": group["part"],
                "window": group["window"],
                "sequence_id": [first + w for w, _ in places],
                "base": [offset for _, offset in places],
            }
        )

    by = F.expr(f"part DIV {TOGETHER}")
    return leftovers.groupBy(by.alias("tasks")).applyInPandas(merge, "part long, window long, sequence_id long, base long")
