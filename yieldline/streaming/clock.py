"""What a stream's micro-batches note under their own id, and the event-time clock among it.

Batch ids start at 0 again with every new checkpoint, so everything a batch writes lies under the id of its stream, which
lives in the checkpoint, and the batch id. Another stream, or the same source behind a new checkpoint, never meets these
folders, and a replayed batch finds its own.

The clock is the newest booking of all earlier micro-batches of a stream. Each batch notes it for its successor, so reading it
touches one row however long the stream has been running.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldline.functions.timing import GRAIN_SECONDS, bucket, duration
from yieldline.sources.tables import read_or_empty

CLOCK = T.StructType([T.StructField("latest", T.TimestampNTZType())])
# Stream of batches that are stored by hand, outside a streaming query.
BY_HAND = "by-hand"


def stream_of(batch: DataFrame) -> str:
    """Id of the streaming query that runs this micro-batch; it outlives restarts from the checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or BY_HAND


def batch_folder(path: str, stream: str, batch_id: int) -> str:
    return f"{path}/stream={stream}/batch_id={batch_id}"


def clock_before(spark: SparkSession, path: str, stream: str, batch_id: int) -> str | None:
    """Time of the newest booking before this batch, as text; None at the start."""
    rows = read_or_empty(spark, batch_folder(path, stream, batch_id - 1), CLOCK)
    row = rows.select(F.col("latest").cast("string")).first()
    return row[0] if row else None


def note_clock(bookings: DataFrame, path: str, stream: str, batch_id: int, before: str | None) -> None:
    newest = F.greatest(F.max("date_created"), F.lit(before).cast("timestamp_ntz")).alias("latest")
    bookings.agg(newest).write.mode("overwrite").parquet(batch_folder(path, stream, batch_id))


def is_late(clock: str | None, late_after: int, grain: str = "hour") -> Column:
    """Whether a booking's bucket ended `late_after` seconds or more before the clock."""
    if clock is None:
        return F.lit(False)
    closed = F.lit(clock).cast("timestamp_ntz") - duration(late_after)
    return bucket("date_created", grain) + duration(GRAIN_SECONDS[grain]) <= closed
