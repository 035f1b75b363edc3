"""Last result of every board at every station, kept up to date by a stream of bookings.

Two ways: `start_boards` keeps no state, `start_board_states` a keyed one. Counting distinct boards is not allowed on a stream. The highest attempt per result is a maximum,
and maxima combine, over the batches of a stream and over streams: each micro-batch commits one small row per touched
board, and the log of batches is folded by the same maxima.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from yieldline.functions.conditional import max_where
from yieldline.operators.attempts import is_fail, is_pass
from yieldline.sources.layered import Log, Member
from yieldline.streaming.clock import stream_of

BOARD = ("station_number", "serial_number")
TOPS = ("top_attempt", "top_fail", "top_pass")
TOPS_SCHEMA = T.StructType([*[T.StructField(c, T.StringType()) for c in BOARD], *[T.StructField(c, T.IntegerType()) for c in TOPS]])


def tops(bookings: DataFrame) -> DataFrame:
    attempt = F.col("test_count")
    return bookings.groupBy(*BOARD).agg(
        F.max(attempt).alias("top_attempt"),
        max_where(is_fail(), attempt).alias("top_fail"),
        max_where(is_pass(), attempt).alias("top_pass"),
    )


def highest(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*BOARD).agg(*[F.max(c).alias(c) for c in TOPS])


def board_log(spark: SparkSession, path: str) -> Log:
    return Log(spark, path, {"rows": Member(TOPS_SCHEMA, sort=BOARD, fold=highest)})


def start_boards(bookings: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        board_log(batch.sparkSession, path).append(tops(batch), stream_of(batch), batch_id)

    return (
        bookings.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


# A clock that is set back by less than this between two runs loses nothing.
DELAY = "1 hour"


def board_states(bookings: DataFrame, forget_after_ms: int) -> DataFrame:
    """Changed tops of each board, out of a keyed state that is dropped when its time is over.

    Time of arrival is cut into periods of `forget_after_ms`; a board has a state for each period in which it is seen, which
    is dropped after the period. A booking that changes nothing gives no row: each top has the first arrival of its attempt
    beside it, and has changed if that is the arrival of this batch. A board that comes back in another period starts anew;
    readers take maxima, so they keep what it had.
    """
    timed = bookings.select(*BOARD, "test_count", "book_state").withColumn("arrived", F.current_timestamp())
    since = F.unix_micros("arrived")
    attempt = F.when(F.col("test_count").isNotNull(), F.struct("test_count", (-since).alias("before")))
    tops = {"top_attempt": F.max(attempt), "top_fail": max_where(is_fail(), attempt), "top_pass": max_where(is_pass(), attempt)}
    period = F.window("arrived", f"{forget_after_ms} milliseconds")
    kept = timed.withWatermark("arrived", DELAY).groupBy(period, *BOARD)
    kept = kept.agg(*[top.alias(c) for c, top in tops.items()], F.max(since).alias("now"))
    new = [F.coalesce(-F.col(f"{c}.before") == F.col("now"), F.lit(False)) for c in TOPS]
    return kept.where(new[0] | new[1] | new[2]).select(*BOARD, *[F.col(f"{c}.test_count").alias(c) for c in TOPS])


def start_board_states(
    bookings: DataFrame, path: str, checkpoint: str, forget_after_ms: int = 30 * 24 * 3600 * 1000, **trigger
) -> StreamingQuery:
    """The same log as `start_boards`, with a row only for boards whose result a batch changes. Keeps its state in RocksDB.

    The default trigger takes what is there in one batch. A checkpoint of the earlier state, which was kept by a Python function,
    cannot be continued: start a new one beside the same log, as readers take maxima.
    """
    spark = bookings.sparkSession

    def write(changed: DataFrame, batch_id: int) -> None:
        board_log(changed.sparkSession, path).append(changed, stream_of(changed), batch_id)

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return (
            board_states(bookings, forget_after_ms)
            .writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"once": True}))
            .start()
        )
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def last_results(spark: SparkSession, path: str) -> DataFrame:
    """(station, board) -> latest attempt and whether it failed or passed."""
    return judged(highest(board_log(spark, path).read()))


def judged(merged: DataFrame) -> DataFrame:
    latest = F.col("top_attempt")
    return merged.select(
        *BOARD,
        latest.alias("latest_attempt"),
        F.coalesce(F.col("top_fail") == latest, F.lit(False)).alias("failed"),
        F.coalesce(F.col("top_pass") == latest, F.lit(False)).alias("passed"),
    )
