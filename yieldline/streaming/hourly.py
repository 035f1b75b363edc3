"""Hourly KPIs that keep up with a stream of bookings.

Two ways are offered, and neither drops a booking. `start_windows` aggregates in a state store. Its watermark is over the
time of arrival, so the state holds the last hours of arrivals only, and no booking is ever behind it, however old or far
ahead its own time is; what arrives later for an hour becomes a further partial result, and readers add up.
`start_routed` keeps no state: each micro-batch writes the partial aggregates of its on-time bookings and a list of its late
ones under its stream and batch id, and readers add them up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from yieldline.functions.conditional import count_where
from yieldline.functions.timing import bucket
from yieldline.operators.attempts import is_fail, is_pass
from yieldline.plans.availability import uptime_columns, uptime_micros
from yieldline.schemas import STATION_RECORDS
from yieldline.sources.layered import Log, Member
from yieldline.sources.tables import Warehouse
from yieldline.streaming.clock import clock_before, is_late, note_clock, stream_of

COUNT_NAMES = ("sum_cycle_time", "count_bookings", "fail_bookings", "pass_bookings")


def counts() -> list[Column]:
    return [
        F.sum("cycle_time").alias("sum_cycle_time"),
        F.count("serial_number").alias("count_bookings"),
        count_where(is_fail(), F.col("serial_number")).alias("fail_bookings"),
        count_where(is_pass(), F.col("serial_number")).alias("pass_bookings"),
    ]


def spans() -> list[Column]:
    return [
        F.min("date_created").alias("first"),
        F.max("date_created").alias("last"),
        F.count("date_created").alias("bookings"),
    ]


def windowed(bookings: DataFrame, keys: list[str], aggregates: list[Column], delay: str) -> DataFrame:
    """Results per hour of event time and hour of arrival; state lives until `delay` after the hour of arrival."""
    timed = bookings.withColumn("arrived", F.current_timestamp()).withColumn("date_hour", bucket("date_created"))
    arrival = F.window("arrived", "1 hour")
    hours = timed.withWatermark("arrived", delay).groupBy(arrival, *keys, "date_hour").agg(*aggregates)
    return hours.withColumn("arrival_hour", F.col("window.start")).drop("window")


def hourly_counts(bookings: DataFrame, delay: str = "2 hours") -> DataFrame:
    return windowed(bookings, ["station_number", "part_number"], counts(), delay)


def hourly_spans(bookings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """First, last and number of bookings per station-hour: all that availability needs."""
    return windowed(bookings, ["station_number"], spans(), delay)


def availability_of(hours: DataFrame) -> DataFrame:
    micros = uptime_micros(F.col("first"), F.col("last"), F.col("bookings"))
    return hours.select("station_number", "date_hour", *uptime_columns(micros))


VALUE_NAMES = (*COUNT_NAMES, "first", "last", "bookings")


def newest_windows(rows: DataFrame) -> DataFrame:
    """The newest state of each window of each stream; an earlier one is part of it."""
    keys = [c for c in rows.columns if c not in VALUE_NAMES and c != "batch_id"]
    values = [c for c in rows.columns if c in VALUE_NAMES]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct("batch_id", *values), "batch_id").alias("newest"))
    return newest.select(*keys, "newest.*").select(*rows.columns)


def window_log(spark: SparkSession, path: str, schema: T.StructType) -> Log:
    return Log(spark, path, {"rows": Member(schema, fold=newest_windows)})


def start_windows(hours: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Commit every changed result of a micro-batch with its stream and batch id."""

    def write(changed: DataFrame, batch_id: int) -> None:
        stream = stream_of(changed)
        rows = changed.select("*", F.lit(stream).alias("stream"), F.lit(batch_id).cast("long").alias("batch_id"))
        window_log(changed.sparkSession, path, rows.schema).append(rows, stream, batch_id)

    return (
        hours.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_windows(hours: DataFrame, path: str, keys: list[str]) -> DataFrame:
    """Totals per key: the newest state of each hour of arrival, added up over arrivals and streams.

    `hours` tells the columns, as given to `start_windows`; it is not run.
    """
    schema = hours.select("*", F.lit("").alias("stream"), F.lit(0).cast("long").alias("batch_id")).schema
    newest = newest_windows(window_log(hours.sparkSession, path, schema).read())
    values = [c for c in newest.columns if c in VALUE_NAMES]
    return newest.groupBy(*keys).agg(*[total(F.col(c), c) for c in values])


# partial aggregates per micro-batch --------------------------------------------------------------


def hour_partials(bookings: DataFrame) -> DataFrame:
    return bookings.groupBy(
        "station_number", "part_number", bucket("date_created").alias("date_hour")
    ).agg(*counts(), *spans())


def total(values: Column, name: str) -> Column:
    """How a column of partial results adds up."""
    if name in ("first", "last"):
        return (F.min(values) if name == "first" else F.max(values)).alias(name)
    added = F.sum(values)
    return (added.cast("decimal(20,2)") if name == "sum_cycle_time" else added).alias(name)


def add_up(partials: DataFrame) -> DataFrame:
    """Hourly totals out of partial aggregates of any number of batches."""
    keys = ["station_number", "part_number", "date_hour"]
    return partials.groupBy(*keys).agg(*[total(F.col(c), c) for c in VALUE_NAMES])


def with_late(on_time: DataFrame, late: DataFrame) -> DataFrame:
    """Totals of on-time partials plus the late bookings, which are aggregated on reading."""
    return add_up(on_time.unionByName(hour_partials(late)))


PARTIALS = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in ("station_number", "part_number")],
        T.StructField("date_hour", T.TimestampNTZType()),
        T.StructField("sum_cycle_time", T.DecimalType(20, 2)),
        *[T.StructField(c, T.LongType()) for c in COUNT_NAMES[1:]],
        *[T.StructField(c, T.TimestampNTZType()) for c in ("first", "last")],
        T.StructField("bookings", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Routed:
    """Where `start_routed` keeps on-time partials and late bookings. Finished batches are folded: partials are added up."""

    warehouse: Warehouse
    name: str

    def _log(self, part: str, member: Member) -> Log:
        return Log(self.warehouse.spark, self.warehouse.path(f"{self.name}/{part}"), {"rows": member})

    @property
    def on_time_log(self) -> Log:
        return self._log("on_time", Member(PARTIALS, fold=lambda rows: add_up(rows).select(*PARTIALS.names)))

    @property
    def late_log(self) -> Log:
        return self._log("late", Member(STATION_RECORDS))

    def on_time(self) -> DataFrame:
        return self.on_time_log.read()

    def late(self) -> DataFrame:
        return self.late_log.read()

    def totals(self) -> DataFrame:
        return with_late(self.on_time(), self.late())


def start_routed(
    warehouse: Warehouse, bookings: DataFrame, name: str, checkpoint: str, late_after: int, **trigger
) -> StreamingQuery:
    """On-time bookings become partials, late ones go to a late table; both are committed with stream and batch id."""
    spark, path, routed = warehouse.spark, warehouse.path(name), Routed(warehouse, name)

    def write(batch: DataFrame, batch_id: int) -> None:
        stream = stream_of(batch)
        clock = clock_before(spark, f"{path}/clock", stream, batch_id)
        belated = is_late(clock, late_after)
        batch = batch.persist()  # read three times
        try:
            partials = add_up(hour_partials(batch.where(~belated))).select(*PARTIALS.names)
            routed.on_time_log.append(partials, stream, batch_id)
            routed.late_log.append(batch.where(belated).select(*STATION_RECORDS.names), stream, batch_id)
            note_clock(batch, f"{path}/clock", stream, batch_id, clock)
        finally:
            batch.unpersist()

    return (
        bookings.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
