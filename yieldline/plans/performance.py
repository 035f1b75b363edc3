"""Performance per station, time bucket and part: ideal against actual cycle time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldline.functions.exact import hundredths, mean, rounded_quotient
from yieldline.functions.timing import bucket


def cycle_totals(bookings: DataFrame, grain: str = "hour") -> DataFrame:
    """Cycle-time totals per (station, bucket, part): one partial + final aggregate."""
    return bookings.groupBy(
        "station_number", bucket("date_created", grain).alias("date_hour"), "part_number"
    ).agg(
        F.sum("cycle_time").alias("sum_cycle_time"),
        F.count("cycle_time").alias("timed_bookings"),
        F.count("serial_number").alias("count_bookings"),
    )


def performance_percent(ideal: Column, count: Column, total: Column) -> Column:
    """100 * ideal * count / total to 2 decimals; may exceed 100, NULL when nothing was timed."""
    return rounded_quotient(hundredths(ideal) * count.cast("decimal(15,0)") * 100, hundredths(total), 2, 18)


def performance(bookings: DataFrame, ideal: DataFrame, grain: str = "hour") -> DataFrame:
    """(station, bucket, part) -> average and ideal cycle time, bookings, performance.

    The join comes after the aggregate, so even an unbroadcastable `ideal` meets few rows.
    """
    return cycle_totals(bookings, grain).join(ideal, "station_number", "left").select(
        "station_number",
        "date_hour",
        "part_number",
        mean(F.col("sum_cycle_time"), F.col("timed_bookings")).alias("avg_cycle_time"),
        "ideal_cycle_time",
        "count_bookings",
        performance_percent(
            F.col("ideal_cycle_time"), F.col("count_bookings"), F.col("sum_cycle_time")
        ).alias("performance_percent"),
    )
