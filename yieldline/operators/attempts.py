"""Latest-attempt flags per board, without ever sorting raw bookings.

A board (serial number) may be booked many times at a station. The KPIs ask whether a booking
carries the board's highest attempt number. Only maxima are needed for that, so bookings are first
aggregated to one row per (station, board, part, time bucket): partial aggregation runs map-side
and a board that holds a large share of all bookings shrinks before the shuffle. The window that
follows sees at most (buckets x parts) small rows per board and station, however many bookings
there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldline.functions.conditional import count_where, max_where, min_where
from yieldline.functions.timing import bucket


def is_fail() -> Column:
    return F.col("book_state") == "FAIL"


def is_pass() -> Column:
    return F.col("book_state") == "PASS"


def booking_counts() -> list[Column]:
    serial = F.col("serial_number")
    return [
        F.count(serial).alias("total_bookings"),
        count_where(is_fail(), serial).alias("fail_bookings"),
        count_where(is_pass(), serial).alias("pass_bookings"),
    ]


def attempts_per_bucket(bookings: DataFrame, grain: str = "hour", *extra: Column) -> DataFrame:
    """One row per (station, board, part, bucket): booking counts and highest attempts by result."""
    attempt = F.col("test_count")
    return bookings.groupBy(
        "station_number", "serial_number", "part_number", bucket("date_created", grain).alias("date_hour")
    ).agg(
        *booking_counts(),
        F.max(attempt).alias("top_attempt"),
        max_where(is_fail(), attempt).alias("top_fail"),
        max_where(is_pass(), attempt).alias("top_pass"),
        *extra,
    )


def flag_latest(attempts: DataFrame) -> DataFrame:
    """Add the board's highest attempt at the station over all time, and which results reach it.

    A NULL attempt never equals the maximum, so such rows count as bookings but not as boards.
    """
    board = Window.partitionBy("station_number", "serial_number")
    latest = F.max("top_attempt").over(board)
    return (
        attempts.withColumn("latest_attempt", latest)
        .withColumn("is_latest", F.col("top_attempt") == F.col("latest_attempt"))
        .withColumn("is_latest_fail", F.col("top_fail") == F.col("latest_attempt"))
        .withColumn("is_latest_pass", F.col("top_pass") == F.col("latest_attempt"))
    )


def board_counts() -> list[Column]:
    """Boards among flagged rows; each board appears once per group, so a plain count is distinct."""
    serial = F.col("serial_number")
    return [
        count_where(F.col("is_latest"), serial).alias("total_pcb"),
        count_where(F.col("is_latest_fail"), serial).alias("fail_pcb"),
        count_where(F.col("is_latest_pass"), serial).alias("pass_pcb"),
    ]


def running_latest(bookings: DataFrame, grain: str = "hour") -> DataFrame:
    """Which results match the running highest attempt inside (station, board, bucket).

    A booking with attempt c matches the running maximum iff no higher attempt was booked at or
    before its time. The earliest booking of each attempt is the best candidate, so one row per
    attempt number with its earliest times decides: it qualifies iff it comes strictly before the
    earliest booking of any higher attempt.
    """
    created = F.col("date_created")
    per_attempt = bookings.groupBy(
        "station_number", "serial_number", bucket("date_created", grain).alias("date_hour"), "test_count"
    ).agg(
        *booking_counts(),
        F.min(created).alias("first_any"),
        min_where(is_fail(), created).alias("first_fail"),
        min_where(is_pass(), created).alias("first_pass"),
    )
    higher = (
        Window.partitionBy("station_number", "serial_number", "date_hour")
        .orderBy(F.col("test_count").desc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    beaten_at = F.min("first_any").over(higher)

    def reaches(first: str) -> Column:
        in_time = F.col("beaten_at").isNull() | (F.col(first) < F.col("beaten_at"))
        return F.col("test_count").isNotNull() & F.col(first).isNotNull() & in_time

    flagged = per_attempt.withColumn("beaten_at", beaten_at)
    return flagged.groupBy("station_number", "serial_number", "date_hour").agg(
        *[F.sum(c).alias(c) for c in ("total_bookings", "fail_bookings", "pass_bookings")],
        F.bool_or(reaches("first_any")).alias("is_latest"),
        F.bool_or(reaches("first_fail")).alias("is_latest_fail"),
        F.bool_or(reaches("first_pass")).alias("is_latest_pass"),
    )


def board_history(bookings: DataFrame, *keys: str) -> DataFrame:
    """Per board: time of its last booking and how often it failed. One partial + final aggregate."""
    return bookings.groupBy("serial_number", *keys).agg(
        F.max("date_created").alias("last_test_time"), count_where(is_fail()).alias("fail_count")
    )
