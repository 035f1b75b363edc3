"""Bookings and boards per station, part and time bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.operators.attempts import (
    is_fail,
    is_pass,
    attempts_per_bucket,
    board_counts,
    booking_counts,
    flag_latest,
)
from yieldline.functions.conditional import count_where
from yieldline.functions.timing import bucket

BOOKING_NAMES = ("total_bookings", "fail_bookings", "pass_bookings")
BOARD_NAMES = ("total_pcb", "fail_pcb", "pass_pcb")


def quality(bookings: DataFrame, grain: str = "hour") -> DataFrame:
    """(station, part, bucket) -> bookings of every attempt, boards by their latest attempt.

    One scan. A board's latest attempt is taken over all time and counted in the bucket of the
    booking that carries it.
    """
    return count_quality(flag_latest(attempts_per_bucket(bookings, grain)))


def count_quality(flagged: DataFrame) -> DataFrame:
    """Counts per (station, part, bucket) out of flagged attempts."""
    return flagged.groupBy("station_number", "part_number", "date_hour").agg(
        *[F.sum(c).alias(c) for c in BOOKING_NAMES], *board_counts()
    )


def quality_two_branches(bookings: DataFrame, grain: str = "hour") -> DataFrame:
    """The same as a left join of a bookings branch and a boards branch (two scans, three keys)."""
    keys = ["station_number", "date_hour", "part_number"]
    counted = bookings.groupBy(
        "station_number", bucket("date_created", grain).alias("date_hour"), "part_number"
    ).agg(*booking_counts())
    board = ["station_number", "serial_number"]
    latest = bookings.groupBy(*board).agg(F.max("test_count").alias("test_count"))
    final = bookings.join(latest, [*board, "test_count"], "left_semi")
    results = final.groupBy(
        "station_number", bucket("date_created", grain).alias("date_hour"), "part_number", "serial_number"
    ).agg(count_where(is_fail()).alias("fails"), count_where(is_pass()).alias("passes"))
    serial = F.col("serial_number")
    boards = results.groupBy(*keys).agg(
        F.count(serial).alias("total_pcb"),
        count_where(F.col("fails") > 0, serial).alias("fail_pcb"),
        count_where(F.col("passes") > 0, serial).alias("pass_pcb"),
    )
    joined = counted.join(boards, keys, "left")
    return joined.select(
        "station_number",
        "part_number",
        "date_hour",
        *BOOKING_NAMES,
        *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in BOARD_NAMES],
    )
