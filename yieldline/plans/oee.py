"""One hourly fact per station out of the three KPI models, and OEE from it.

The hourly fact is described only in words; the rules here are this engine's: performance is
recomputed from summed ideal and actual time, board counts are summed over parts, and quality is
pass_pcb / total_pcb.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldline.functions.exact import WIDE, mean, null_if_zero, percent, rounded_quotient
from yieldline.operators.attempts import attempts_per_bucket, board_counts, flag_latest
from yieldline.plans.availability import uptime_columns, uptime_micros
from yieldline.plans.performance import performance_percent
from yieldline.plans.quality import BOARD_NAMES, BOOKING_NAMES

FACT_COLUMNS = (
    "station_number",
    "date_hour",
    "avg_cycle_time",
    "ideal_cycle_time",
    "count_bookings",
    "performance_percent",
    "uptime_seconds",
    "availability",
    *BOOKING_NAMES,
    *BOARD_NAMES,
)


def station_hour_fact(bookings: DataFrame, ideal: DataFrame, grain: str = "hour") -> DataFrame:
    """The hourly fact straight from bookings: one scan and no join but the reference lookup."""
    created = F.col("date_created")
    per_board = flag_latest(
        attempts_per_bucket(
            bookings,
            grain,
            F.sum("cycle_time").alias("sum_cycle_time"),
            F.count("cycle_time").alias("timed_bookings"),
            F.min(created).alias("first"),
            F.max(created).alias("last"),
            F.count(created).alias("dated_bookings"),
        )
    )
    added_up = (*BOOKING_NAMES, "timed_bookings", "dated_bookings")
    stations = per_board.groupBy("station_number", "date_hour").agg(
        *[F.sum(c).alias(c) for c in added_up],
        F.sum("sum_cycle_time").cast("decimal(20,2)").alias("sum_cycle_time"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        *board_counts(),
    )
    totals = stations.join(ideal, "station_number", "left").withColumnRenamed(
        "ideal_cycle_time", "ideal"
    )
    micros = uptime_micros(F.col("first"), F.col("last"), F.col("dated_bookings"))
    return totals.select(
        "station_number",
        "date_hour",
        mean(F.col("sum_cycle_time"), F.col("timed_bookings")).alias("avg_cycle_time"),
        F.col("ideal").alias("ideal_cycle_time"),
        F.col("total_bookings").alias("count_bookings"),
        performance_percent(F.col("ideal"), F.col("total_bookings"), F.col("sum_cycle_time")).alias(
            "performance_percent"
        ),
        *uptime_columns(micros, grain),
        *BOOKING_NAMES,
        *BOARD_NAMES,
    )


def merge_models(
    cycle_totals: DataFrame, ideal: DataFrame, availability: DataFrame, quality: DataFrame
) -> DataFrame:
    """The same fact by merging stored models on (station, bucket), keeping rows of either side."""
    keys = ["station_number", "date_hour"]
    speed = cycle_totals.groupBy(*keys).agg(
        F.sum("sum_cycle_time").cast("decimal(20,2)").alias("sum_cycle_time"),
        F.sum("timed_bookings").alias("timed_bookings"),
        F.sum("count_bookings").alias("count_bookings"),
    )
    boards = quality.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in (*BOOKING_NAMES, *BOARD_NAMES)])
    merged = speed.join(availability, keys, "full").join(boards, keys, "full").join(ideal, "station_number", "left")
    return merged.select(
        *keys,
        mean(F.col("sum_cycle_time"), F.col("timed_bookings")).alias("avg_cycle_time"),
        "ideal_cycle_time",
        "count_bookings",
        performance_percent(
            F.col("ideal_cycle_time"), F.col("count_bookings"), F.col("sum_cycle_time")
        ).alias("performance_percent"),
        "uptime_seconds",
        "availability",
        *BOOKING_NAMES,
        *BOARD_NAMES,
    )


def merge_models_by_part(performance: DataFrame, availability: DataFrame, quality: DataFrame) -> DataFrame:
    """Part-level fact: performance and quality by part, the station's availability repeated."""
    keys = ["station_number", "date_hour"]
    parts = performance.join(quality, [*keys, "part_number"], "full")
    return parts.join(availability, keys, "full")


def oee_percent(availability: Column, performance: Column, passed: Column, total: Column) -> Column:
    """100 * availability * performance * quality, to 2 decimals; NULL if any factor is NULL.

    Inputs as stored: availability is a ratio with 4 decimals, performance a percentage with 2.
    """
    product = (availability * 10_000).cast(WIDE) * (performance * 100).cast("decimal(19,0)")
    return rounded_quotient(product * passed.cast("decimal(12,0)"), null_if_zero(total).cast(WIDE) * 1_000_000, 2, 18)


def oee(fact: DataFrame) -> DataFrame:
    """(station, bucket) -> the three factors and OEE."""
    passed, total = F.col("pass_pcb"), F.col("total_pcb")
    return fact.select(
        "station_number",
        "date_hour",
        "availability",
        "performance_percent",
        percent(passed, total).alias("quality_percent"),
        oee_percent(F.col("availability"), F.col("performance_percent"), passed, total).alias("oee_percent"),
    )
