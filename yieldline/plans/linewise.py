"""Line-level yield: boards passed and scrapped, first-pass yield."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.functions.conditional import count_where, sum_where
from yieldline.functions.exact import percent
from yieldline.functions.timing import bucket
from yieldline.operators.attempts import board_history


def line_yield(
    quality: DataFrame,
    keys: tuple[str, ...] = ("date_hour", "part_number"),
    final_station: str = schemas.FINAL_STATION,
    scrap_stations: tuple[str, ...] = schemas.SCRAP_STATIONS,
) -> DataFrame:
    """Boards passed at the final station and failed at the scrap stations, with percentages.

    A sum over no rows is NULL and stays NULL through the total and the percentages.
    """
    station = F.col("station_number")
    sums = quality.groupBy(*keys).agg(
        sum_where(station == final_station, F.col("pass_pcb")).alias("pass_pcb_linewise"),
        sum_where(station.isin(*scrap_stations), F.col("fail_pcb")).alias("scrap_pcb_linewise"),
    )
    passed, scrap = F.col("pass_pcb_linewise"), F.col("scrap_pcb_linewise")
    return sums.withColumn("total_pcb_linewise", passed + scrap).select(
        *keys,
        "pass_pcb_linewise",
        "scrap_pcb_linewise",
        "total_pcb_linewise",
        percent(passed, F.col("total_pcb_linewise")).alias("pass_pcb_linewise_percent"),
        percent(scrap, F.col("total_pcb_linewise")).alias("scrap_pcb_linewise_percent"),
    )


def first_pass(bookings: DataFrame, grain: str = "hour", by_part: bool = True) -> DataFrame:
    """Boards that never failed and boards that did, in the bucket of their last booking."""
    part = ["part_number"] if by_part else []
    return first_pass_of(board_history(bookings, *part), grain, by_part)


def first_pass_of(history: DataFrame, grain: str = "hour", by_part: bool = True) -> DataFrame:
    keys = [bucket("last_test_time", grain).alias("date_hour"), *(["part_number"] if by_part else [])]
    return history.groupBy(*keys).agg(
        count_where(F.col("fail_count") == 0).alias("fpy_pcbs"),
        count_where(F.col("fail_count") > 0).alias("reworked_pcbs"),
        F.count("*").alias("total_pcbs"),
    )


def linewise(quality: DataFrame, first_pass: DataFrame, by_part: bool = True) -> DataFrame:
    """Join of first-pass counts and line yield; both sides are already one row per key."""
    keys = ["date_hour", "part_number"] if by_part else ["date_hour"]
    joined = first_pass.join(line_yield(quality, tuple(keys)), keys, "inner")
    return joined.select(
        "date_hour",
        "fpy_pcbs",
        percent(F.col("fpy_pcbs"), F.col("total_pcb_linewise")).alias("fpy_percent"),
        "pass_pcb_linewise",
        *keys[1:],
        "scrap_pcb_linewise",
        "total_pcb_linewise",
        "pass_pcb_linewise_percent",
        "scrap_pcb_linewise_percent",
    )
