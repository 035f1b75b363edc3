"""The older station-level views: no part, and attempts compared while they run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.operators.attempts import board_counts, running_latest
from yieldline.plans.linewise import first_pass, linewise
from yieldline.plans.performance import performance as legacy_performance  # same rule, same grain
from yieldline.plans.quality import BOOKING_NAMES

__all__ = ["legacy_linewise", "legacy_performance", "legacy_quality"]


def legacy_quality(bookings: DataFrame, grain: str = "hour") -> DataFrame:
    """(station, bucket): a board that fails and then passes counts once in total, fail and pass."""
    flagged = running_latest(bookings, grain)
    return flagged.groupBy("station_number", "date_hour").agg(
        *[F.sum(c).alias(c) for c in BOOKING_NAMES], *board_counts()
    )


def legacy_linewise(bookings: DataFrame, quality: DataFrame, grain: str = "hour") -> DataFrame:
    return linewise(quality, first_pass(bookings, grain, by_part=False), by_part=False)
