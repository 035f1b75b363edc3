"""Availability per station and time bucket: time between its bookings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldline.functions.exact import rounded_quotient
from yieldline.functions.timing import GRAIN_SECONDS, MICROS, bucket, elapsed, elapsed_micros


def uptime_micros(first: Column, last: Column, bookings: Column) -> Column:
    """Sum of the gaps between consecutive bookings; they telescope to last - first.

    A single booking has no gap at all, hence NULL rather than 0.
    """
    return F.when(bookings > 1, elapsed_micros(first, last))


def uptime_columns(micros: Column, grain: str = "hour") -> list[Column]:
    return [
        rounded_quotient(micros, F.lit(MICROS), 2, 12).alias("uptime_seconds"),
        rounded_quotient(micros, F.lit(MICROS * GRAIN_SECONDS[grain]), 4, 12).alias("availability"),
    ]


def availability(bookings: DataFrame, grain: str = "hour") -> DataFrame:
    """(station, bucket) -> uptime seconds and its share of the bucket; no sort, no window."""
    spans = bookings.groupBy("station_number", bucket("date_created", grain).alias("date_hour")).agg(
        F.min("date_created").alias("first"),
        F.max("date_created").alias("last"),
        F.count("date_created").alias("bookings"),
    )
    micros = uptime_micros(F.col("first"), F.col("last"), F.col("bookings"))
    return spans.select("station_number", "date_hour", *uptime_columns(micros, grain))


def availability_by_gaps(bookings: DataFrame, grain: str = "hour", slot: str = "second") -> DataFrame:
    """The same from gaps between neighbours; reads like the definition.

    Bookings are aggregated to short slots: inside a slot the gaps add up to last - first, and one gap leads from the
    slot before. The window sees one row per slot.
    """
    group = ["station_number", "date_hour"]
    slots = bookings.groupBy(
        "station_number", bucket("date_created", grain).alias("date_hour"), bucket("date_created", slot).alias("slot")
    ).agg(F.min("date_created").alias("first"), F.max("date_created").alias("last"), F.count("date_created").alias("bookings"))
    before = F.lag("last").over(Window.partitionBy(*group).orderBy("slot"))
    inside = F.when(F.col("bookings") > 1, elapsed(F.col("first"), F.col("last")))
    gaps = slots.withColumn("gap", elapsed(before, F.col("first"))).withColumn("inside", inside)
    total = gaps.groupBy(*group).agg(F.sum("gap").alias("gaps"), F.sum("inside").alias("insides"))
    seconds = F.when(F.coalesce("gaps", "insides").isNotNull(), F.coalesce("gaps", F.lit(0)) + F.coalesce("insides", F.lit(0)))
    return total.select(*group, *uptime_columns((seconds * MICROS).cast("bigint"), grain))
