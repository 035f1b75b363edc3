"""Dimensions of the star schema, generated from the time range of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.functions.exact import mean, percent
from yieldline.functions.timing import bucket

# Shift names are given, their hours are not: these are defaults to override. (name, start, end)
SHIFTS = (("Morning", 6, 14), ("Evening", 14, 22), ("Night", 22, 6))


def shift_dim(spark: SparkSession, shifts=SHIFTS) -> DataFrame:
    rows = [(i + 1, name, start, end) for i, (name, start, end) in enumerate(shifts)]
    table = schemas.values_sql(rows, ["shift_id", "shift_name", "start_hour", "end_hour"])
    return spark.sql(
        "SELECT CAST(shift_id AS INT) shift_id, shift_name, CAST(start_hour AS INT) start_hour,"
        f" CAST(end_hour AS INT) end_hour FROM {table}"
    )


def in_shift(hour, start, end):
    """Whether an hour of day lies in [start, end), also across midnight."""
    inside = (hour >= start) & (hour < end)
    return F.when(start < end, inside).otherwise((hour >= start) | (hour < end))


def shift_hours(shifts: DataFrame) -> DataFrame:
    """One row per hour of day of each shift, so that facts find their shift by an equi join."""
    start, end = F.col("start_hour"), F.col("end_hour")
    last = F.when(start < end, end).otherwise(end + 24) - 1
    return shifts.withColumn("hour_of_day", F.explode(F.sequence(start, last))).withColumn(
        "hour_of_day", F.col("hour_of_day") % 24
    )


def shift_of(hour, shifts=SHIFTS):
    """Shift name of an hour of day as a plain expression, for fact rows."""
    name = F.lit(None).cast("string")
    for shift, start, end in reversed(shifts):
        name = F.when(in_shift(hour, F.lit(start), F.lit(end)), shift).otherwise(name)
    return name


def _days(facts: DataFrame, column: str) -> DataFrame:
    """Every day from the first fact to the last one (low, high): years first and then their days, so that no row holds
    the calendar."""
    ends = facts.agg(F.min(column).alias("low"), F.max(column).alias("high"))
    first, last = F.to_date("low"), F.to_date("high")
    years = ends.select("low", "high", F.explode(F.sequence(F.year(first), F.year(last))).alias("year"))
    start = F.greatest(first, F.make_date("year", F.lit(1), F.lit(1)))
    end = F.least(last, F.make_date("year", F.lit(12), F.lit(31)))
    return years.select("low", "high", F.explode(F.sequence(start, end)).alias("day"))


def _hours(facts: DataFrame, column: str) -> DataFrame:
    """Every hour from that of the first fact to that of the last one."""
    hours = _days(facts, column).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23))))
    point = F.col("day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("h"))
    return hours.withColumn("point", point).where(F.col("point").between(bucket("low"), bucket("high"))).select("point")


def date_hour_dim(facts: DataFrame, column: str = "date_created", shifts=SHIFTS) -> DataFrame:
    point = F.col("point")
    return _hours(facts, column).select(
        point.alias("date_hour"),
        F.to_date(point).alias("calendar_date"),
        F.hour(point).alias("hour_of_day"),
        shift_of(F.hour(point), shifts).alias("shift_name"),
    )


def calendar_dim(facts: DataFrame, column: str = "date_created") -> DataFrame:
    day = F.col("day")
    return _days(facts, column).select(
        day.alias("calendar_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("iso_week"),
        F.dayofmonth(day).alias("day_of_month"),
        (F.weekday(day) + 1).alias("iso_weekday"),
    )


def stations_dim(spark: SparkSession) -> DataFrame:
    return schemas.stations(spark)


def star_join(
    fact: DataFrame, stations: DataFrame | None, hours: DataFrame, calendar: DataFrame, shifts: DataFrame
) -> DataFrame:
    """Hourly fact with its dimensions; a fact of the whole line has no station.

    The hour dimension first takes the other calendar dimensions, which are all small, so the fact
    is joined twice: by hour and by station.
    """
    shift = shift_hours(shifts).select("hour_of_day", "shift_id", F.col("shift_name").alias("shift"))
    when = hours.drop("shift_name").join(calendar, "calendar_date", "left").join(shift, "hour_of_day", "left")
    timed = fact.join(when, "date_hour", "left")
    return timed if stations is None else timed.join(stations, "station_number", "left")


def yield_by_shift_and_month(line_star: DataFrame) -> DataFrame:
    """Line yield per month, shift and product, from summed boards; a sum over no rows stays NULL."""
    keys = ["year", "month", "shift", "part_number"]
    names = ("pass_pcb_linewise", "scrap_pcb_linewise", "total_pcb_linewise")
    sums = line_star.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in names])
    return sums.withColumn("pass_percent", percent(F.col(names[0]), F.col(names[2])))


def oee_by_shift_and_month(star: DataFrame) -> DataFrame:
    """Mean OEE of the hours that have one, and boards passed, per station, month and shift."""
    keys = ["station_number", "year", "month", "shift"]
    sums = star.groupBy(*keys).agg(
        F.count("oee_percent").alias("hours"),
        F.sum("oee_percent").alias("total"),
        F.sum("pass_pcb").alias("pass_pcb"),
    )
    return sums.select(*keys, "hours", mean(F.col("total"), F.col("hours")).alias("mean_oee_percent"), "pass_pcb")
