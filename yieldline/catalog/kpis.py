"""The composite KPI jobs, at hour and at day grain."""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.catalog import sql
from yieldline.catalog.registry import query, register
from yieldline.plans import dimensions, oee
from yieldline.plans.availability import availability
from yieldline.plans.legacy import legacy_linewise, legacy_performance, legacy_quality
from yieldline.plans.linewise import first_pass, linewise
from yieldline.plans.performance import performance
from yieldline.plans.quality import quality
from yieldline.sources.events import read_bookings, read_events


def _register_grain(grain: str) -> None:
    end = "" if grain == "hour" else f"_{grain}"

    def on_bookings(build):
        return lambda spark, folder: build(spark, read_bookings(spark, folder))

    def add(name, build, text):
        register(f"{name}{end}", on_bookings(build), text)

    def fact(spark, b):
        return oee.station_hour_fact(b, schemas.ideal_cycle_times(spark), grain)

    perf = sql.with_(sql.IDEAL, sql.performance("m", grain=grain), select="SELECT * FROM m")
    qual, older = sql.quality("q", grain=grain), sql.legacy_quality("q", grain=grain)
    add("k1_performance_station_hour", lambda s, b: performance(b, schemas.ideal_cycle_times(s), grain), perf)
    add(
        "k2_availability_station_hour",
        lambda s, b: availability(b, grain),
        sql.with_(sql.availability("m", grain=grain), select="SELECT * FROM m"),
    )
    add("k3_quality_station_hour", lambda s, b: quality(b, grain), sql.with_(qual, select="SELECT * FROM q"))
    add(
        "k4_quality_linewise",
        lambda s, b: linewise(quality(b, grain), first_pass(b, grain)),
        sql.with_(qual, sql.linewise("m", "q", grain=grain), select="SELECT * FROM m"),
    )
    add("k5_legacy_performance", lambda s, b: legacy_performance(b, schemas.ideal_cycle_times(s), grain), perf)
    add("k6_legacy_quality", lambda s, b: legacy_quality(b, grain), sql.with_(older, select="SELECT * FROM q"))
    add(
        "k7_legacy_linewise",
        lambda s, b: legacy_linewise(b, legacy_quality(b, grain), grain),
        sql.with_(older, sql.linewise("m", "q", grain=grain, by_part=False), select="SELECT * FROM m"),
    )
    add(
        "k8_first_pass_summary",
        lambda s, b: first_pass(b, grain),
        sql.with_(sql.first_pass("m", grain=grain), select="SELECT * FROM m"),
    )
    add("k9_station_hour_fact", fact, sql.with_(sql.IDEAL, sql.station_fact("f", grain), select="SELECT * FROM f"))
    add(
        "k10_oee",
        lambda s, b: oee.oee(fact(s, b)),
        sql.with_(sql.IDEAL, sql.station_fact("f", grain), select=sql.oee("f")),
    )


for _grain in ("hour", "day"):
    _register_grain(_grain)


@query(
    "k9_station_hour_fact_by_part",
    sql.with_(
        sql.IDEAL,
        sql.performance("p"),
        sql.availability("a"),
        sql.quality("q"),
        select="""SELECT station_number, date_hour, part_number, avg_cycle_time, ideal_cycle_time, count_bookings,
       performance_percent, total_bookings, fail_bookings, pass_bookings, total_pcb, fail_pcb, pass_pcb,
       uptime_seconds, availability
FROM p FULL JOIN q USING (station_number, date_hour, part_number) FULL JOIN a USING (station_number, date_hour)""",
    ),
)
def fact_by_part(spark, folder):
    b = read_bookings(spark, folder)
    return oee.merge_models_by_part(performance(b, schemas.ideal_cycle_times(spark)), availability(b), quality(b))


SHIFT_SQL = """CASE WHEN h >= 6 AND h < 14 THEN 'Morning' WHEN h >= 14 AND h < 22 THEN 'Evening' ELSE 'Night' END"""
HOURS_SQL = """hours AS (
  SELECT date_hour, CAST(date_hour AS DATE) AS calendar_date, CAST(hour(date_hour) AS INTEGER) AS h
  FROM (SELECT unnest(generate_series(date_trunc('hour', MIN(ts)), date_trunc('hour', MAX(ts)), INTERVAL 1 HOUR))
               AS date_hour FROM events))"""
CALENDAR_SQL = """calendar AS (
  SELECT CAST(d AS DATE) AS calendar_date, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
         CAST(month(d) AS INTEGER) AS month, CAST(weekofyear(d) AS INTEGER) AS iso_week,
         CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_weekday
  FROM (SELECT unnest(generate_series(date_trunc('day', MIN(ts)), date_trunc('day', MAX(ts)), INTERVAL 1 DAY)) AS d
        FROM events))"""


def _times(spark, folder):
    return read_events(spark, folder).select(F.col("ts").alias("date_created"))


@query(
    "k11_date_hour_dim",
    f"WITH {HOURS_SQL} SELECT date_hour, calendar_date, h AS hour_of_day, {SHIFT_SQL} AS shift_name FROM hours",
)
def date_hours(spark, folder):
    return dimensions.date_hour_dim(_times(spark, folder))


@query("k11_calendar_dim", f"WITH {CALENDAR_SQL} SELECT * FROM calendar")
def calendar(spark, folder):
    return dimensions.calendar_dim(_times(spark, folder))


@query(
    "k11_shift_dim_bookings",
    sql.with_(
        select=f"""SELECT shift_name, start_hour, end_hour, COUNT(*) AS bookings FROM (
  SELECT {SHIFT_SQL} AS shift_name, CASE WHEN h >= 6 AND h < 14 THEN 6 WHEN h >= 14 AND h < 22 THEN 14 ELSE 22 END AS start_hour,
         CASE WHEN h >= 6 AND h < 14 THEN 14 WHEN h >= 14 AND h < 22 THEN 22 ELSE 6 END AS end_hour
  FROM (SELECT CAST(hour(date_created) AS INTEGER) AS h FROM bookings)) GROUP BY ALL"""
    ),
)
def shifts(spark, folder):
    """Shift dimension with the bookings of each shift; counted per hour of day before the join."""
    per_hour = read_bookings(spark, folder).groupBy(F.hour("date_created").alias("hour_of_day")).count()
    joined = per_hour.join(dimensions.shift_hours(dimensions.shift_dim(spark)), "hour_of_day")
    return joined.groupBy("shift_name", "start_hour", "end_hour").agg(F.sum("count").alias("bookings"))


@query(
    "k11_stations_dim_bookings",
    sql.with_(
        sql.STATIONS,
        select="""SELECT s.*, bookings FROM stations s
LEFT JOIN (SELECT station_number, COUNT(*) AS bookings FROM bookings GROUP BY ALL) USING (station_number)""",
    ),
)
def station_dimension(spark, folder):
    counted = read_bookings(spark, folder).groupBy("station_number").agg(F.count("*").alias("bookings"))
    return dimensions.stations_dim(spark).join(counted, "station_number", "left")
