"""The joins the KPI models and the star schema are made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.catalog import sql
from yieldline.catalog.kpis import CALENDAR_SQL, HOURS_SQL, SHIFT_SQL
from yieldline.catalog.registry import query
from yieldline.operators.attempts import board_counts, booking_counts, running_latest
from yieldline.operators.merge import insert_missing
from yieldline.plans import dimensions, oee
from yieldline.plans.availability import availability
from yieldline.plans.linewise import first_pass, line_yield, linewise
from yieldline.plans.performance import cycle_totals, performance
from yieldline.plans.quality import BOARD_NAMES, BOOKING_NAMES, quality, quality_two_branches
from yieldline.functions.timing import bucket
from yieldline.sources.events import read_bookings

# The final station has no ideal time here, so that the left join has misses.
SOME_IDEAL = [row for row in schemas.IDEAL_CYCLE_TIME_ROWS if row[0] != schemas.FINAL_STATION]
SOME_IDEAL_SQL = (
    "ideal AS (SELECT station_number, CAST(ideal_cycle_time AS DECIMAL(10,2)) AS ideal_cycle_time"
    f" FROM {schemas.values_sql(SOME_IDEAL, schemas.IDEAL_CYCLE_TIMES.names)})"
)


@query("j1_left_reference", sql.with_(SOME_IDEAL_SQL, sql.performance("m"), select="SELECT * FROM m"))
def left_reference(spark, folder):
    ideal = schemas.literal_rows(spark, SOME_IDEAL, schemas.IDEAL_CYCLE_TIMES)
    return performance(read_bookings(spark, folder), ideal)


@query("j2_left_two_keys", sql.with_(sql.legacy_quality("q"), select="SELECT * FROM q"))
def left_two_keys(spark, folder):
    """Bookings branch and boards branch of the older view, joined on station and hour."""
    bookings = read_bookings(spark, folder)
    keys = ["station_number", "date_hour"]
    counted = bookings.groupBy("station_number", bucket("date_created").alias("date_hour")).agg(*booking_counts())
    boards = running_latest(bookings).groupBy(*keys).agg(*board_counts())
    return counted.join(boards, keys, "left").select(
        *keys, *BOOKING_NAMES, *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in BOARD_NAMES]
    )


@query("j3_left_three_keys", sql.with_(sql.quality("q"), select="SELECT * FROM q"))
def left_three_keys(spark, folder):
    return quality_two_branches(read_bookings(spark, folder))


@query(
    "j4_inner_two_keys",
    sql.with_(
        sql.quality("q"),
        sql.first_pass("f"),
        sql.line_yield("l", "q"),
        select="""SELECT date_hour, part_number, fpy_pcbs, total_pcbs, total_pcb_linewise
FROM f JOIN l USING (date_hour, part_number)""",
    ),
)
def inner_two_keys(spark, folder):
    bookings = read_bookings(spark, folder)
    joined = first_pass(bookings).join(line_yield(quality(bookings)), ["date_hour", "part_number"], "inner")
    return joined.select("date_hour", "part_number", "fpy_pcbs", "total_pcbs", "total_pcb_linewise")


@query("j5_full_merge_of_models", sql.with_(sql.IDEAL, sql.station_fact("f"), select="SELECT * FROM f"))
def full_merge(spark, folder):
    bookings = read_bookings(spark, folder)
    return oee.merge_models(
        cycle_totals(bookings), schemas.ideal_cycle_times(spark), availability(bookings), quality(bookings)
    )


@query(
    "j6_star",
    sql.with_(
        sql.IDEAL,
        sql.STATIONS,
        sql.station_fact("f"),
        HOURS_SQL,
        CALENDAR_SQL,
        select=f"""SELECT f.*, s.station_name, s.lane, s.line, s.description, h AS hour_of_day,
       {SHIFT_SQL} AS shift, CASE {SHIFT_SQL} WHEN 'Morning' THEN 1 WHEN 'Evening' THEN 2 ELSE 3 END AS shift_id,
       c.* FROM f LEFT JOIN hours USING (date_hour) LEFT JOIN calendar c USING (calendar_date)
LEFT JOIN stations s USING (station_number)""",
    ),
)
def star(spark, folder):
    bookings = read_bookings(spark, folder)
    fact = oee.station_hour_fact(bookings, schemas.ideal_cycle_times(spark))
    times = bookings.select("date_created")
    return dimensions.star_join(
        fact,
        dimensions.stations_dim(spark),
        dimensions.date_hour_dim(times),
        dimensions.calendar_dim(times),
        dimensions.shift_dim(spark),
    )


LINE_STAR_SQL = (
    sql.quality("q"),
    sql.linewise("m", "q"),
    HOURS_SQL,
    CALENDAR_SQL,
    f"""star AS (SELECT m.*, h AS hour_of_day, {SHIFT_SQL} AS shift,
       CASE {SHIFT_SQL} WHEN 'Morning' THEN 1 WHEN 'Evening' THEN 2 ELSE 3 END AS shift_id, c.*
FROM m LEFT JOIN hours USING (date_hour) LEFT JOIN calendar c USING (calendar_date))""",
)


def _when(spark, folder) -> tuple:
    times = read_bookings(spark, folder).select("date_created")
    return dimensions.date_hour_dim(times), dimensions.calendar_dim(times), dimensions.shift_dim(spark)


def _line_star(spark, folder):
    bookings = read_bookings(spark, folder)
    line = linewise(quality(bookings), first_pass(bookings))
    return dimensions.star_join(line, None, *_when(spark, folder))


@query("j6_line_star", sql.with_(*LINE_STAR_SQL, select="SELECT * FROM star"))
def line_star(spark, folder):
    """The line-level fact with hour, calendar and shift."""
    return _line_star(spark, folder)


@query(
    "k4_yield_by_shift_and_month",
    sql.with_(
        *LINE_STAR_SQL,
        select=f"""SELECT year, month, shift, part_number, CAST(SUM(pass_pcb_linewise) AS BIGINT) AS pass_pcb_linewise,
       CAST(SUM(scrap_pcb_linewise) AS BIGINT) AS scrap_pcb_linewise, CAST(SUM(total_pcb_linewise) AS BIGINT) AS total_pcb_linewise,
       {sql.percent("SUM(pass_pcb_linewise)", "SUM(total_pcb_linewise)")} AS pass_percent FROM star GROUP BY ALL""",
    ),
)
def yield_by_shift_and_month(spark, folder):
    return dimensions.yield_by_shift_and_month(_line_star(spark, folder))


@query(
    "k10_oee_by_shift_and_month",
    sql.with_(
        sql.IDEAL,
        sql.station_fact("f"),
        f"o AS ({sql.oee('f')})",
        HOURS_SQL,
        CALENDAR_SQL,
        select=f"""SELECT o.station_number, c.year, c.month, {SHIFT_SQL} AS shift, COUNT(oee_percent) AS hours,
       {sql.rounded(sql.cents("SUM(oee_percent)"), "100 * COUNT(oee_percent)", 2, 12)} AS mean_oee_percent,
       CAST(SUM(f.pass_pcb) AS BIGINT) AS pass_pcb
FROM o JOIN f USING (station_number, date_hour) LEFT JOIN hours USING (date_hour) LEFT JOIN calendar c USING (calendar_date)
GROUP BY ALL""",
    ),
)
def oee_by_shift_and_month(spark, folder):
    fact = oee.station_hour_fact(read_bookings(spark, folder), schemas.ideal_cycle_times(spark))
    rates = oee.oee(fact).join(fact.select("station_number", "date_hour", "pass_pcb"), ["station_number", "date_hour"])
    return dimensions.oee_by_shift_and_month(dimensions.star_join(rates, None, *_when(spark, folder)))


@query(
    "j7_anti",
    sql.with_(
        select="""SELECT serial_number, COUNT(*) AS bookings FROM bookings b
WHERE NOT EXISTS (SELECT 1 FROM bookings f WHERE f.serial_number = b.serial_number AND f.book_state = 'FAIL')
GROUP BY ALL"""
    ),
)
def boards_without_fail(spark, folder):
    """Boards with no failed booking; bookings are counted per board before the anti join."""
    bookings = read_bookings(spark, folder)
    boards = bookings.groupBy("serial_number").agg(F.count("*").alias("bookings"))
    failed = bookings.where(F.col("book_state") == "FAIL").select("serial_number").distinct()
    return insert_missing(boards, failed, ["serial_number"])
