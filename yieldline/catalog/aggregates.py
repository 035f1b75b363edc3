"""Aggregates and window functions over bookings, one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.catalog import sql
from yieldline.catalog.registry import query, register
from yieldline.functions import exact
from yieldline.functions.conditional import count_where, sum_where
from yieldline.functions.timing import bucket, elapsed
from yieldline.operators.attempts import is_fail, is_pass, board_history
from yieldline.operators.windows import group_max, previous_booking, running_max
from yieldline.plans.availability import availability_by_gaps
from yieldline.plans.distinct import DistinctBoards
from yieldline.plans.linewise import first_pass_of
from yieldline.plans.quality import quality
from yieldline.session import new_folder
from yieldline.sources.events import read_bookings
from yieldline.sources.tables import Warehouse


def _per_station_hour(name: str, aggregates: Callable[[], list[Column]], sql_aggregates: str) -> None:
    """An aggregate per station and hour; partial aggregation runs before the shuffle."""

    def run(spark, folder):
        groups = read_bookings(spark, folder).groupBy("station_number", bucket("date_created").alias("date_hour"))
        return groups.agg(*aggregates())

    text = f"SELECT station_number, {sql.hour()} AS date_hour, {sql_aggregates} FROM bookings GROUP BY ALL"
    register(name, run, sql.with_(select=text))


_per_station_hour(
    "a1_sum",
    lambda: [F.sum("cycle_time").cast("decimal(20,2)").alias("sum_cycle_time")],
    "CAST(SUM(cycle_time) AS DECIMAL(20,2)) AS sum_cycle_time",
)
_per_station_hour(
    "a2_avg",
    lambda: [exact.mean(F.sum("cycle_time"), F.count("cycle_time")).alias("avg_cycle_time")],
    sql.rounded(sql.cents("SUM(cycle_time)"), "100 * COUNT(cycle_time)", 2, 12) + " AS avg_cycle_time",
)
_per_station_hour(
    "a3_count_column", lambda: [F.count("serial_number").alias("bookings")], "COUNT(serial_number) AS bookings"
)
_per_station_hour("a4_count_rows", lambda: [F.count("*").alias("bookings")], "COUNT(*) AS bookings")
_per_station_hour(
    "a5_count_column_where",
    lambda: [
        count_where(is_fail(), F.col("serial_number")).alias("fail_bookings"),
        count_where(is_pass(), F.col("serial_number")).alias("pass_bookings"),
    ],
    "COUNT(serial_number) FILTER (book_state = 'FAIL') AS fail_bookings,"
    " COUNT(serial_number) FILTER (book_state = 'PASS') AS pass_bookings",
)
_per_station_hour(
    "a6_count_rows_where",
    lambda: [F.count_if(is_fail()).alias("fails"), F.count_if(~is_fail()).alias("others")],
    "COUNT(*) FILTER (book_state = 'FAIL') AS fails, COUNT(*) FILTER (book_state <> 'FAIL') AS others",
)
_per_station_hour(
    "a10_max_timestamp", lambda: [F.max("date_created").alias("last_booking")], "MAX(date_created) AS last_booking"
)


def _boards_per_station_hour(spark, folder):
    """One row per (station, hour, board): a board that repeats collapses before the shuffle."""
    return (
        read_bookings(spark, folder)
        .groupBy("station_number", bucket("date_created").alias("date_hour"), "serial_number")
        .agg(count_where(is_fail()).alias("fails"), count_where(is_pass()).alias("passes"))
    )


@query(
    "a7_count_distinct",
    sql.with_(
        select=f"SELECT station_number, {sql.hour()} AS date_hour, COUNT(DISTINCT serial_number) AS boards FROM bookings GROUP BY ALL"
    ),
)
def count_distinct(spark, folder):
    return (
        read_bookings(spark, folder)
        .groupBy("station_number", bucket("date_created").alias("date_hour"))
        .agg(F.count_distinct("serial_number").alias("boards"))
    )


@query(
    "a8_count_distinct_where",
    sql.with_(
        select=f"""SELECT station_number, {sql.hour()} AS date_hour,
       COUNT(DISTINCT serial_number) FILTER (book_state = 'FAIL') AS fail_boards,
       COUNT(DISTINCT serial_number) FILTER (book_state = 'PASS') AS pass_boards
FROM bookings GROUP BY ALL"""
    ),
)
def count_distinct_where(spark, folder):
    return _boards_per_station_hour(spark, folder).groupBy("station_number", "date_hour").agg(
        count_where(F.col("fails") > 0, F.col("serial_number")).alias("fail_boards"),
        count_where(F.col("passes") > 0, F.col("serial_number")).alias("pass_boards"),
    )


MONTH_SHIFT_SQL = """CAST(date_trunc('month', date_created) AS DATE) AS month_start,
       CASE WHEN hour(date_created) >= 6 AND hour(date_created) < 14 THEN 'Morning'
            WHEN hour(date_created) >= 14 AND hour(date_created) < 22 THEN 'Evening' ELSE 'Night' END AS shift_name"""


def _boards_by_period(spark, folder, *period) -> DataFrame:
    """Two loads, the second with all of the first again; then counts from the stored hours."""
    bookings = read_bookings(spark, folder)
    boards = DistinctBoards(Warehouse(spark, new_folder(spark, "distinct")))
    boards.add(bookings.where(F.dayofmonth("date_created") < 12))
    boards.add(bookings)
    return boards.counts(*period)


@query(
    "a7_boards_by_month_and_shift",
    sql.with_(select=f"SELECT {MONTH_SHIFT_SQL}, COUNT(DISTINCT serial_number) AS boards FROM bookings GROUP BY ALL"),
)
def boards_by_month_and_shift(spark, folder):
    """Distinct boards of coarse periods, out of bitmaps that were stored per hour."""
    hour = F.hour("date_hour")
    shift = F.when(hour.between(6, 13), "Morning").when(hour.between(14, 21), "Evening").otherwise("Night")
    month = F.trunc(F.to_date("date_hour"), "month").alias("month_start")
    return _boards_by_period(spark, folder, month, shift.alias("shift_name")).select("month_start", "shift_name", "boards")


@query(
    "a8_boards_by_station_and_day",
    sql.with_(
        select="""SELECT station_number, CAST(date_created AS DATE) AS calendar_date, COUNT(DISTINCT serial_number) AS boards,
       COUNT(DISTINCT serial_number) FILTER (book_state = 'FAIL') AS fail_boards,
       COUNT(DISTINCT serial_number) FILTER (book_state = 'PASS') AS pass_boards
FROM bookings GROUP BY ALL"""
    ),
)
def boards_by_station_and_day(spark, folder):
    return _boards_by_period(spark, folder, "station_number", F.to_date("date_hour").alias("calendar_date"))


@query(
    "a9_sum_where",
    sql.with_(
        sql.quality("q"),
        select="""SELECT date_hour, part_number,
       CAST(SUM(pass_pcb) FILTER (station_number = '1008') AS BIGINT) AS passed_at_end,
       CAST(SUM(fail_pcb) FILTER (station_number IN ('1003', '1008')) AS BIGINT) AS scrapped
FROM q GROUP BY ALL""",
    ),
)
def sum_filtered(spark, folder):
    station = F.col("station_number")
    return quality(read_bookings(spark, folder)).groupBy("date_hour", "part_number").agg(
        sum_where(station == schemas.FINAL_STATION, F.col("pass_pcb")).alias("passed_at_end"),
        sum_where(station.isin(*schemas.SCRAP_STATIONS), F.col("fail_pcb")).alias("scrapped"),
    )


@query(
    "a11_global_max",
    sql.with_(select=f"SELECT MAX({sql.hour()}) AS newest_hour, MAX(date_created) AS newest_booking FROM bookings"),
)
def global_max(spark, folder):
    newest = F.max("date_created")
    return read_bookings(spark, folder).agg(bucket(newest).alias("newest_hour"), newest.alias("newest_booking"))


@query(
    "a12_two_level",
    sql.with_(sql.first_pass("m"), select="SELECT part_number, date_hour, fpy_pcbs, total_pcbs FROM m"),
)
def two_level(spark, folder):
    history = board_history(read_bookings(spark, folder), "part_number")
    return first_pass_of(history).select("part_number", "date_hour", "fpy_pcbs", "total_pcbs")


@query("a13_sum_over_window", sql.with_(sql.availability("m"), select="SELECT * FROM m"))
def sum_over_window(spark, folder):
    return availability_by_gaps(read_bookings(spark, folder))


@query(
    "w1_max_over_board",
    sql.with_(
        select="""SELECT booking_id, test_count,
       MAX(test_count) OVER (PARTITION BY station_number, serial_number) AS max_test_count FROM bookings"""
    ),
)
def max_over_board(spark, folder):
    rows = group_max(read_bookings(spark, folder), ["station_number", "serial_number"], "test_count", "max_test_count")
    return rows.select("booking_id", "test_count", "max_test_count")


@query(
    "w2_running_max",
    sql.with_(
        select=f"""SELECT booking_id, test_count, MAX(test_count) OVER (
         PARTITION BY station_number, serial_number, {sql.hour()} ORDER BY date_created
         RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max FROM bookings"""
    ),
)
def max_so_far(spark, folder):
    rows = read_bookings(spark, folder).withColumn("date_hour", bucket("date_created"))
    group = ["station_number", "serial_number", "date_hour"]
    return running_max(rows, group, "test_count", "running_max").select("booking_id", "test_count", "running_max")


@query(
    "w3_gap_to_previous",
    sql.with_(
        select=f"""SELECT booking_id, LAG(date_created) OVER w AS previous_created,
       CAST(CAST(epoch_us(date_created) - LAG(epoch_us(date_created)) OVER w AS DECIMAL(18,0))
            * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(18,6)) AS gap_seconds
FROM bookings WINDOW w AS (PARTITION BY station_number, {sql.hour()} ORDER BY date_created)"""
    ),
)
def gap_to_previous(spark, folder):
    rows = read_bookings(spark, folder).withColumn("date_hour", bucket("date_created"))
    return previous_booking(rows, ["station_number", "date_hour"]).select(
        "booking_id",
        "previous_created",
        elapsed(F.col("previous_created"), F.col("date_created")).alias("gap_seconds"),
    )
