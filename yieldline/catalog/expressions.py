"""Projection, predicates, scalar functions and sorting over bookings."""

from __future__ import annotations

from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.catalog import sql
from yieldline.catalog.registry import query
from yieldline.functions import exact
from yieldline.functions.conditional import count_where, sum_where
from yieldline.functions.timing import bucket, elapsed, elapsed_micros
from yieldline.operators.attempts import is_fail
from yieldline.operators.windows import group_max
from yieldline.plans.performance import performance
from yieldline.sources.events import read_bookings

HOUR = sql.hour()


@query(
    "p1_projection",
    sql.with_(select="SELECT booking_id AS booking, serial_number AS board, station_number AS station, cycle_time FROM bookings"),
)
def projection(spark, folder):
    return read_bookings(spark, folder).select(
        F.col("booking_id").alias("booking"),
        F.col("serial_number").alias("board"),
        F.col("station_number").alias("station"),
        "cycle_time",
    )


@query(
    "p2_latest_attempt_rows",
    sql.with_(
        select="""SELECT booking_id, station_number, serial_number, test_count FROM bookings
QUALIFY test_count = MAX(test_count) OVER (PARTITION BY station_number, serial_number)"""
    ),
)
def latest_attempt_rows(spark, folder):
    rows = group_max(read_bookings(spark, folder), ["station_number", "serial_number"], "test_count", "latest")
    return rows.where(F.col("test_count") == F.col("latest")).select(
        "booking_id", "station_number", "serial_number", "test_count"
    )


@query(
    "p3_in_list",
    sql.with_(
        select=f"""SELECT {HOUR} AS date_hour, COUNT(*) FILTER (station_number IN ('1003', '1008') AND book_state = 'FAIL') AS scrap_bookings
FROM bookings GROUP BY ALL"""
    ),
)
def in_list(spark, folder):
    at_scrap = F.col("station_number").isin(*schemas.SCRAP_STATIONS)
    return (
        read_bookings(spark, folder)
        .groupBy(bucket("date_created").alias("date_hour"))
        .agg(count_where(at_scrap & is_fail()).alias("scrap_bookings"))
    )


@query(
    "p4_after_newest_hour",
    sql.with_(
        select=f"""SELECT {sql.FACT_COLUMNS} FROM bookings
WHERE date_created > (SELECT MAX({HOUR}) FROM bookings)"""
    ),
)
def after_newest_hour(spark, folder):
    """`>` against an uncorrelated scalar subquery."""
    bookings = read_bookings(spark, folder)
    newest = bookings.agg(bucket(F.max("date_created")).alias("mark"))
    return bookings.where(F.col("date_created") > newest.scalar())


@query(
    "p5_group_by_expression",
    sql.with_(select=f"SELECT part_number, {HOUR} AS date_hour, COUNT(*) AS bookings FROM bookings GROUP BY ALL"),
)
def group_by_expression(spark, folder):
    return (
        read_bookings(spark, folder)
        .groupBy("part_number", bucket("date_created").alias("date_hour"))
        .agg(F.count("*").alias("bookings"))
    )


@query(
    "p6_arithmetic",
    sql.with_(
        sql.IDEAL,
        select="""SELECT booking_id, CAST(cycle_time - ideal_cycle_time AS DECIMAL(12,2)) AS over_ideal,
       CAST(cycle_time + ideal_cycle_time AS DECIMAL(12,2)) AS both_times,
       CAST(CAST(cycle_time * 100 AS BIGINT) * test_count AS BIGINT) AS weighted_hundredths,
       """
        + sql.rounded("CAST(cycle_time * 100 AS BIGINT)", "CAST(ideal_cycle_time * 100 AS BIGINT)", 4)
        + " AS times_ideal FROM bookings LEFT JOIN ideal USING (station_number)",
    ),
)
def arithmetic(spark, folder):
    rows = read_bookings(spark, folder).join(schemas.ideal_cycle_times(spark), "station_number", "left")
    cycle, ideal = F.col("cycle_time"), F.col("ideal_cycle_time")
    return rows.select(
        "booking_id",
        (cycle - ideal).cast("decimal(12,2)").alias("over_ideal"),
        (cycle + ideal).cast("decimal(12,2)").alias("both_times"),
        ((cycle * 100).cast("bigint") * F.col("test_count")).alias("weighted_hundredths"),
        exact.rounded_quotient(exact.hundredths(cycle), exact.hundredths(ideal), 4, 18).alias("times_ideal"),
    )


@query("o1_sorted_report", sql.with_(sql.IDEAL, sql.performance("m"), select="SELECT * FROM m"))
def sorted_report(spark, folder):
    """Global order for display; range-partitioned, so no single task sorts everything."""
    report = performance(read_bookings(spark, folder), schemas.ideal_cycle_times(spark))
    return report.orderBy("date_hour", "station_number", "part_number")


@query(
    "f1_date_trunc",
    sql.with_(
        select=" UNION ALL ".join(
            f"SELECT '{g}' AS grain, {sql.hour(grain=g)} AS bucket, COUNT(*) AS bookings FROM bookings GROUP BY ALL"
            for g in ("second", "minute", "hour", "day")
        )
    ),
)
def date_trunc(spark, folder):
    """Bookings per bucket at every grain, from one scan: coarser grains add up the finer ones."""
    seconds = read_bookings(spark, folder).groupBy(bucket("date_created", "second").alias("bucket")).count()
    grains = [
        seconds.groupBy(bucket("bucket", grain).alias("bucket"))
        .agg(F.sum("count").alias("bookings"))
        .select(F.lit(grain).alias("grain"), "bucket", "bookings")
        for grain in ("second", "minute", "hour", "day")
    ]
    first, *rest = grains
    for other in rest:
        first = first.unionByName(other)
    return first


BOARD_SPANS = "SELECT serial_number, MIN(date_created) AS f, MAX(date_created) AS l FROM bookings GROUP BY ALL"


def _board_spans(spark, folder):
    return read_bookings(spark, folder).groupBy("serial_number").agg(
        F.min("date_created").alias("first"), F.max("date_created").alias("last")
    )


@query(
    "f2_timestamp_difference",
    sql.with_(select=f"SELECT serial_number, epoch_us(l) - epoch_us(f) AS micros FROM ({BOARD_SPANS})"),
)
def timestamp_difference(spark, folder):
    spans = _board_spans(spark, folder)
    return spans.select("serial_number", elapsed_micros(F.col("first"), F.col("last")).alias("micros"))


@query(
    "f3_epoch_seconds",
    sql.with_(
        select="""SELECT serial_number, CAST(CAST(epoch_us(l) - epoch_us(f) AS DECIMAL(18,0))
       * CAST('0.000001' AS DECIMAL(7,6)) AS DECIMAL(18,6)) AS seconds
FROM ("""
        + BOARD_SPANS
        + ")"
    ),
)
def epoch_seconds(spark, folder):
    return _board_spans(spark, folder).select("serial_number", elapsed(F.col("first"), F.col("last")).alias("seconds"))


@query(
    "f4_round",
    sql.with_(
        select=f"""SELECT serial_number, {sql.rounded(sql.cents("SUM(cycle_time)"), "100 * COUNT(*)", 2)} AS mean_2,
       {sql.rounded(sql.cents("SUM(cycle_time)"), "100 * COUNT(*)", 4)} AS mean_4 FROM bookings GROUP BY ALL"""
    ),
)
def rounding(spark, folder):
    totals = read_bookings(spark, folder).groupBy("serial_number").agg(
        F.sum("cycle_time").alias("total"), F.count("*").alias("n")
    )
    cents, per = exact.hundredths(F.col("total")), F.col("n") * 100
    return totals.select(
        "serial_number",
        exact.rounded_quotient(cents, per, 2, 18).alias("mean_2"),
        exact.rounded_quotient(cents, per, 4, 18).alias("mean_4"),
    )


FAIL_SPLIT = f"""SELECT station_number, {HOUR} AS date_hour, COUNT(*) FILTER (book_state = 'FAIL') AS fails,
       COUNT(*) FILTER (book_state = 'PASS') AS passes,
       CAST(SUM(test_count) FILTER (book_state = 'FAIL') AS BIGINT) AS fail_attempts FROM bookings GROUP BY ALL"""


def _fail_split(spark, folder):
    return (
        read_bookings(spark, folder)
        .groupBy("station_number", bucket("date_created").alias("date_hour"))
        .agg(
            count_where(is_fail()).alias("fails"),
            count_where(~is_fail()).alias("passes"),
            sum_where(is_fail(), F.col("test_count")).alias("fail_attempts"),
        )
    )


@query(
    "f5_nullif",
    sql.with_(
        select=f"""SELECT station_number, date_hour, NULLIF(fails, 0) AS fails_or_null,
       {sql.rounded("passes", "fails")} AS passes_per_fail FROM ({FAIL_SPLIT})"""
    ),
)
def nullif(spark, folder):
    return _fail_split(spark, folder).select(
        "station_number",
        "date_hour",
        exact.null_if_zero(F.col("fails")).alias("fails_or_null"),
        exact.rounded_quotient(F.col("passes"), F.col("fails"), 2, 18).alias("passes_per_fail"),
    )


@query(
    "f6_coalesce",
    sql.with_(
        select=f"""SELECT station_number, date_hour, fail_attempts, COALESCE(fail_attempts, 0) AS fail_attempts_or_0
FROM ({FAIL_SPLIT})"""
    ),
)
def coalesce(spark, folder):
    return _fail_split(spark, folder).select(
        "station_number",
        "date_hour",
        "fail_attempts",
        F.coalesce("fail_attempts", F.lit(0)).alias("fail_attempts_or_0"),
    )


@query(
    "f7_percent",
    sql.with_(
        select=f"SELECT station_number, date_hour, {sql.percent('fails', 'fails + passes')} AS fail_percent FROM ({FAIL_SPLIT})"
    ),
)
def percentage(spark, folder):
    fails = F.col("fails")
    return _fail_split(spark, folder).select(
        "station_number", "date_hour", exact.percent(fails, fails + F.col("passes")).alias("fail_percent")
    )
