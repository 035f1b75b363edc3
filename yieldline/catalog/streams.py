"""Streaming jobs, run over everything available and read back from their sinks."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.catalog import sql
from yieldline.catalog.loads import ALL_BOOKINGS_SQL, LINE_SQL, new_warehouse, stored
from yieldline.catalog.registry import query
from yieldline.plans.models import LINEWISE
from yieldline.session import new_folder
from yieldline.sources import topic
from yieldline.sources.events import as_bookings, read_bookings, read_events
from yieldline.streaming import boards, hourly
from yieldline.streaming.ingest import Ingest
from yieldline.streaming.scheduled import run_once
from yieldline.sources.tables import Warehouse

# Bookings arrive in three deliveries, by kind of event, so event time is out of order between them.
DELIVERIES = (("view",), ("click", "purchase"), ("signup", "error"))
DELIVERY_SQL = "CASE WHEN event_type = 'view' THEN 0 WHEN event_type IN ('click', 'purchase') THEN 1 ELSE 2 END"
LATE_AFTER = 2 * 3600


def deliveries(spark, folder) -> Iterator[DataFrame]:
    events = read_events(spark, folder)
    for kinds in DELIVERIES:
        yield as_bookings(events.where(F.col("event_type").isin(*kinds)))


def land_messages(bookings: DataFrame, warehouse: Warehouse) -> None:
    topic.envelope(bookings).write.mode("append").text(warehouse.path("landing"))


def open_messages(warehouse: Warehouse) -> DataFrame:
    return topic.read_landing(warehouse.spark, warehouse.path("landing"))


@query("t1_ingest", ALL_BOOKINGS_SQL)
def ingest_messages(spark, folder):
    """Three deliveries, then everything once more; every booking is stored exactly once."""
    warehouse = new_warehouse(spark, "t1")
    ingest = Ingest(warehouse)
    for delivery in (*deliveries(spark, folder), read_bookings(spark, folder)):
        land_messages(delivery, warehouse)
        ingest.start(open_messages(warehouse), warehouse.path("checkpoint")).awaitTermination()
    return stored(warehouse)


def _run_windows(spark, folder, label: str, hours_of, keys: list[str]) -> DataFrame:
    """Deliver in three steps, restarting the stream from its checkpoint after each of them; then read the results."""
    path = new_folder(spark, label)
    for delivery in deliveries(spark, folder):
        delivery.write.mode("append").parquet(f"{path}/landing")
        arriving = spark.readStream.schema(delivery.schema).parquet(f"{path}/landing")
        hours = hours_of(arriving)
        hourly.start_windows(hours, f"{path}/hours", f"{path}/checkpoint").awaitTermination()
    return hourly.latest_windows(hours, f"{path}/hours", keys)


COUNTS_SQL = f"""SELECT station_number, part_number, {sql.hour()} AS date_hour,
       CAST(SUM(cycle_time) AS DECIMAL(20,2)) AS sum_cycle_time, COUNT(serial_number) AS count_bookings,
       COUNT(serial_number) FILTER (book_state = 'FAIL') AS fail_bookings,
       COUNT(serial_number) FILTER (book_state = 'PASS') AS pass_bookings"""


@query("t2_hourly_windows", sql.with_(select=COUNTS_SQL + " FROM bookings GROUP BY ALL"))
def hourly_windows(spark, folder):
    """Delivered in three steps, out of order between them; no booking is left out."""
    return _run_windows(spark, folder, "t2", hourly.hourly_counts, ["station_number", "part_number", "date_hour"])


@query("t3_streaming_availability", sql.with_(sql.availability("m"), select="SELECT * FROM m"))
def streaming_availability(spark, folder):
    return hourly.availability_of(_run_windows(spark, folder, "t3", hourly.hourly_spans, ["station_number", "date_hour"]))


def _run_routed(spark, folder, label: str) -> hourly.Routed:
    """Deliver in three steps; the stream is restarted from its checkpoint after each of them."""
    warehouse = new_warehouse(spark, label)
    landing = warehouse.path("landing")
    for delivery in deliveries(spark, folder):
        delivery.write.mode("append").parquet(landing)
        arriving = spark.readStream.schema(delivery.schema).parquet(landing)
        hourly.start_routed(
            warehouse, arriving, "hourly", warehouse.path("checkpoint"), LATE_AFTER
        ).awaitTermination()
    return hourly.Routed(warehouse, "hourly")


@query(
    "t4_totals_with_late_bookings",
    sql.with_(
        select=COUNTS_SQL
        + """, MIN(date_created) AS first, MAX(date_created) AS last, COUNT(date_created) AS bookings
FROM bookings GROUP BY ALL"""
    ),
)
def totals_with_late(spark, folder):
    """On-time partials plus the late table: no booking is lost, none counts twice."""
    return _run_routed(spark, folder, "t4").totals()


@query(
    "t4_late_table",
    sql.with_(
        f"""clocks AS (SELECT d.delivery, MAX(b.date_created) AS clock
  FROM (VALUES (1), (2)) AS d(delivery) JOIN bookings b ON {DELIVERY_SQL} < d.delivery GROUP BY ALL)""",
        select=f"""SELECT {sql.FACT_COLUMNS} FROM bookings JOIN clocks ON delivery = {DELIVERY_SQL}
WHERE {sql.hour()} + INTERVAL 1 HOUR <= clock - INTERVAL {LATE_AFTER} SECOND""",
    ),
)
def late_table(spark, folder):
    return _run_routed(spark, folder, "t4-late").late()


LAST_RESULT_SQL = sql.with_(
    select="""SELECT station_number, serial_number, MAX(test_count) AS latest_attempt,
       BOOL_OR(final AND book_state = 'FAIL') AS failed, BOOL_OR(final AND book_state = 'PASS') AS passed
FROM (SELECT *, test_count = MAX(test_count) OVER (PARTITION BY station_number, serial_number) AS final FROM bookings)
GROUP BY ALL"""
)


def _run_boards(spark, folder, label: str, start) -> DataFrame:
    path = new_folder(spark, label)
    for delivery in deliveries(spark, folder):
        delivery.write.mode("append").parquet(f"{path}/landing")
        arriving = spark.readStream.schema(delivery.schema).parquet(f"{path}/landing")
        start(arriving, f"{path}/boards", f"{path}/checkpoint").awaitTermination()
    return boards.last_results(spark, f"{path}/boards")


@query("t5_last_result_per_board", LAST_RESULT_SQL)
def last_result_per_board(spark, folder):
    return _run_boards(spark, folder, "t5", boards.start_boards)


@query("t5_state_per_board", LAST_RESULT_SQL)
def state_per_board(spark, folder):
    """The same out of a keyed state with a time to live; the stream is restarted from its checkpoint twice."""
    return _run_boards(spark, folder, "t5-state", boards.start_board_states)


@query("t6_scheduled_runs", LINE_SQL)
def scheduled_runs(spark, folder):
    """Three scheduled runs, each taking what has arrived and refreshing what that changes."""
    warehouse = new_warehouse(spark, "t6")
    ingest = Ingest(warehouse)
    for delivery in deliveries(spark, folder):
        land_messages(delivery, warehouse)
        run_once(ingest, lambda: open_messages(warehouse), warehouse.path("checkpoint"))
    return warehouse.table(LINEWISE.name, LINEWISE.schema)
