"""Bookings read from an `events` table (event_id, ts, user_id, event_type, value, props).

Sixteen consecutive events are one board's two passes over the eight stations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

BOOKING_COLUMNS = {
    "booking_id": "CAST(event_id AS STRING)",
    "serial_number": "CONCAT('SN', CAST(event_id DIV 16 AS STRING))",
    "station_number": "CONCAT('100', CAST(1 + event_id % 8 AS STRING))",
    "book_state": "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'PASS' END",
    "date_created": "ts",
    "part_number": "CONCAT('P', CAST((event_id DIV 16) % 4 AS STRING))",
    "cycle_time": "CAST(value AS DECIMAL(10,2))",
    "test_count": "CAST(1 + (event_id DIV 8) % 2 AS INT)",
}


def as_bookings(events: DataFrame, *keep: str) -> DataFrame:
    """Row-wise mapping, so filters on date_created still reach the scan as filters on ts."""
    return events.select(*keep, *[F.expr(e).alias(name) for name, e in BOOKING_COLUMNS.items()])


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def read_bookings(spark: SparkSession, folder: str) -> DataFrame:
    return as_bookings(read_events(spark, folder))


def stream_events(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    """The same table as a file stream. The glob lets the path be one file or a folder of files."""
    return spark.readStream.schema(EVENTS).options(**options).parquet(f"{folder}/events.parque[t]")


def stream_bookings(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    return as_bookings(stream_events(spark, folder, **options))
