"""Declared tables: column types, length limits, and the rows of the two reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CYCLE_TIME = T.DecimalType(10, 2)

STATION_RECORDS = T.StructType(
    [
        T.StructField("booking_id", T.StringType()),
        T.StructField("serial_number", T.StringType()),
        T.StructField("station_number", T.StringType()),
        T.StructField("book_state", T.StringType()),
        T.StructField("date_created", T.TimestampNTZType()),
        T.StructField("part_number", T.StringType()),
        T.StructField("cycle_time", CYCLE_TIME),
        T.StructField("test_count", T.IntegerType()),
    ]
)
STATIONS = T.StructType(
    [
        T.StructField("station_number", T.StringType()),
        T.StructField("station_name", T.StringType()),
        T.StructField("lane", T.StringType()),
        T.StructField("line", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)
IDEAL_CYCLE_TIMES = T.StructType(
    [
        T.StructField("station_number", T.StringType()),
        T.StructField("ideal_cycle_time", CYCLE_TIME),
    ]
)

# Declared keys, required columns, text lengths and the default attempt number.
PRIMARY_KEYS = {
    "station_records": "booking_id",
    "stations": "station_number",
    "ideal_cycle_times": "station_number",
}
REQUIRED = {
    "station_records": [
        "booking_id",
        "serial_number",
        "station_number",
        "book_state",
        "date_created",
        "part_number",
        "cycle_time",
    ],
    "stations": ["station_number", "station_name"],
    "ideal_cycle_times": ["station_number", "ideal_cycle_time"],
}
MAX_LENGTHS = {
    "station_records": {
        "booking_id": 30,
        "serial_number": 16,
        "station_number": 4,
        "book_state": 4,
        "part_number": 10,
    },
    "stations": {"station_number": 4, "station_name": 50, "lane": 20, "line": 20},
    "ideal_cycle_times": {"station_number": 10},
}
DEFAULT_TEST_COUNT = 1

# Where a line's good boards and its scrap are counted.
FINAL_STATION = "1008"
SCRAP_STATIONS = ("1003", "1008")

# The stations of the line.
STATION_ROWS = [
    ("1001", "Loader", "Lane 1", "Line A", "PCB Loading Station"),
    ("1002", "Printer", "Lane 1", "Line A", "Solder Paste Printer"),
    ("1003", "SPI", "Lane 1", "Line A", "Solder Paste Inspection"),
    ("1004", "Pick & Place 1", "Lane 1", "Line A", "Component Placement - Standard"),
    ("1005", "Pick & Place 2", "Lane 1", "Line A", "Component Placement - Fine Pitch"),
    ("1006", "Reflow Oven", "Lane 1", "Line A", "Reflow Oven"),
    ("1007", "AOI 1", "Lane 1", "Line A", "Automated Optical Inspection - Post Reflow"),
    ("1008", "AOI 2", "Lane 1", "Line A", "Automated Optical Inspection - Final"),
]
# Seconds one board should take at each station.
IDEAL_CYCLE_TIME_ROWS = [
    ("1001", "3.5"),
    ("1002", "9.0"),
    ("1003", "4.0"),
    ("1004", "21.0"),
    ("1005", "20.0"),
    ("1006", "240.0"),
    ("1007", "3.5"),
    ("1008", "5.0"),
]


def values_sql(rows: list[tuple], names: list[str]) -> str:
    """Rows as an inline SQL table that Spark and DuckDB both read."""
    tuples = ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in rows)
    return f"(VALUES {tuples}) AS seed({', '.join(names)})"


def literal_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """An inline relation. Catalyst knows its exact size, so joins with it need no hint."""
    columns = ", ".join(f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema)
    return spark.sql(f"SELECT {columns} FROM {values_sql(rows, schema.names)}")


def stations(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, STATION_ROWS, STATIONS)


def ideal_cycle_times(spark: SparkSession) -> DataFrame:
    return literal_rows(spark, IDEAL_CYCLE_TIME_ROWS, IDEAL_CYCLE_TIMES)

# Bookings outside these years are set aside: such dates come from broken clocks, and every table has one partition a day.
FIRST_YEAR, LAST_YEAR = 1970, 2199
# Payload fields that the fact table has no column for.
EXTRAS = T.StructField("extras", T.MapType(T.StringType(), T.StringType()))
