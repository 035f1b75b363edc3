"""Constraint and data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.catalog import sql
from yieldline.catalog.registry import query
from yieldline.operators import checks
from yieldline.plans.models import MODELS, documented_counts
from yieldline.plans.refresh import full_refresh
from yieldline.session import new_folder
from yieldline.sources import topic
from yieldline.sources.events import as_bookings, read_bookings, read_events
from yieldline.sources.tables import Warehouse


def _union(parts: list[DataFrame]) -> DataFrame:
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


@query(
    "c1_uniqueness",
    sql.with_(
        select=" UNION ALL ".join(
            f"""SELECT 'station_records' AS table_name, '{key}' AS key_column, COUNT(*) AS repeated_keys,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows
FROM (SELECT {key}, COUNT(*) AS n FROM bookings GROUP BY ALL HAVING COUNT(*) > 1)"""
            for key in ("booking_id", "serial_number")
        )
    ),
)
def uniqueness(spark, folder):
    """The declared key, and a column that is no key, to show violations."""
    bookings = read_bookings(spark, folder)
    return _union([checks.uniqueness(bookings, "station_records", key) for key in ("booking_id", "serial_number")])


@query(
    "c2_required_columns",
    sql.with_(
        select=" UNION ALL ".join(
            f"SELECT 'station_records' AS table_name, '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS null_count FROM rows"
            for c in schemas.REQUIRED["station_records"]
        )
    ).replace("  FROM events)", "  FROM events),\nrows AS (SELECT * REPLACE (CASE WHEN event_type <> 'signup' THEN part_number END AS part_number, CASE WHEN event_type <> 'view' THEN cycle_time END AS cycle_time) FROM bookings)"),
)
def required_columns(spark, folder):
    """Bookings that lost two of their fields for some kinds of event."""
    kind = F.col("event_type")
    rows = as_bookings(read_events(spark, folder), "event_type").withColumns(
        {
            "part_number": F.when(kind != "signup", F.col("part_number")),
            "cycle_time": F.when(kind != "view", F.col("cycle_time")),
        }
    )
    return checks.null_counts(rows, "station_records", schemas.REQUIRED["station_records"])


def _constraint_sql() -> str:
    """Every declared constraint of the three tables, each as one row; booking rows are damaged as in C2."""
    tables = {"station_records": "rows", "stations": "stations", "ideal_cycle_times": "ideal"}
    parts = []
    for table, source in tables.items():
        key = schemas.PRIMARY_KEYS[table]
        parts.append(f"SELECT '{table}' AS table_name, 'unique' AS rule, '{key}' AS column_name, COUNT({key}) - COUNT(DISTINCT {key}) AS rows FROM {source}")
        parts += [f"SELECT '{table}', 'required', '{c}', COUNT(*) FILTER ({c} IS NULL) FROM {source}" for c in schemas.REQUIRED[table]]
        parts += [f"SELECT '{table}', 'length', '{c}', COUNT(*) FILTER (length(rtrim({c})) > {n}) FROM {source}" for c, n in schemas.MAX_LENGTHS[table].items()]
    damaged = (
        "rows AS (SELECT * REPLACE (CASE WHEN event_type = 'view' THEN booking_id || '-' || repeat('x', 30) ELSE booking_id END AS booking_id,"
        " CASE WHEN event_type <> 'signup' THEN part_number END AS part_number) FROM bookings)"
    )
    return sql.with_(damaged, sql.STATIONS, sql.IDEAL, select=" UNION ALL ".join(parts))


@query("c4_constraints_of_all_tables", _constraint_sql())
def constraints_of_all_tables(spark, folder):
    """Bookings that lost a field or outgrew one, and the two reference tables as they are stored."""
    kind = F.col("event_type")
    rows = as_bookings(read_events(spark, folder), "event_type").withColumns(
        {
            "booking_id": F.when(kind == "view", F.concat("booking_id", F.lit("-"), F.repeat(F.lit("x"), 30))).otherwise(F.col("booking_id")),
            "part_number": F.when(kind != "signup", F.col("part_number")),
        }
    )
    warehouse = Warehouse(spark, new_folder(spark, "c4")).create()
    tables = {"station_records": rows, "stations": warehouse.stations(), "ideal_cycle_times": warehouse.ideal_cycle_times()}
    return _union([checks.table_report(frame, name) for name, frame in tables.items()])


@query(
    "c3_default_attempt",
    sql.with_(
        select="""SELECT booking_id, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN NULL ELSE test_count END AS test_count
FROM bookings"""
    ),
)
def default_attempt(spark, folder):
    """A message without test_count gets the default; one with an explicit null keeps it."""
    kind = F.col("event_type")
    rows = as_bookings(read_events(spark, folder), "event_type").withColumn(
        "test_count", F.when(kind != "click", F.col("test_count"))
    )
    messages = topic.envelope(rows, omit=kind == "view")
    return topic.valid(topic.decode(messages)).select("booking_id", "test_count")


TOO_WIDE_SQL = """rows AS (SELECT 'PART' || CAST(user_id * 100000 AS VARCHAR) AS part,
       CAST(CAST(value AS DECIMAL(10,2)) AS DECIMAL(20,2)) * 10000000 AS cycle FROM events),
reasons AS (SELECT NULLIF(concat_ws('; ', CASE WHEN length(part) > 10 THEN 'part_number is longer than 10' END,
       CASE WHEN cycle >= 99999999.995 THEN 'cycle_time is not a decimal(10,2)' END), '') AS reason FROM rows)"""


@query(
    "c4_length_and_precision",
    f"WITH {TOO_WIDE_SQL} SELECT COALESCE(reason, 'fits') AS outcome, COUNT(*) AS bookings FROM reasons GROUP BY ALL",
)
def length_and_precision(spark, folder):
    rows = as_bookings(read_events(spark, folder), "user_id").withColumns(
        {
            "part_number": F.concat(F.lit("PART"), (F.col("user_id") * 100000).cast("string")),
            "cycle_time": F.col("cycle_time").cast("decimal(20,2)") * 10000000,
        }
    )
    decoded = topic.decode(topic.envelope(rows))
    outcome = F.coalesce("reason", F.lit("fits")).alias("outcome")
    return decoded.groupBy(outcome).agg(F.count("*").alias("bookings"))


def _models(spark, folder) -> dict[str, DataFrame]:
    bookings, built = read_bookings(spark, folder), {}
    for model in MODELS.values():
        built[model.name] = model.build(bookings, lambda n: built[n] if n in built else schemas.ideal_cycle_times(spark))
    return built


MODEL_SQL = (
    sql.IDEAL,
    sql.performance("performance_station_hour"),
    sql.availability("availability_station_hour"),
    sql.quality("quality_station_hour"),
    sql.linewise("quality_linewise_datehour", "quality_station_hour"),
)


@query(
    "c5_not_null_report",
    sql.with_(
        *MODEL_SQL,
        select=" UNION ALL ".join(
            f"SELECT '{m.name}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER ({c} IS NULL) AS null_count FROM {m.name}"
            for m in MODELS.values()
            for c in m.not_null
        ),
    ),
)
def not_null_report(spark, folder):
    built = _models(spark, folder)
    return _union([checks.null_counts(built[m.name], m.name, list(m.not_null)) for m in MODELS.values()])


@query(
    "c6_column_notes",
    sql.with_(
        *MODEL_SQL,
        select=" UNION ALL ".join(
            f"SELECT '{m.name}' AS model_name, '{c}' AS column_name, '{note}' AS note, COUNT({c}) AS filled_rows FROM {m.name}"
            for m in MODELS.values()
            for c, note in m.notes.items()
        ),
    ),
)
def column_notes(spark, folder):
    """Notes and counts as the stored models have them."""
    warehouse = Warehouse(spark, new_folder(spark, "c6")).create()
    warehouse.append_facts(read_bookings(spark, folder), skip_present=False)
    stored = full_refresh(warehouse)
    return _union([documented_counts(stored[name], warehouse.notes(name), name) for name in MODELS])
