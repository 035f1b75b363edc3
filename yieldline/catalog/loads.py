"""Scans, sinks, upserts and refreshes. Written tables go to the session's shared folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.catalog import sql
from yieldline.catalog.registry import query
from yieldline.operators.merge import merge_by_key, upsert_keep_existing, upsert_overwrite
from yieldline.plans.legacy import legacy_quality
from yieldline.plans.models import LINEWISE, MODELS, PERFORMANCE, QUALITY
from yieldline.plans.performance import cycle_totals, performance
from yieldline.plans.quality import quality
from yieldline.plans.refresh import full_refresh, incremental_refresh, since_high_water_mark
from yieldline.plans.views import FACT, LEGACY_LINEWISE, LEGACY_QUALITY, VIEWS
from yieldline.session import new_folder
from yieldline.sources import topic
from yieldline.sources.events import as_bookings, read_bookings, read_events
from yieldline.sources.serving import export_parquet
from yieldline.sources.tables import Warehouse, ensure_table
from yieldline.streaming.ingest import Ingest

ALL_BOOKINGS_SQL = sql.with_(select=f"SELECT {sql.FACT_COLUMNS} FROM bookings")
# The moment at which the first of two loads ends.
CUT = "2024-01-16 12:30:00"
CUT_SQL = f"TIMESTAMP '{CUT}'"


def cut():
    return F.expr(f"timestamp_ntz'{CUT}'")


def two_loads(bookings: DataFrame) -> tuple[DataFrame, DataFrame]:
    return bookings.where(F.col("date_created") < cut()), bookings.where(F.col("date_created") >= cut())


def new_warehouse(spark: SparkSession, label: str) -> Warehouse:
    return Warehouse(spark, new_folder(spark, label)).create()


def stored(warehouse: Warehouse) -> DataFrame:
    return warehouse.facts().select(*topic.FIELDS)


@query("s1_source_scan", ALL_BOOKINGS_SQL)
def source_scan(spark, folder):
    return read_bookings(spark, folder)


@query("s2_model_scan", sql.with_(sql.quality("q"), select="SELECT * FROM q"))
def model_scan(spark, folder):
    """A model read back from the table that the job before it wrote."""
    warehouse = new_warehouse(spark, "s2")
    return warehouse.replace_table("quality_station_hour", quality(read_bookings(spark, folder)))


@query("s3_stream_scan", ALL_BOOKINGS_SQL)
def stream_scan(spark, folder):
    """Landed messages, streamed and decoded."""
    path = new_folder(spark, "s3")
    topic.envelope(read_bookings(spark, folder)).write.text(f"{path}/landing")
    stream = topic.valid(topic.decode(topic.read_landing(spark, f"{path}/landing"))).select(*topic.FIELDS)
    sink = stream.writeStream.format("parquet").option("path", f"{path}/rows")
    sink.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schemas.STATION_RECORDS).parquet(f"{path}/rows")


@query("s4_envelope_decode", ALL_BOOKINGS_SQL)
def envelope_decode(spark, folder):
    messages = topic.envelope(read_bookings(spark, folder))
    return topic.valid(topic.decode(messages)).select(*topic.FIELDS)


@query(
    "s5_quarantine",
    sql.with_(
        select="""SELECT CASE event_type WHEN 'error' THEN 'not a JSON message' WHEN 'signup' THEN 'no payload'
         WHEN 'view' THEN 'serial_number is missing' WHEN 'click' THEN 'cycle_time is not a decimal(10,2)'
         ELSE 'stored' END AS outcome, COUNT(*) AS messages FROM bookings GROUP BY ALL"""
    ),
)
def quarantine(spark, folder):
    """Messages damaged in a different way per kind of event; none of them stops the decode."""
    kind = F.col("event_type")
    rows = as_bookings(read_events(spark, folder), "event_type").withColumns(
        {
            "serial_number": F.when(kind != "view", F.col("serial_number")),
            "cycle_time": F.when(kind == "click", "n/a").otherwise(F.col("cycle_time").cast("string")),
        }
    )
    text = F.col("value")
    damaged = (
        F.when(text.contains('"event_type":"error"'), F.rtrim(text, F.lit("}")))
        .when(text.contains('"event_type":"signup"'), F.replace(text, F.lit('"payload"'), F.lit('"body"')))
        .otherwise(text)
    )
    decoded = topic.decode(topic.envelope(rows).select(damaged.alias("value")))
    outcome = F.coalesce("reason", F.lit("stored")).alias("outcome")
    return decoded.groupBy(outcome).agg(F.count("*").alias("messages"))


@query("s6_append_sink", ALL_BOOKINGS_SQL)
def append_sink(spark, folder):
    """The second load brings the first one's bookings again; each is stored once."""
    bookings = read_bookings(spark, folder)
    warehouse = new_warehouse(spark, "s6")
    warehouse.append_facts(two_loads(bookings)[0])
    warehouse.append_facts(bookings)
    return stored(warehouse)


@query(
    "s7_added_columns",
    sql.with_(
        select=f"SELECT booking_id, CASE WHEN date_created >= {CUT_SQL} THEN props END AS props FROM bookings"
    ),
)
def added_columns(spark, folder):
    """Messages of the second load carry one more field, which becomes a column."""
    events = read_events(spark, folder)
    warehouse = new_warehouse(spark, "s7")
    ingest = Ingest(warehouse)
    first, second = two_loads(as_bookings(events, "props"))
    ingest.store(topic.envelope(first.drop("props")), 0)
    ingest.store(topic.envelope(second), 1)
    return warehouse.facts_with_added_columns(["props"]).select("booking_id", "props")


@query(
    "s8_reference_rows",
    sql.with_(
        sql.STATIONS,
        sql.IDEAL,
        select="""SELECT s.*, ideal_cycle_time, SUM(ideal_cycle_time)::DECIMAL(18,2) AS ideal_seconds
FROM stations s JOIN ideal USING (station_number) JOIN bookings USING (station_number) GROUP BY ALL""",
    ),
)
def reference_rows(spark, folder):
    """The loaded reference rows, with the ideal time of all bookings of each station."""
    warehouse = new_warehouse(spark, "s8")
    rows = warehouse.stations().join(warehouse.ideal_cycle_times(), "station_number")
    counted = read_bookings(spark, folder).groupBy("station_number").agg(F.count("*").alias("n"))
    total = (F.col("ideal_cycle_time") * F.col("n").cast("decimal(12,0)")).cast("decimal(18,2)")
    return rows.join(counted, "station_number").withColumn("ideal_seconds", total).drop("n")


BOARDS_SQL = """SELECT serial_number, MAX(part_number) AS part_number, MAX(date_created) AS seen, COUNT(*) AS bookings
FROM bookings WHERE {} GROUP BY serial_number"""
BOARD_LOADS_SQL = (
    f"old AS ({BOARDS_SQL.format(f'date_created < {CUT_SQL}')})",
    f"new AS ({BOARDS_SQL.format(f'date_created >= {CUT_SQL}')})",
)


def _board_loads(spark, folder) -> list[DataFrame]:
    return [
        load.groupBy("serial_number").agg(
            F.max("part_number").alias("part_number"),
            F.max("date_created").alias("seen"),
            F.count("*").alias("bookings"),
        )
        for load in two_loads(read_bookings(spark, folder))
    ]


@query(
    "s9_upsert_keep_existing",
    sql.with_(
        *BOARD_LOADS_SQL,
        select="SELECT * FROM old UNION ALL SELECT * FROM new WHERE serial_number NOT IN (SELECT serial_number FROM old)",
    ),
)
def keep_existing(spark, folder):
    return upsert_keep_existing(*_board_loads(spark, folder), ["serial_number"])


@query(
    "s10_upsert_overwrite",
    sql.with_(
        *BOARD_LOADS_SQL,
        select="SELECT * FROM new UNION ALL SELECT * FROM old WHERE serial_number NOT IN (SELECT serial_number FROM new)",
    ),
)
def overwrite(spark, folder):
    return upsert_overwrite(*_board_loads(spark, folder), ["serial_number"])


@query("s11_create_if_absent", ALL_BOOKINGS_SQL)
def create_if_absent(spark, folder):
    """Creating the table a second time leaves its rows alone."""
    path = new_folder(spark, "s11")
    ensure_table(spark, path, schemas.STATION_RECORDS)
    read_bookings(spark, folder).write.mode("append").parquet(path)
    ensure_table(spark, path, schemas.STATION_RECORDS)
    return spark.read.schema(schemas.STATION_RECORDS).parquet(path)


@query("s12_materialized_view", sql.with_(sql.legacy_quality("q"), select="SELECT * FROM q"))
def materialized_view(spark, folder):
    warehouse = new_warehouse(spark, "s12")
    return warehouse.replace_table("legacy_quality_station_hour", legacy_quality(read_bookings(spark, folder)))


LINE_SQL = sql.with_(sql.quality("q"), sql.linewise("m", "q"), select="SELECT * FROM m")


@query("s13_full_refresh", LINE_SQL)
def all_models(spark, folder):
    warehouse = new_warehouse(spark, "s13")
    warehouse.append_facts(read_bookings(spark, folder), skip_present=False)
    return full_refresh(warehouse)["quality_linewise_datehour"]


NEW_ROWS_SQL = (
    f"loaded AS (SELECT * FROM bookings WHERE date_created < {CUT_SQL})",
    sql.IDEAL,
    sql.performance("target", "loaded"),
    "arrived AS (SELECT * FROM bookings WHERE date_created >= (SELECT MAX(date_hour) FROM target))",
    sql.performance("fresh", "arrived"),
)


@query(
    "s14_replace_by_key",
    sql.with_(
        *NEW_ROWS_SQL,
        select="""SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM fresh f WHERE f.station_number = t.station_number
       AND f.date_hour = t.date_hour AND f.part_number = t.part_number) UNION ALL SELECT * FROM fresh""",
    ),
)
def replace_by_key(spark, folder):
    """Delete target rows whose key was recomputed, insert the recomputed ones."""
    bookings, ideal = read_bookings(spark, folder), schemas.ideal_cycle_times(spark)
    target = performance(two_loads(bookings)[0], ideal)
    fresh = performance(since_high_water_mark(bookings, target), ideal)
    return merge_by_key(target, fresh, ["station_number", "date_hour", "part_number"])


@query("s15_high_water_mark", sql.with_(*NEW_ROWS_SQL, select="SELECT * FROM fresh"))
def high_water_mark(spark, folder):
    bookings, ideal = read_bookings(spark, folder), schemas.ideal_cycle_times(spark)
    target = performance(two_loads(bookings)[0], ideal)
    return performance(since_high_water_mark(bookings, target), ideal)


@query("s16_quality_incremental", sql.with_(sql.quality("q"), select="SELECT * FROM q"))
def quality_incremental(spark, folder):
    """First load, full refresh; second load, only the days it can change. Equals a full refresh."""
    warehouse = new_warehouse(spark, "s16")
    first, second = two_loads(read_bookings(spark, folder))
    warehouse.append_facts(first)
    full_refresh(warehouse)
    warehouse.append_facts(second)
    incremental_refresh(warehouse, second)
    return warehouse.table(QUALITY.name, QUALITY.schema)


def _counted_sql(run: str, source: str) -> tuple[list[str], str]:
    """CTEs of the four models over `source`, and how many rows each has after a run."""
    parts = [
        sql.performance(f"{run}_p", source),
        sql.availability(f"{run}_a", source),
        sql.quality(f"{run}_q", source),
        sql.linewise(f"{run}_l", f"{run}_q", source),
    ]
    counts = [
        f"SELECT '{m.name}' AS model_name, '{','.join(m.upstream)}' AS upstream, {run == 'second'} AS incremental,"
        f" (SELECT COUNT(*) FROM {run}_{m.name[0] if m is not LINEWISE else 'l'}) AS stored_rows"
        for m in MODELS.values()
    ]
    return parts, " UNION ALL ".join(counts)


FIRST_SQL, SECOND_SQL = _counted_sql("first", "loaded"), _counted_sql("second", "bookings")


@query(
    "m1_model_runs",
    sql.with_(
        f"loaded AS (SELECT * FROM bookings WHERE date_created < {CUT_SQL})",
        sql.IDEAL,
        *FIRST_SQL[0],
        *SECOND_SQL[0],
        select=f"{FIRST_SQL[1]} UNION ALL {SECOND_SQL[1]}",
    ),
)
def model_runs(spark, folder):
    """M1-M5: each model with what it refers to, its first run over all bookings and its second one over what is new."""
    warehouse = new_warehouse(spark, "m1")
    runs = []
    for incremental, load in enumerate(two_loads(read_bookings(spark, folder))):
        warehouse.append_facts(load)
        if incremental:
            incremental_refresh(warehouse, load)
        else:
            full_refresh(warehouse)
        runs += [
            warehouse.table(m.name, m.schema).agg(
                F.lit(m.name).alias("model_name"),
                F.lit(",".join(m.upstream)).alias("upstream"),
                F.lit(bool(incremental)).alias("incremental"),
                F.count("*").alias("stored_rows"),
            )
            for m in MODELS.values()
        ]
    return reduce(DataFrame.unionAll, runs)


def maintained(spark, folder, label: str, name: str) -> DataFrame:
    """First load, full refresh with the stored views; second load, incremental refresh; then the view as it is stored."""
    warehouse = new_warehouse(spark, label)
    first, second = two_loads(read_bookings(spark, folder))
    warehouse.append_facts(first)
    full_refresh(warehouse, also=VIEWS)
    warehouse.append_facts(second)
    incremental_refresh(warehouse, second)
    return warehouse.table(name, VIEWS[name].schema)


@query("s12_maintained_quality_view", sql.with_(sql.legacy_quality("q"), select="SELECT * FROM q"))
def maintained_quality(spark, folder):
    return maintained(spark, folder, "s12-quality", LEGACY_QUALITY.name)


@query(
    "s12_maintained_line_view",
    sql.with_(sql.legacy_quality("q"), sql.linewise("m", "q", by_part=False), select="SELECT * FROM m"),
)
def maintained_line(spark, folder):
    return maintained(spark, folder, "s12-line", LEGACY_LINEWISE.name)


@query("k9_maintained_fact", sql.with_(sql.IDEAL, sql.station_fact("f"), select="SELECT * FROM f"))
def maintained_fact(spark, folder):
    return maintained(spark, folder, "k9", FACT.name)


@query(
    "s17_sync_columns",
    sql.with_(
        sql.IDEAL,
        sql.performance("m"),
        select="""SELECT station_number, date_hour, part_number, CAST(NULL AS DECIMAL(12,2)) AS avg_cycle_time,
       CAST(NULL AS DECIMAL(10,2)) AS ideal_cycle_time, n AS count_bookings, CAST(NULL AS DECIMAL(18,2)) AS performance_percent
FROM m_base""",
    ),
)
def sync_columns(spark, folder):
    """A stored table with other columns than the model now has: new ones are NULL, old ones are gone."""
    warehouse = new_warehouse(spark, "s17")
    warehouse.replace_table(PERFORMANCE.name, cycle_totals(read_bookings(spark, folder)))
    return warehouse.synced(PERFORMANCE.name, PERFORMANCE.schema)


@query("s18_serving_export", sql.with_(sql.IDEAL, sql.performance("m"), select="SELECT * FROM m"))
def serving_export(spark, folder):
    model = performance(read_bookings(spark, folder), schemas.ideal_cycle_times(spark))
    return export_parquet(model, new_folder(spark, "s18"))
