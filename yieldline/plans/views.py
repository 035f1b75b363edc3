"""Stored views that the refresh keeps up: the three older station and line views, and the hourly fact.

A warehouse that has such a table gets it maintained with each batch; the others cost nothing. An older station view depends on
the bookings of an hour only, so the batch's own days are computed anew. The older line view also changes where a touched
board's last booking was or is now. The fact takes over what the models have replaced: its own days are merged from the
models and the batch's days of the facts; in days where only boards were demoted its board counts are exchanged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldline.plans import models
from yieldline.plans.legacy import legacy_linewise, legacy_performance, legacy_quality
from yieldline.plans.linewise import first_pass_of, linewise
from yieldline.plans.models import Model, as_declared
from yieldline.plans.oee import FACT_COLUMNS, merge_models
from yieldline.plans.performance import cycle_totals
from yieldline.plans.quality import BOARD_NAMES, BOOKING_NAMES
from yieldline.sources.tables import Warehouse

_COUNTS = ", ".join(f"{c} BIGINT" for c in (*BOOKING_NAMES, *BOARD_NAMES))
STATION_HOUR = ("station_number", "date_hour")

LEGACY_PERFORMANCE = Model(
    "legacy_performance_station_hour",
    models.PERFORMANCE.schema,
    lambda bookings, ref: legacy_performance(bookings, ref("ideal_cycle_times")),
    unique_key=models.PERFORMANCE.unique_key,
    grain=models.PERFORMANCE.grain,
    not_null=models.PERFORMANCE.not_null,
)
LEGACY_QUALITY = Model(
    "legacy_quality_station_hour",
    f"station_number STRING, date_hour TIMESTAMP_NTZ, {_COUNTS}",
    lambda bookings, ref: legacy_quality(bookings),
    unique_key=STATION_HOUR,
    grain=STATION_HOUR,
    not_null=STATION_HOUR,
)
LEGACY_LINEWISE = Model(
    "legacy_linewise_datehour",
    models.LINEWISE.schema.replace(" part_number STRING,", ""),
    lambda bookings, ref: legacy_linewise(bookings, ref("legacy_quality_station_hour")),
    unique_key=("date_hour",),
    grain=("date_hour",),
    not_null=("date_hour",),
    upstream=("legacy_quality_station_hour",),
)
FACT = Model(
    "station_hour_fact",
    "station_number STRING, date_hour TIMESTAMP_NTZ, avg_cycle_time DECIMAL(12,2), ideal_cycle_time DECIMAL(10,2),"
    " count_bookings BIGINT, performance_percent DECIMAL(18,2), uptime_seconds DECIMAL(12,2), availability DECIMAL(12,4), "
    + _COUNTS,
    lambda bookings, ref: merge_models(
        cycle_totals(bookings), ref("ideal_cycle_times"), ref("availability_station_hour"), ref("quality_station_hour")
    ),
    unique_key=STATION_HOUR,
    grain=STATION_HOUR,
    not_null=STATION_HOUR,
    upstream=("availability_station_hour", "quality_station_hour"),
)
VIEWS = {m.name: m for m in (LEGACY_PERFORMANCE, LEGACY_QUALITY, LEGACY_LINEWISE, FACT)}


def stored_views(warehouse: Warehouse) -> dict[str, Model]:
    return {name: view for name, view in VIEWS.items() if warehouse.has_table(name)}


def legacy_line_of_days(warehouse: Warehouse, days: list[dt.date], history: DataFrame) -> DataFrame:
    """The older line view of some days; `history` has all hours of the boards seen there."""
    boards = history.groupBy("serial_number").agg(
        F.max("last_test_time").alias("last_test_time"), F.sum("fail_bookings").alias("fail_count")
    )
    ended = boards.where(F.to_date("last_test_time").isin(days))
    stations = warehouse.table(LEGACY_QUALITY.name, LEGACY_QUALITY.schema, days)
    return linewise(stations, first_pass_of(ended, by_part=False), by_part=False)


def fact_of_days(warehouse: Warehouse, own: list[dt.date], demoted: list[dt.date]) -> DataFrame:
    """The fact of the batch's own days, and of other days whose board counts have changed."""

    def model(spec: Model, days: list[dt.date]) -> DataFrame:
        return warehouse.table(spec.name, spec.schema, days)

    speed, ideal = cycle_totals(warehouse.facts(own)), warehouse.ideal_cycle_times()
    fresh = merge_models(speed, ideal, model(models.AVAILABILITY, own), model(models.QUALITY, own)).select(*FACT_COLUMNS)
    if not demoted:
        return fresh
    counts = (*BOOKING_NAMES, *BOARD_NAMES)
    boards = model(models.QUALITY, demoted).groupBy(*STATION_HOUR).agg(*[F.sum(c).alias(c) for c in counts])
    kept = model(FACT, demoted).drop(*counts).join(boards, list(STATION_HOUR), "full").select(*FACT_COLUMNS)
    return as_declared(fresh, FACT).unionByName(as_declared(kept, FACT))
