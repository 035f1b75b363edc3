"""The four stored models as plain data: name, keys, grain, upstream models, column notes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldline.operators.merge import align_columns
from yieldline.plans.availability import availability
from yieldline.plans.linewise import first_pass, linewise
from yieldline.plans.performance import performance
from yieldline.plans.quality import quality


@dataclass(frozen=True)
class Model:
    """`build` takes the bookings and a lookup for reference tables and upstream models.

    `unique_key` is the key of replacement in the original definition; for two models it is coarser
    than `grain`, which is why refreshes here replace whole days instead.
    """

    name: str
    schema: str
    build: Callable[[DataFrame, Callable[[str], DataFrame]], DataFrame]
    unique_key: tuple[str, ...]
    grain: tuple[str, ...]
    not_null: tuple[str, ...]
    upstream: tuple[str, ...] = ()
    notes: dict[str, str] = field(default_factory=dict)


PERFORMANCE = Model(
    "performance_station_hour",
    "station_number STRING, date_hour TIMESTAMP_NTZ, part_number STRING, avg_cycle_time DECIMAL(12,2),"
    " ideal_cycle_time DECIMAL(10,2), count_bookings BIGINT, performance_percent DECIMAL(18,2)",
    lambda bookings, ref: performance(bookings, ref("ideal_cycle_times")),
    unique_key=("station_number", "date_hour", "part_number"),
    grain=("station_number", "date_hour", "part_number"),
    not_null=("station_number", "date_hour", "part_number"),
    notes={
        "station_number": "station id",
        "date_hour": "start of the hour",
        "part_number": "product made in that hour",
        "avg_cycle_time": "mean seconds per booking",
        "ideal_cycle_time": "target seconds per booking",
        "count_bookings": "bookings in the hour",
        "performance_percent": "ideal time over actual time, in percent",
    },
)
AVAILABILITY = Model(
    "availability_station_hour",
    "station_number STRING, date_hour TIMESTAMP_NTZ, uptime_seconds DECIMAL(12,2), availability DECIMAL(12,4)",
    lambda bookings, ref: availability(bookings),
    unique_key=("station_number", "date_hour"),
    grain=("station_number", "date_hour"),
    not_null=("station_number", "date_hour"),
    notes={
        "station_number": "station id",
        "date_hour": "start of the hour",
        "uptime_seconds": "seconds between first and last booking",
        "availability": "uptime over the length of the hour, 0 to 1",
    },
)
QUALITY = Model(
    "quality_station_hour",
    "station_number STRING, part_number STRING, date_hour TIMESTAMP_NTZ, total_bookings BIGINT,"
    " fail_bookings BIGINT, pass_bookings BIGINT, total_pcb BIGINT, fail_pcb BIGINT, pass_pcb BIGINT",
    lambda bookings, ref: quality(bookings),
    unique_key=("station_number", "date_hour"),
    grain=("station_number", "date_hour", "part_number"),
    not_null=("station_number", "date_hour"),
    notes={
        "station_number": "station id",
        "part_number": "product",
        "date_hour": "start of the hour",
        "total_bookings": "bookings of every attempt",
        "fail_bookings": "failed bookings",
        "pass_bookings": "passed bookings",
        "total_pcb": "boards whose latest attempt lies in the hour",
        "fail_pcb": "of these, boards that failed it",
        "pass_pcb": "of these, boards that passed it",
    },
)
LINEWISE = Model(
    "quality_linewise_datehour",
    "date_hour TIMESTAMP_NTZ, fpy_pcbs BIGINT, fpy_percent DECIMAL(18,2), pass_pcb_linewise BIGINT,"
    " part_number STRING, scrap_pcb_linewise BIGINT, total_pcb_linewise BIGINT,"
    " pass_pcb_linewise_percent DECIMAL(18,2), scrap_pcb_linewise_percent DECIMAL(18,2)",
    lambda bookings, ref: linewise(ref("quality_station_hour"), first_pass(bookings)),
    unique_key=("date_hour",),
    grain=("date_hour", "part_number"),
    not_null=("date_hour",),
    upstream=("quality_station_hour",),
    notes={
        "date_hour": "start of the hour",
        "fpy_pcbs": "boards last seen in the hour that never failed",
        "fpy_percent": "these boards over the line total, in percent",
        "pass_pcb_linewise": "boards passed at the final station",
        "part_number": "product",
        "scrap_pcb_linewise": "boards failed at a scrap station",
        "total_pcb_linewise": "passed plus scrapped boards",
        "pass_pcb_linewise_percent": "passed over total, in percent",
        "scrap_pcb_linewise_percent": "scrapped over total, in percent",
    },
)
MODELS = {m.name: m for m in (PERFORMANCE, AVAILABILITY, QUALITY, LINEWISE)}


def as_declared(rows: DataFrame, model: Model) -> DataFrame:
    """Rows as the model is stored: its declared columns and types, with their notes."""
    return with_notes(align_columns(rows, T.StructType.fromDDL(model.schema)), model)


def with_notes(rows: DataFrame, model: Model) -> DataFrame:
    """Attach the column notes as metadata; a stored table keeps them as column comments."""
    for column, note in model.notes.items():
        rows = rows.withMetadata(column, {"comment": note})
    return rows


def in_waves(models: dict[str, Model]) -> list[list[Model]]:
    """Models grouped so that each wave only needs earlier ones; a wave may run concurrently."""
    waves, done = [], set()
    while len(done) < len(models):
        wave = [m for m in models.values() if m.name not in done and set(m.upstream) <= done]
        if not wave:
            raise ValueError("models depend on each other in a circle")
        waves.append(wave)
        done |= {m.name for m in wave}
    return waves


def documented_counts(rows: DataFrame, notes: dict[str, str], name: str) -> DataFrame:
    """One row per documented column: its note and how many rows have a value, in one pass."""
    counted = rows.agg(*[F.count(c).alias(c) for c in notes])
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("note"), F.col(c).alias("filled_rows"))
            for c, n in notes.items()
        ]
    )
    return counted.select(F.lit(name).alias("model_name"), F.inline(pairs))
