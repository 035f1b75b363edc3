"""Full and incremental refresh of the stored models.

A full refresh rebuilds every model. An incremental one finds the days a batch of newly stored
bookings can change, recomputes these days from the facts and overwrites them. It never reads the
old model, so it may be repeated after a failure, and it gives the same tables as a full refresh
for any split and any order of batches.
"""

from __future__ import annotations

import datetime as dt
from functools import partial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldline.functions.conditional import max_where
from yieldline.operators.attempts import flag_latest
from yieldline.plans import models, views
from yieldline.plans.linewise import first_pass_of, linewise
from yieldline.plans.quality import count_quality
from yieldline.plans.views import stored_views
from yieldline.session import at_once
from yieldline.sources.layered import StaleRefresh
from yieldline.sources.tables import Warehouse, distinct_days, with_day

STATION_BOARD = ["station_number", "serial_number"]
PART_BOARD = ["serial_number", "part_number"]


def full_refresh(warehouse: Warehouse, threads: int = 4, also: dict[str, models.Model] | None = None) -> dict[str, DataFrame]:
    """Rebuild all models from the facts, and the views of `also` and those stored; independent ones run at the same time.

    A model reads its upstream models from their tables, so nothing is computed twice. All read the facts as they are at the
    start. Loads that come meanwhile are left to their own refresh: a table that it has brought further is not replaced.
    """
    tables: dict[str, DataFrame] = {}
    as_of, facts = warehouse.log.number(), warehouse.facts()

    def ref(name: str) -> DataFrame:
        return tables[name] if name in tables else warehouse.ideal_cycle_times()

    def rebuild(model: models.Model) -> tuple[str, DataFrame]:
        rows = models.as_declared(model.build(facts, ref), model)
        try:
            return model.name, warehouse.replace_table(model.name, rows, as_of)
        except StaleRefresh:
            return model.name, warehouse.table(model.name, model.schema)

    for wave in models.in_waves({**models.MODELS, **(also or {}), **stored_views(warehouse)}):
        tables.update(at_once(warehouse.spark, [partial(rebuild, model) for model in wave], threads))
    return tables


# The joins below come after an aggregate on the joined keys, so a board with a large share of all
# bookings is already a few rows by then. If the other side can be broadcast, Catalyst moves the
# semi join under the aggregate, and the facts are filtered while they are scanned.


def within(rows: DataFrame, days: list[dt.date], column: str = "date_hour") -> DataFrame:
    return rows.where(F.to_date(column).isin(days))


def only_boards(rows: DataFrame, boards: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(boards.select(*keys).distinct(), keys, "left_semi")


def days_of_quality(boards: DataFrame, batch: DataFrame) -> list[dt.date]:
    """Days whose station quality the batch can change. `boards` are those of the batch, over all time.

    They may be in parts. These are the batch's own days and the days in which a touched board has a booking that is not
    (any longer) its latest attempt: a retest takes the earlier booking's board out of its hour.
    """
    per_day = boards.groupBy(*STATION_BOARD, F.to_date("date_hour").alias("event_day")).agg(
        F.min("low_attempt").alias("lowest"), F.max("top_attempt").alias("highest")
    )
    touched = only_boards(per_day, batch, STATION_BOARD)
    latest = F.max("highest").over(Window.partitionBy(*STATION_BOARD))
    demoted = touched.withColumn("latest", latest).where(F.col("lowest") < F.col("latest"))
    own = batch.select(F.to_date("date_created").alias("event_day"))
    return distinct_days(demoted.select("event_day").unionByName(own))


def days_of_first_pass(boards: DataFrame, batch: DataFrame, keys: list[str] = PART_BOARD) -> list[dt.date]:
    """Days in which a touched board has its last booking now, or had it before the batch.

    Before the batch, a day held the bookings it holds now less those of the batch.
    """
    board_day = [*keys, "event_day"]
    per_day = boards.groupBy(*keys, F.to_date("date_hour").alias("event_day"))
    now = only_boards(per_day.agg(F.sum("total_bookings").alias("stored")), batch, keys)
    arrived = with_day(batch, "date_created").groupBy(*board_day).agg(F.count("*").alias("arrived"))
    older = F.col("stored") > F.coalesce("arrived", F.lit(0))
    last = now.join(arrived, board_day, "left").groupBy(*keys).agg(
        F.max("event_day").alias("last_now"), max_where(older, F.col("event_day")).alias("last_before")
    )
    return distinct_days(last.select(F.explode(F.array("last_now", "last_before")).alias("event_day")))


def history(warehouse: Warehouse, rows: DataFrame, keys: list[str]) -> DataFrame:
    """All hours of the boards that `rows` have: the index tells their days, and only these days of the boards are read."""
    return only_boards(warehouse.boards(warehouse.days_of_boards(rows)), rows, keys)


def quality_of_days(warehouse: Warehouse, days: list[dt.date]) -> DataFrame:
    """Station quality of some days; boards seen there are judged by their whole history."""
    judged = history(warehouse, warehouse.board_parts(days), STATION_BOARD)
    return count_quality(within(flag_latest(judged), days))


def first_pass_of_days(warehouse: Warehouse, days: list[dt.date]) -> DataFrame:
    seen = warehouse.board_parts(days)
    whole = only_boards(warehouse.board_parts(warehouse.days_of_boards(seen)), seen, PART_BOARD)
    boards = whole.groupBy(*PART_BOARD).agg(
        F.max("last_test_time").alias("last_test_time"), F.sum("fail_bookings").alias("fail_count")
    )
    return first_pass_of(within(boards, days, "last_test_time"))


def incremental_refresh(warehouse: Warehouse, batch: DataFrame) -> dict[str, list[dt.date]]:
    """Bring all models up to date after `batch` was appended to the facts.

    Facts are read for the batch's own days only. What reaches further back comes from the boards: an index tells in which days
    a board was seen, and only these days are read. Returns the days replaced per model. Only day lists reach the driver.
    """
    as_of, ideal, kept_up = warehouse.log.number(), warehouse.ideal_cycle_times(), stored_views(warehouse)
    own_days = distinct_days(batch.select(F.to_date("date_created").alias("event_day")))
    if not own_days:
        return {}

    def replace_own(model: models.Model) -> dict[str, list[dt.date]]:
        rows = model.build(warehouse.facts(own_days), lambda name: ideal)
        warehouse.replace_days(model.name, models.as_declared(rows, model), own_days, as_of)
        return {model.name: own_days}

    def replace_quality_and_line() -> dict[str, list[dt.date]]:
        touched = warehouse.board_parts(warehouse.days_of_boards(batch))
        quality_days = days_of_quality(touched, batch)
        stations = models.as_declared(quality_of_days(warehouse, quality_days), models.QUALITY)
        warehouse.replace_days(models.QUALITY.name, stations, quality_days, as_of)
        line_days = sorted(set(quality_days) | set(days_of_first_pass(touched, batch)))
        stations = warehouse.table(models.QUALITY.name, models.QUALITY.schema, line_days)
        line = linewise(stations, first_pass_of_days(warehouse, line_days))
        warehouse.replace_days(models.LINEWISE.name, models.as_declared(line, models.LINEWISE), line_days, as_of)
        return {models.QUALITY.name: quality_days, models.LINEWISE.name: line_days}

    def replace_legacy_line() -> dict[str, list[dt.date]]:
        line = views.LEGACY_LINEWISE
        touched = warehouse.board_parts(warehouse.days_of_boards(batch))
        days = sorted({*own_days, *days_of_first_pass(touched, batch, ["serial_number"])})
        boards = history(warehouse, warehouse.board_parts(days), ["serial_number"])
        rows = views.legacy_line_of_days(warehouse, days, boards)
        warehouse.replace_days(line.name, models.as_declared(rows, line), days, as_of)
        return {line.name: days}

    def replace_fact() -> dict[str, list[dt.date]]:
        fact, demoted = views.FACT, sorted({*replaced[models.QUALITY.name]} - {*own_days})
        rows = views.fact_of_days(warehouse, own_days, demoted)
        warehouse.replace_days(fact.name, models.as_declared(rows, fact), own_days + demoted, as_of)
        return {fact.name: own_days + demoted}

    own = [models.PERFORMANCE, models.AVAILABILITY, *[kept_up[v.name] for v in (views.LEGACY_PERFORMANCE, views.LEGACY_QUALITY) if v.name in kept_up]]
    after = {views.LEGACY_LINEWISE.name: replace_legacy_line, views.FACT.name: replace_fact}
    replaced: dict[str, list[dt.date]] = {}
    for jobs in ([*[partial(replace_own, m) for m in own], replace_quality_and_line], [after[name] for name in after if name in kept_up]):
        for days in at_once(warehouse.spark, jobs):
            replaced.update(days)
    return replaced


def since_high_water_mark(bookings: DataFrame, target: DataFrame) -> DataFrame:
    """Bookings at or after the newest hour that `target` holds; all of them if it holds none.

    The mark is fetched first, as one value, so that it reaches the scan as a pushed filter. A booking stamped
    exactly on the hour belongs to it, so the hour is recomputed whole.
    """
    mark = target.agg(F.max("date_hour").cast("string")).first()[0]
    if mark is None:
        return bookings
    return bookings.where(F.col("date_created") >= F.lit(mark).cast("timestamp_ntz"))
