"""Physical plans: what is scanned, pushed down, broadcast and shuffled."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from yieldline import schemas
from yieldline.plans.availability import availability
from yieldline.plans.linewise import first_pass
from yieldline.plans.oee import station_hour_fact
from yieldline.plans.performance import performance
from yieldline.plans.quality import quality
from yieldline.plans.refresh import since_high_water_mark
from yieldline.session import new_folder
from yieldline.sources.events import read_bookings
from yieldline.sources.tables import Warehouse


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return [set(re.findall(r"(\w+):", s)) for s in re.findall(r"ReadSchema: struct<(.*?)>", text)]


@pytest.fixture(scope="module")
def bookings(spark, folder):
    return read_bookings(spark, folder)


def test_performance(bookings, ideal):
    text = plan(performance(bookings, ideal))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert text.count("Exchange hashpartitioning") == 1
    assert read_columns(text) == [{"event_id", "ts", "value"}]


def test_availability_has_no_window_and_no_sort(bookings):
    text = plan(availability(bookings))
    assert "Window" not in text and "Sort" not in text
    assert text.count("Exchange") == 1
    assert read_columns(text) == [{"event_id", "ts"}]


def test_quality_scans_once_and_aggregates_before_every_shuffle(bookings):
    text = plan(quality(bookings))
    assert len(read_columns(text)) == 1
    assert "Join" not in text and "Expand" not in text
    assert text.count("Exchange") == 3
    assert "partial_max" in text


def test_first_pass_never_shuffles_bookings_unaggregated(bookings):
    text = plan(first_pass(bookings))
    assert text.count("Exchange") == 2 and text.count("partial_") >= 2


def test_hourly_fact_scans_once(bookings, ideal):
    text = plan(station_hour_fact(bookings, ideal))
    assert len(read_columns(text)) == 1
    assert text.count("Join") == text.count("BroadcastHashJoin") == 1


def test_high_water_mark_reaches_the_scan(bookings, ideal):
    target = performance(bookings.where(F.col("date_created") < F.expr("timestamp_ntz'2024-01-20 00:00:00'")), ideal)
    text = plan(since_high_water_mark(bookings, target))
    assert "GreaterThanOrEqual(ts,2024-01-19T" in text


def test_day_filter_prunes_partitions(spark, bookings):
    warehouse = Warehouse(spark, new_folder(spark, "plans")).create()
    warehouse.append_facts(bookings, skip_present=False)
    text = plan(warehouse.facts([dt.date(2024, 1, 5)]).select("booking_id"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_day", text)
    assert {"booking_id"} in read_columns(plan(warehouse.stored_ids(bookings)))


def test_incremental_refresh_reads_no_unfiltered_facts(spark, bookings, monkeypatch):
    """Every scan of the facts and of boards is pruned to days, every scan of the index of boards to the boards' buckets."""
    from pyspark.sql.readwriter import DataFrameWriter

    from yieldline.plans import refresh
    from yieldline.sources import layered, tables

    monkeypatch.setattr(layered, "BUCKET_ROWS", 64)
    warehouse = Warehouse(spark, new_folder(spark, "plans")).create()
    warehouse.append_facts(bookings, skip_present=False)
    refresh.full_refresh(warehouse)
    batch = bookings.where("booking_id < '2'")
    texts, write, days = [], DataFrameWriter.parquet, tables.distinct_days

    def noted(writer, *args, **options):
        texts.append(plan(writer._df))
        return write(writer, *args, **options)

    def noted_days(rows, *args):
        texts.append(plan(rows))
        return days(rows, *args)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    monkeypatch.setattr(refresh, "distinct_days", noted_days)
    monkeypatch.setattr(tables, "distinct_days", noted_days)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")  # whole paths in plans
    try:
        refresh.incremental_refresh(warehouse, batch)
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for text in texts for line in text.splitlines() if "FileScan" in line]
    facts = [line for line in scans if "/station_records" in line]
    assert facts and all(re.search(r"PartitionFilters: \[[^\]]*event_day", line) for line in facts)
    boards, index = ([line for line in scans if f"/facts/{name}/" in line] for name in ("boards", "board_days"))
    assert boards and all(re.search(r"PartitionFilters: \[[^\]]*event_day", line) for line in boards)
    assert index and all(re.search(r"PartitionFilters: \[[^\]]*bucket", line) for line in index)


def test_ids_are_looked_up_in_their_buckets(spark, bookings, monkeypatch):
    """The id check reads the buckets of the incoming ids, not all stored ids."""
    from yieldline.sources import layered

    monkeypatch.setattr(layered, "BUCKET_ROWS", 16)
    warehouse = Warehouse(spark, new_folder(spark, "plans")).create()
    warehouse.append_facts(bookings, skip_present=False)
    buckets = warehouse.log.layers()[0]["buckets"]
    few = bookings.limit(3)
    found = warehouse.stored_ids(few)
    text = plan(found)
    chosen = re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ (?:IN|INSET) \(?([^)]*)\)", text) or re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = (\d+)", text)
    assert buckets >= 32 and 1 <= len(chosen[1].split(",")) <= 3
    assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in few.select("booking_id").collect())
    assert "Exchange hashpartitioning(booking_id" not in text.split("BroadcastExchange")[0]


def test_no_query_multiplies_rows(spark, folder):
    """Only equi joins: no cross join and no nested loop."""
    from yieldline.catalog import QUERIES

    for name, run in QUERIES.items():
        if name[0] not in "st":  # these write tables and read them back: see below
            text = plan(run(spark, folder))
            assert "CartesianProduct" not in text and "NestedLoop" not in text, name


@pytest.mark.parametrize("name", ["s9_upsert_keep_existing", "s14_replace_by_key", "s16_quality_incremental", "t1_ingest", "t4_totals_with_late_bookings", "t6_scheduled_runs"])
def test_no_written_table_multiplies_rows(spark, folder, name, monkeypatch):
    """The same for what these queries write on their way, inside micro-batches too."""
    from pyspark.sql.readwriter import DataFrameWriter
    from yieldline.catalog import QUERIES

    texts, write = [], DataFrameWriter.parquet

    def noted(writer, *args, **options):
        texts.append(plan(writer._df))
        return write(writer, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    texts.append(plan(QUERIES[name](spark, folder)))
    assert texts
    assert not [t for t in texts if "CartesianProduct" in t or "NestedLoop" in t]


def test_reference_rows_have_exact_statistics(spark):
    stats = schemas.stations(spark)._jdf.queryExecution().optimizedPlan().stats()
    assert int(str(stats.sizeInBytes())) < 10_000
