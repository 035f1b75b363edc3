"""Distinct boards of coarse periods from stored hours; board results out of a keyed state."""

import pytest
from pyspark.sql import functions as F

from test_plans import plan
from test_properties import bag, random_rows
from yieldline.operators.attempts import is_fail, is_pass
from yieldline.plans.distinct import DistinctBoards
from yieldline.session import new_folder
from yieldline.sources import layered
from yieldline.sources.layered import Log
from yieldline.sources.tables import Warehouse
from yieldline.streaming import boards


def counted(bookings, *period):
    serial = F.col("serial_number")
    return bookings.groupBy(*period).agg(
        F.count_distinct(serial).alias("boards"),
        F.count_distinct(F.when(is_fail(), serial)).alias("fail_boards"),
        F.count_distinct(F.when(is_pass(), serial)).alias("pass_boards"),
    )


@pytest.mark.parametrize("fold, bucket_rows", [(16, 1 << 20), (2, 8)])
def test_counts_equal_distinct_counts(spark, make_bookings, monkeypatch, fold, bucket_rows):
    monkeypatch.setattr(layered, "FOLD", fold)
    monkeypatch.setattr(layered, "BUCKET_ROWS", bucket_rows)
    rows = random_rows(21, n=150, hot=0.3)
    stored = DistinctBoards(Warehouse(spark, new_folder(spark, "distinct")))
    for i in range(3):
        stored.add(make_bookings(rows[50 * i : 50 * i + 50] + rows[: 10 * i]))
    whole = make_bookings(rows)
    day, hour_day = F.to_date("date_created").alias("day"), F.to_date("date_hour").alias("day")
    assert bag(stored.counts("station_number", hour_day)) == bag(counted(whole, "station_number", day))
    month, hour_month = F.trunc(F.to_date("date_created"), "month").alias("m"), F.trunc(F.to_date("date_hour"), "month").alias("m")
    assert bag(stored.counts(hour_month)) == bag(counted(whole, month))
    numbers = sorted(r.number for r in stored._numbers.read().collect())
    assert numbers == list(range(len({r[1] for r in rows})))


def test_counts_read_no_bookings(spark, make_bookings):
    warehouse = Warehouse(spark, new_folder(spark, "distinct"))
    stored = DistinctBoards(warehouse)
    bookings = make_bookings(random_rows(22, n=40))
    warehouse.append_facts(bookings)
    stored.add(bookings, "s", 0)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        scans = [line for line in plan(stored.counts("station_number")).splitlines() if "FileScan" in line]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert scans and all("board_bitmaps" in line for line in scans)


def test_a_load_lost_between_numbers_and_bitmaps(spark, make_bookings, monkeypatch):
    stored = DistinctBoards(Warehouse(spark, new_folder(spark, "distinct")))
    bookings, real, calls = make_bookings(random_rows(23, n=60)), Log.append, []

    def lost(self, *args):
        calls.append(self.path)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(self, *args)

    monkeypatch.setattr(Log, "append", lost)
    with pytest.raises(RuntimeError):
        stored.add(bookings, "s", 0)
    for _ in range(2):
        stored.add(bookings, "s", 0)
    assert bag(stored.counts("station_number")) == bag(counted(bookings, "station_number"))


def test_state_gives_the_same_as_maxima_and_only_changes(spark, make_bookings):
    def booking(i, serial, state, attempt):
        return (f"b{i}", serial, "1003", state, f"2025-10-25T10:0{i}:00", "P1", "4.00", attempt)

    path = new_folder(spark, "states")
    deliveries = (
        [booking(1, "S1", "FAIL", 1), booking(2, "S2", "PASS", 1)],
        [booking(3, "S1", "PASS", 2), booking(4, "S2", "PASS", 1), booking(5, "S3", "FAIL", None)],
        [booking(6, "S1", "FAIL", 1)],
    )
    changed = []
    for part in deliveries:
        rows = make_bookings(part)
        rows.coalesce(1).write.mode("append").parquet(f"{path}/arriving")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/arriving")
        boards.start_board_states(stream, f"{path}/log", f"{path}/checkpoint").awaitTermination()
        changed.append(boards.board_log(spark, f"{path}/log").read().count())
    assert changed == [2, 3, 3]  # a booking without an attempt, and one that changes no maximum, give no row
    found = {r.serial_number: (r.latest_attempt, r.failed, r.passed) for r in boards.last_results(spark, f"{path}/log").collect()}
    assert found == {"S1": (2, False, True), "S2": (1, False, True)}


def test_a_board_seen_again_after_its_state_was_dropped(spark, make_bookings):
    path = new_folder(spark, "states")
    for i, (state, attempt) in enumerate([("PASS", 3), ("FAIL", 1)]):
        rows = make_bookings([(f"b{i}", "S1", "1003", state, f"2025-10-25T10:0{i}:00", "P1", "4.00", attempt)])
        rows.coalesce(1).write.mode("append").parquet(f"{path}/arriving")
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/arriving")
        boards.start_board_states(stream, f"{path}/log", f"{path}/checkpoint", forget_after_ms=1).awaitTermination()
    assert boards.board_log(spark, f"{path}/log").read().count() == 2
    assert [(r.latest_attempt, r.failed, r.passed) for r in boards.last_results(spark, f"{path}/log").collect()] == [(3, False, True)]


def test_the_keyed_state_runs_no_python_for_each_board(spark, make_bookings):
    path = new_folder(spark, "states")
    rows = make_bookings([(f"b{i}", f"S{i}", "1003", "PASS", "2025-10-25T10:00:00", "P1", "4.00", 1) for i in range(50)])
    rows.write.parquet(f"{path}/arriving")
    stream = spark.readStream.schema(rows.schema).parquet(f"{path}/arriving")
    run = boards.start_board_states(stream, f"{path}/log", f"{path}/checkpoint")
    run.awaitTermination()
    assert [x["operatorName"] for x in run.lastProgress["stateOperators"]] == ["stateStoreSave"]
    assert boards.last_results(spark, f"{path}/log").where("passed").count() == 50
