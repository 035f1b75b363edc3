"""Commits: a job lost at any step leaves the old table or the new one; logs stay whole while they are folded."""

import datetime as dt
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from test_properties import bag, random_rows
from test_refresh import built_models, new_warehouse, stored_models
from yieldline.plans import models
from yieldline.plans.refresh import full_refresh, incremental_refresh
from yieldline.session import new_folder
from yieldline.sources import commits, layered
from yieldline.sources.commits import CommitLog
from yieldline.sources.layered import DayTable, Log, Member, StaleRefresh
from yieldline.streaming import boards, hourly
from yieldline.streaming.clock import BY_HAND


class Lost(Exception):
    pass


def fail_at(monkeypatch, place, name, when=0):
    """Let the call number `when` of a function fail, as if the driver died there."""
    calls, real = [0], getattr(place, name)

    def failing(*args, **options):
        calls[0] += 1
        if calls[0] - 1 == when:
            raise Lost(name)
        return real(*args, **options)

    monkeypatch.setattr(place, name, failing)


STEPS = [(layered, "write_layer", 0), (CommitLog, "_put", 0)]


def test_commits_are_numbered_and_exclusive(spark):
    log = CommitLog(spark, new_folder(spark, "log"))
    assert log.latest() == (0, {})
    for n in range(30):
        log.commit(lambda state: {"n": state.get("n", 0) + 1})
    assert log.latest() == (30, {"n": 30}) and len(log.numbers()) == commits.KEPT
    assert not log._put(30, {"n": -1}) and log.latest()[1] == {"n": 30}
    assert log.commit(lambda state: None) == {"n": 30} and log.latest()[0] == 30
    (Path(log.folder) / "_commits" / ".draft").write_text("{half")  # a writer died before its rename
    assert log.latest() == (30, {"n": 30})
    threads = [threading.Thread(target=lambda: [log.commit(lambda s: {"n": s["n"] + 1}) for _ in range(5)]) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert log.latest()[1] == {"n": 50}


def test_a_race_for_a_number_starts_over(spark, monkeypatch):
    log, real, lost = CommitLog(spark, new_folder(spark, "log")), CommitLog._put, []

    def beaten(self, number, state):
        if len(lost) < 3:
            lost.append(number)
            real(self, number, {"other": number})
        return real(self, number, state)

    monkeypatch.setattr(CommitLog, "_put", beaten)
    assert log.commit(lambda state: state | {"mine": 1}) == {"other": 3, "mine": 1}
    monkeypatch.setattr(CommitLog, "_put", lambda *_: False)
    with pytest.raises(commits.LostRace):
        log.commit(lambda state: state | {"mine": 2})


def days_table(spark, rows, schema="date_hour TIMESTAMP_NTZ, station_number STRING, n INT"):
    return spark.createDataFrame([(dt.datetime.fromisoformat(d), s, n) for d, s, n in rows], schema)


@pytest.mark.parametrize("place, name, when", STEPS)
def test_a_lost_replacement_leaves_the_old_table(spark, monkeypatch, place, name, when):
    table = DayTable(spark, new_folder(spark, "days"))
    old = days_table(spark, [("2025-01-01T10:00:00", "a", 1), ("2025-01-02T10:00:00", "a", 2)])
    new = days_table(spark, [("2025-01-02T11:00:00", "b", 3)])
    table.replace(old, day_of="date_hour")
    days = [dt.date(2025, 1, 2), dt.date(2025, 1, 1)]
    for step in (lambda: table.replace(new, day_of="date_hour"), lambda: table.replace_days(new, days[:1])):
        with monkeypatch.context() as patched:
            fail_at(patched, place, name, 0)
            with pytest.raises(Lost):
                step()
        assert bag(table.read(old.schema)) == bag(old)
    table.replace_days(new, days[:1])
    assert sorted(r.n for r in table.read(old.schema).collect()) == [1, 3]
    table.replace_days(new.limit(0), days)
    assert table.read(old.schema).collect() == []


@pytest.mark.parametrize("place, name, when", [*STEPS, (layered, "write_layer", 3)])
def test_a_lost_load_is_in_no_table_and_is_stored_by_its_replay(spark, make_bookings, monkeypatch, place, name, when):
    rows = random_rows(11, n=60)
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(rows[:30]), load=("s", 0))
    full_refresh(warehouse)
    before = [bag(warehouse.log.read(m)) for m in warehouse.log.members]
    arrived = make_bookings(rows[30:])
    with monkeypatch.context() as patched:
        fail_at(patched, place, name, when)
        with pytest.raises(Lost):
            warehouse.append_facts(arrived, load=("s", 1))
    assert [bag(warehouse.log.read(m)) for m in warehouse.log.members] == before
    for _ in range(2):
        warehouse.append_facts(arrived, load=("s", 1))
        incremental_refresh(warehouse, arrived)
    assert warehouse.facts().count() == 60 == warehouse.log.read("ids").count()
    assert stored_models(warehouse) == built_models(warehouse)


def test_a_refresh_lost_between_tables_is_made_up_for(spark, make_bookings, monkeypatch):
    rows = random_rows(12, n=80)
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(rows[:40]))
    full_refresh(warehouse)
    arrived = make_bookings(rows[40:])
    warehouse.append_facts(arrived)
    for when in (0, 2):
        with monkeypatch.context() as patched:
            fail_at(patched, CommitLog, "_put", when)
            with pytest.raises(Lost):
                incremental_refresh(warehouse, arrived)
    incremental_refresh(warehouse, arrived)
    assert stored_models(warehouse) == built_models(warehouse)


def test_a_load_beside_a_full_refresh_is_not_lost(spark, make_bookings, monkeypatch):
    """The load commits and is refreshed while a full refresh is at work on the facts from before it."""
    rows = random_rows(13, n=80)
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(rows[:40]))
    full_refresh(warehouse)
    arrived, real, done = make_bookings(rows[40:]), DayTable._write, []

    def slow(self, *args):
        if not done:
            done.append(1)
            warehouse.append_facts(arrived)
            incremental_refresh(warehouse, arrived)
        return real(self, *args)

    monkeypatch.setattr(DayTable, "_write", slow)
    full_refresh(warehouse)
    assert stored_models(warehouse) == built_models(warehouse)
    with pytest.raises(StaleRefresh):
        warehouse.replace_table(models.PERFORMANCE.name, warehouse.table(models.PERFORMANCE.name, models.PERFORMANCE.schema), 1)
    assert stored_models(warehouse) == built_models(warehouse)


def folders(path):
    return [p for p in Path(path).rglob("version=*")]


def test_many_loads_are_folded_and_nothing_changes(spark, make_bookings, monkeypatch):
    """Loads, boards, index and ids stay whole; a read opens a bounded number of layers however many loads there were."""
    monkeypatch.setattr(layered, "FOLD", 3)
    monkeypatch.setattr(layered, "BUCKET_ROWS", 8)
    rows = random_rows(14, n=60, hot=0.3)
    warehouse = new_warehouse(spark)
    for i in range(10):
        part = rows[6 * i : 6 * i + 6] + rows[: 2 * i]  # some of the earlier ones come again
        warehouse.append_facts(make_bookings(part))
        assert len(warehouse.log.layers()) <= 6
    assert warehouse.facts().count() == 60
    assert len({x["tier"] for x in warehouse.log.layers()}) > 1
    assert bag(warehouse.log.read("ids")) == bag(warehouse.facts().select("booking_id"))
    full_refresh(warehouse)
    assert stored_models(warehouse) == built_models(warehouse)
    gone = len(folders(warehouse.path("facts")))
    monkeypatch.setattr(commits, "KEEP_SECONDS", -1)
    warehouse.append_facts(make_bookings(rows[:1]))
    assert len(folders(warehouse.path("facts"))) < gone / 2
    assert warehouse.facts().count() == 60


def test_a_fold_beside_a_writer_keeps_both(spark, monkeypatch):
    monkeypatch.setattr(layered, "FOLD", 4)
    schema = T.StructType([T.StructField("n", T.LongType())])
    log, real, raced = Log(spark, new_folder(spark, "log"), {"rows": Member(schema)}), CommitLog._put, []

    def beaten(self, number, state):
        if any(x["tier"] for x in state["layers"]) and not raced:
            raced.append(1)
            log.append(spark.range(100, 101).toDF("n"), "other", 0)
        return real(self, number, state)

    monkeypatch.setattr(CommitLog, "_put", beaten)
    for i in range(4):
        log.append(spark.range(i, i + 1).toDF("n"), "s", i)
    assert sorted(r.n for r in log.read().collect()) == [0, 1, 2, 3, 100] and raced
    assert not log.append(spark.range(5).toDF("n"), "s", 3)


def test_stream_logs_after_many_batches(spark, make_bookings, monkeypatch):
    monkeypatch.setattr(layered, "FOLD", 3)
    rows = random_rows(15, n=26)
    warehouse = new_warehouse(spark)
    routed, path = hourly.Routed(warehouse, "hourly"), warehouse.path("last")
    for i in range(13):
        part = make_bookings(rows[2 * i : 2 * i + 2])
        boards.board_log(spark, path).append(boards.tops(part), BY_HAND, i)
        routed.on_time_log.append(hourly.add_up(hourly.hour_partials(part)).select(*hourly.PARTIALS.names), BY_HAND, i)
    whole = make_bookings(rows)
    assert bag(boards.last_results(spark, path)) == bag(boards.judged(boards.tops(whole)))
    assert bag(routed.totals()) == bag(hourly.add_up(hourly.hour_partials(whole)))
    assert len(routed.on_time_log.layers()) <= 6 and len(boards.board_log(spark, path).layers()) <= 6
    assert routed.on_time().count() <= 6 * len({r[:3] for r in map(tuple, routed.totals().collect())})


def test_days_written_with_other_columns_stay_readable(spark, monkeypatch):
    """Columns are added, dropped and change their type; then days are replaced. Old days show what they have."""
    table = DayTable(spark, new_folder(spark, "days"))
    first = days_table(spark, [("2025-01-01T10:00:00", "a", 1), ("2025-01-02T10:00:00", "b", 2), ("2025-01-03T10:00:00", "c", 3)])
    table.replace(first, day_of="date_hour")
    wider = first.withColumn("n", F.col("n").cast("bigint") + 2**40).drop("station_number").withColumn("note", F.lit("new"))
    table.replace_days(wider.where("day(date_hour) = 2"), [dt.date(2025, 1, 2)])
    assert sorted((r.date_hour.day, r.n, r.note) for r in table.read(wider.schema).collect()) == [(1, 1, None), (2, 2 + 2**40, "new"), (3, 3, None)]
    again = wider.withColumn("n", F.col("n").cast("string"))
    table.replace_days(again.where("day(date_hour) = 3"), [dt.date(2025, 1, 3)])
    assert sorted((r.date_hour.day, r.n) for r in table.read(again.schema).collect()) == [(1, "1"), (2, str(2 + 2**40)), (3, str(3 + 2**40))]
    assert [r.date_hour.day for r in table.read(again.schema, [dt.date(2025, 1, 3)]).collect()] == [3]
    monkeypatch.setattr(layered, "FOLD", 2)
    table.replace_days(again.where("day(date_hour) = 2"), [dt.date(2025, 1, 2)])
    for day in (1, 2):
        table.replace_days(again.where(f"day(date_hour) = {day}"), [dt.date(2025, 1, day)])
    assert len(table.layers()) <= 3
    assert bag(table.read(again.schema)) == bag(again)


def test_incremental_refresh_after_a_model_changed(spark, make_bookings):
    rows = random_rows(16, n=60)
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(rows[:30]))
    full_refresh(warehouse)
    old = warehouse.table(models.PERFORMANCE.name, models.PERFORMANCE.schema)
    changed = old.withColumn("count_bookings", F.col("count_bookings").cast("int")).drop("avg_cycle_time").withColumn("gone", F.lit(1))
    warehouse.replace_table(models.PERFORMANCE.name, changed)
    arrived = make_bookings(rows[30:])
    warehouse.append_facts(arrived)
    days = {str(d) for d in incremental_refresh(warehouse, arrived)[models.PERFORMANCE.name]}
    built, stored = (
        {tuple(r[c] for c in ("station_number", "date_hour", "part_number")): r for r in frame.collect()}
        for frame in (models.PERFORMANCE.build(warehouse.facts(), lambda _: warehouse.ideal_cycle_times()), warehouse.table(models.PERFORMANCE.name, models.PERFORMANCE.schema))
    )
    assert built.keys() == stored.keys()
    for key, row in built.items():
        if str(key[1])[:10] in days:
            assert stored[key] == row
        else:
            assert stored[key].count_bookings == row.count_bookings and stored[key].avg_cycle_time is None
    full_refresh(warehouse)
    assert stored_models(warehouse) == built_models(warehouse)


def test_a_warehouse_of_an_earlier_layout_is_refused(spark):
    warehouse = new_warehouse(spark)
    spark.range(1).withColumn("event_day", F.lit("2025-01-01")).write.partitionBy("event_day").parquet(warehouse.path("station_records"))
    with pytest.raises(ValueError, match="earlier layout"):
        warehouse.create()
