"""Incremental refresh equals full refresh for any split and order of batches."""

import random

import pytest

from test_properties import bag, random_rows
from yieldline.operators import merge
from yieldline.plans import models
from yieldline.plans.oee import station_hour_fact
from yieldline.plans.refresh import full_refresh, incremental_refresh
from yieldline.plans.views import FACT, VIEWS
from yieldline.session import new_folder
from yieldline.sources.tables import Warehouse


def new_warehouse(spark):
    return Warehouse(spark, new_folder(spark, "refresh")).create()


def stored_models(warehouse, wanted=models.MODELS):
    return {m.name: bag(warehouse.table(m.name, m.schema)) for m in wanted.values()}


def built_models(warehouse, wanted=models.MODELS):
    built = {}
    for model in wanted.values():
        built[model.name] = model.build(
            warehouse.facts(), lambda n: built[n] if n in built else warehouse.ideal_cycle_times()
        )
    return {name: bag(frame) for name, frame in built.items()}


@pytest.mark.parametrize("seed, hot", [(3, 0.0), (4, 0.35)])
def test_incremental_equals_full(spark, make_bookings, seed, hot):
    rng = random.Random(seed)
    rows = random_rows(seed, n=160, hot=hot)
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(40, 160), 2))
    batches = [rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :] + rows[:5]]
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(batches[0]))
    full_refresh(warehouse)
    for batch in batches[1:]:
        arrived = make_bookings(batch)
        warehouse.append_facts(arrived)
        incremental_refresh(warehouse, arrived)
    assert warehouse.facts().count() == 160
    assert stored_models(warehouse) == built_models(warehouse)


@pytest.mark.parametrize("seed, hot", [(6, 0.35)])
def test_stored_views_follow_every_batch(spark, make_bookings, seed, hot):
    """The older views and the hourly fact, kept up batch by batch, equal the same computed from all facts."""
    rows = random_rows(seed, n=120, hot=hot)
    random.Random(seed).shuffle(rows)
    wanted = {**models.MODELS, **VIEWS}
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(rows[:50]))
    full_refresh(warehouse, also=VIEWS)
    for batch in (rows[50:80], rows[80:] + rows[:5]):
        arrived = make_bookings(batch)
        warehouse.append_facts(arrived)
        replaced = incremental_refresh(warehouse, arrived)
        assert set(replaced) == set(wanted)
        assert stored_models(warehouse, wanted) == built_models(warehouse, wanted)
    ideal = warehouse.ideal_cycle_times()
    whole = models.as_declared(station_hour_fact(warehouse.facts(), ideal), FACT)
    assert bag(warehouse.table(FACT.name, FACT.schema)) == bag(whole.select(*warehouse.table(FACT.name, FACT.schema).columns))


def test_day_that_loses_all_rows_is_emptied(spark, make_bookings):
    """A board's last booking moves to the next day; the old day has no line row any more."""
    first = [("b1", "S1", "1008", "PASS", "2025-10-25T10:00:00", "P1", "4.00", 1)]
    second = [("b2", "S1", "1008", "PASS", "2025-10-26T10:00:00", "P1", "4.00", 2)]
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(first))
    full_refresh(warehouse)
    for _ in range(2):  # repeating a refresh changes nothing
        arrived = make_bookings(second)
        warehouse.append_facts(arrived)
        replaced = incremental_refresh(warehouse, arrived)
        assert stored_models(warehouse) == built_models(warehouse)
    assert [len(replaced[n]) for n in sorted(replaced)] == [1, 1, 2, 2]
    line = warehouse.table("quality_linewise_datehour", models.LINEWISE.schema)
    assert [str(r.date_hour) for r in line.collect()] == ["2025-10-26 10:00:00"]


def test_unaffected_days_are_left_alone(spark, make_bookings):
    rows = [(f"b{d}", f"S{d}", "1008", "PASS", f"2025-10-{d}T10:00:00", "P1", "4.00", 1) for d in range(10, 20)]
    warehouse = new_warehouse(spark)
    warehouse.append_facts(make_bookings(rows[:-1]))
    full_refresh(warehouse)
    arrived = make_bookings(rows[-1:])
    warehouse.append_facts(arrived)
    replaced = incremental_refresh(warehouse, arrived)
    assert {len(days) for days in replaced.values()} == {1}
    assert stored_models(warehouse) == built_models(warehouse)


def test_declared_schemas_and_order_of_models(spark, folder, ideal):
    from yieldline.sources.events import read_bookings

    built = {}
    for model in models.MODELS.values():
        built[model.name] = model.build(read_bookings(spark, folder), lambda n: built.get(n, ideal))
        declared = spark.createDataFrame([], model.schema).schema
        assert [(f.name, f.dataType) for f in built[model.name].schema] == [(f.name, f.dataType) for f in declared]
        assert set(model.notes) == set(declared.names)
        commented = models.with_notes(built[model.name], model).schema
        assert all(f.metadata["comment"] for f in commented)
    line = models.LINEWISE
    assert [f.name for f in models.as_declared(built[line.name].drop("fpy_percent"), line).schema] == spark.createDataFrame([], line.schema).columns
    waves = models.in_waves(models.MODELS)
    assert [len(w) for w in waves] == [3, 1]
    circle = models.Model("a", "x INT", None, (), (), (), upstream=("a",))
    with pytest.raises(ValueError):
        models.in_waves({"a": circle})


def test_upserts_and_alignment(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "k INT, v STRING, old INT")
    rows = spark.createDataFrame([(2, "x", 9), (3, "y", 9)], "k INT, v STRING, old INT")
    assert bag(merge.upsert_keep_existing(target, rows.union(rows), ["k"])) == bag(
        spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "y", 9)], "k INT, v STRING, old INT")
    )
    assert bag(merge.upsert_overwrite(target, rows, ["k"])) == bag(
        spark.createDataFrame([(1, "a", 1), (2, "x", 9), (3, "y", 9)], "k INT, v STRING, old INT")
    )
    twice = spark.createDataFrame([(3, "z", 1), (3, "y", 9), (2, "x", 9)], "k INT, v STRING, old INT")
    for upsert, kept in ((merge.upsert_overwrite, (2, "x", 9)), (merge.upsert_keep_existing, (2, "b", 2))):
        by_old = sorted(tuple(r) for r in upsert(target, twice, ["k"], "old").collect())
        assert by_old == [(1, "a", 1), kept, (3, "z", 1)]
        assert (3, "y", 9) in {tuple(r) for r in upsert(target, twice, ["k"]).collect()}
    wanted = spark.createDataFrame([], "v STRING, k BIGINT, fresh DOUBLE").schema
    aligned = merge.align_columns(target, wanted)
    assert aligned.schema.names == ["v", "k", "fresh"]
    assert aligned.where("fresh is not null").isEmpty()
    first = merge.keep_first(target.union(rows), ["k"], "old")
    assert sorted(tuple(r) for r in first.collect()) == [(1, "a", 1), (2, "b", 2), (3, "y", 9)]


def test_days_and_first_pass_need_no_merged_boards(spark, make_bookings, monkeypatch):
    """Boards of several loads are merged once in an incremental refresh, to judge the stations."""
    warehouse, merged = new_warehouse(spark), []
    rows = random_rows(5, n=60, hot=0.2)
    warehouse.append_facts(make_bookings(rows[:40]))
    full_refresh(warehouse)
    warehouse.append_facts(make_bookings(rows[40:]))
    plain = Warehouse.boards
    monkeypatch.setattr(Warehouse, "boards", lambda self, days: merged.append(days) or plain(self, days))
    incremental_refresh(warehouse, make_bookings(rows[40:]))
    assert len(merged) == 1
    assert stored_models(warehouse) == built_models(warehouse)
