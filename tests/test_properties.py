"""Rewritten jobs against plain definitions, on random and on skewed bookings."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from yieldline.functions.timing import bucket
from yieldline.operators.windows import group_max, previous_booking, running_max
from yieldline.plans.availability import availability, availability_by_gaps
from yieldline.plans.legacy import legacy_quality
from yieldline.plans.linewise import first_pass, linewise
from yieldline.plans.oee import merge_models, station_hour_fact
from yieldline.plans.performance import cycle_totals, performance
from yieldline.plans.quality import quality, quality_two_branches

START = dt.datetime(2025, 10, 25, 22, 0)


def random_rows(seed, n=600, hot=0.0):
    """Bookings with retests, repeated timestamps, missing attempts and other results; with `hot`
    that share of them belongs to one board at one station."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        is_hot = rng.random() < hot
        at = START + dt.timedelta(seconds=rng.choice([0, 1, 1, 60, 3600, 7200, 90000]) + rng.randint(0, 40))
        rows.append(
            (
                f"b{i}",
                "HOT" if is_hot else f"S{rng.randint(1, 40)}",
                "1008" if is_hot else rng.choice(["1001", "1003", "1008", "1099"]),
                rng.choice(["PASS", "PASS", "FAIL", "SKIP"]),
                at.isoformat(),
                rng.choice(["P1", "P2"]),
                f"{rng.randint(0, 900) / 100:.2f}",
                rng.choice([1, 1, 2, 3, None]),
            )
        )
    return rows


@pytest.fixture(scope="module", params=[(1, 0.0), (2, 0.4)], ids=["even", "hot"])
def case(request, make_bookings):
    rows = random_rows(request.param[0], hot=request.param[1])
    return rows, make_bookings(rows).cache()


def bag(frame):
    return sorted(map(repr, (tuple(r) for r in frame.select(*sorted(frame.columns)).collect())))


def hour_of(text):
    return dt.datetime.fromisoformat(text).replace(minute=0, second=0, microsecond=0)


def brute_quality(rows):
    top = {}
    for _, serial, station, _, _, _, _, attempt in rows:
        if attempt is not None:
            top[station, serial] = max(top.get((station, serial), attempt), attempt)
    out = defaultdict(lambda: [0, 0, 0, set(), set(), set()])
    for _, serial, station, state, at, part, _, attempt in rows:
        cell = out[station, part, hour_of(at)]
        cell[0] += 1
        cell[1] += state == "FAIL"
        cell[2] += state == "PASS"
        if attempt is not None and attempt == top[station, serial]:
            cell[3].add(serial)
            cell[4] |= {serial} if state == "FAIL" else set()
            cell[5] |= {serial} if state == "PASS" else set()
    return sorted((*k, *v[:3], *map(len, v[3:])) for k, v in out.items())


def test_quality_against_brute_force(case):
    rows, bookings = case
    frame = quality(bookings).select(
        "station_number", "part_number", "date_hour", "total_bookings", "fail_bookings", "pass_bookings",
        "total_pcb", "fail_pcb", "pass_pcb",
    )
    assert sorted(map(tuple, frame.collect())) == brute_quality(rows)


def test_quality_equals_two_branch_form(case):
    assert bag(quality(case[1])) == bag(quality_two_branches(case[1]))


def test_legacy_quality_against_the_running_window(case):
    bookings = case[1]
    board = Window.partitionBy("station_number", "serial_number", "date_hour").orderBy("date_created")
    frame = board.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = bookings.withColumn("date_hour", bucket("date_created"))
    final = rows.withColumn("top", F.max("test_count").over(frame)).where("test_count = top")
    boards = final.groupBy("station_number", "date_hour").agg(
        F.count_distinct("serial_number").alias("total_pcb"),
        F.count_distinct(F.when(F.col("book_state") == "FAIL", F.col("serial_number"))).alias("fail_pcb"),
        F.count_distinct(F.when(F.col("book_state") == "PASS", F.col("serial_number"))).alias("pass_pcb"),
    )
    got = legacy_quality(bookings).select("station_number", "date_hour", "total_pcb", "fail_pcb", "pass_pcb")
    assert bag(got.where("total_pcb > 0")) == bag(boards)


def test_availability_equals_sum_of_gaps(case):
    assert bag(availability(case[1])) == bag(availability_by_gaps(case[1]))


@pytest.mark.parametrize("grain", ["hour", "day"])
def test_fact_equals_merge_of_models(case, ideal, grain):
    b = case[1]
    merged = merge_models(cycle_totals(b, grain), ideal, availability(b, grain), quality(b, grain))
    assert bag(station_hour_fact(b, ideal, grain)) == bag(merged)


def test_split_windows_equal_plain_windows(case):
    rows = case[1].withColumn("date_hour", bucket("date_created"))
    board, hour = ["station_number", "serial_number"], ["station_number", "date_hour"]
    running = (
        Window.partitionBy(*board, "date_hour")
        .orderBy("date_created")
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    plain_top = rows.withColumn("top", F.max("test_count").over(Window.partitionBy(*board)))
    plain_running = rows.withColumn("top", F.max("test_count").over(running))
    assert bag(group_max(rows, board, "test_count", "top")) == bag(plain_top)
    assert bag(running_max(rows, [*board, "date_hour"], "test_count", "top")) == bag(plain_running)
    # Which of two simultaneous bookings comes first is open, so compare times only.
    by_time = Window.partitionBy(*hour).orderBy("date_created")
    plain_gap = rows.withColumn("previous_created", F.lag("date_created").over(by_time))
    columns = (*hour, "date_created", "previous_created")
    assert bag(previous_booking(rows, hour).select(*columns)) == bag(plain_gap.select(*columns))


def test_invariants(case, ideal):
    rows, bookings = case
    perf, qual = performance(bookings, ideal), quality(bookings)
    assert perf.count() == qual.count()
    assert qual.agg(F.sum("total_bookings")).first()[0] == len(rows)
    assert qual.where("fail_bookings + pass_bookings > total_bookings").isEmpty()
    assert availability(bookings).where("availability < 0 OR availability > 1").isEmpty()
    line = linewise(qual, first_pass(bookings))
    off = F.abs(F.col("pass_pcb_linewise_percent") + F.col("scrap_pcb_linewise_percent") - 100) > 0.01
    assert line.where("total_pcb_linewise > 0").where(off).isEmpty()
    summary = first_pass(bookings)
    assert summary.where("fpy_pcbs + reworked_pcbs <> total_pcbs").isEmpty()
