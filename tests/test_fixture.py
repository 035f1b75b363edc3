"""Ten hand-made bookings with every edge case, and the rows each job must give."""

import pytest

from oracle import plain
from yieldline.plans.availability import availability, availability_by_gaps
from yieldline.plans.legacy import legacy_linewise, legacy_performance, legacy_quality
from yieldline.plans.linewise import first_pass, linewise
from yieldline.plans.oee import merge_models, oee, station_hour_fact
from yieldline.plans.performance import cycle_totals, performance
from yieldline.plans.quality import quality, quality_two_branches

DAY = "2025-10-25"
ROWS = [
    ("b01", "S1", "1003", "PASS", f"{DAY}T10:00:00", "P1", "4.00", 1),
    ("b02", "S1", "1008", "FAIL", f"{DAY}T10:05:00", "P1", "5.00", 1),
    ("b03", "S1", "1008", "PASS", f"{DAY}T10:20:00.250000", "P1", "5.51", 2),
    ("b04", "S2", "1003", "FAIL", f"{DAY}T10:10:00", "P1", "4.10", 1),
    ("b05", "S2", "1003", "PASS", f"{DAY}T11:02:00", "P1", "4.00", 2),
    ("b06", "S2", "1008", "PASS", f"{DAY}T11:10:00", "P1", "5.00", 1),
    ("b07", "S3", "1008", "PASS", f"{DAY}T11:15:00", "P2", "4.99", 1),
    ("b08", "S4", "1003", "FAIL", f"{DAY}T11:30:00", "P3", "0.00", 1),
    ("b09", "S5", "1099", "PASS", f"{DAY}T11:40:00", "P2", "1.00", 1),
    ("b10", "S6", "1008", "FAIL", f"{DAY}T12:00:00", "P1", "5.00", None),
]


@pytest.fixture(scope="module")
def bookings(make_bookings):
    return make_bookings(ROWS)


def rows_of(frame, *columns):
    def show(value):
        value = plain(value)
        return value[11:16] if isinstance(value, str) and value.startswith(DAY) else value

    return sorted(
        (tuple(show(v) for v in row) for row in frame.select(*columns).collect()),
        key=lambda row: tuple("" if v is None else str(v) for v in row),
    )


def expect(rows):
    return sorted(rows, key=lambda row: tuple("" if v is None else str(v) for v in row))


PERFORMANCE = [
    ("1003", "10:00", "P1", "4.05", "4.00", 2, "98.77"),
    ("1008", "10:00", "P1", "5.26", "5.00", 2, "95.15"),
    ("1003", "11:00", "P1", "4.00", "4.00", 1, "100.00"),
    ("1003", "11:00", "P3", "0.00", "4.00", 1, None),
    ("1008", "11:00", "P1", "5.00", "5.00", 1, "100.00"),
    ("1008", "11:00", "P2", "4.99", "5.00", 1, "100.20"),
    ("1099", "11:00", "P2", "1.00", None, 1, None),
    ("1008", "12:00", "P1", "5.00", "5.00", 1, "100.00"),
]


@pytest.mark.parametrize("job", [performance, legacy_performance])
def test_performance(bookings, ideal, job):
    columns = (
        "station_number", "date_hour", "part_number", "avg_cycle_time", "ideal_cycle_time", "count_bookings",
        "performance_percent",
    )
    assert rows_of(job(bookings, ideal), *columns) == expect(PERFORMANCE)


@pytest.mark.parametrize("job", [availability, availability_by_gaps])
def test_availability(bookings, job):
    got = rows_of(job(bookings), "station_number", "date_hour", "uptime_seconds", "availability")
    assert got == expect(
        [
            ("1003", "10:00", "600.00", "0.1667"),
            ("1008", "10:00", "900.25", "0.2501"),
            ("1003", "11:00", "1680.00", "0.4667"),
            ("1008", "11:00", "300.00", "0.0833"),
            ("1099", "11:00", None, None),
            ("1008", "12:00", None, None),
        ]
    )


COUNTS = ("total_bookings", "fail_bookings", "pass_bookings", "total_pcb", "fail_pcb", "pass_pcb")


@pytest.mark.parametrize("job", [quality, quality_two_branches])
def test_quality(bookings, job):
    assert rows_of(job(bookings), "station_number", "part_number", "date_hour", *COUNTS) == expect(
        [
            ("1003", "P1", "10:00", 2, 1, 1, 1, 0, 1),
            ("1008", "P1", "10:00", 2, 1, 1, 1, 0, 1),
            ("1003", "P1", "11:00", 1, 0, 1, 1, 0, 1),
            ("1003", "P3", "11:00", 1, 1, 0, 1, 1, 0),
            ("1008", "P1", "11:00", 1, 0, 1, 1, 0, 1),
            ("1008", "P2", "11:00", 1, 0, 1, 1, 0, 1),
            ("1099", "P2", "11:00", 1, 0, 1, 1, 0, 1),
            ("1008", "P1", "12:00", 1, 1, 0, 0, 0, 0),
        ]
    )


def test_legacy_quality(bookings):
    assert rows_of(legacy_quality(bookings), "station_number", "date_hour", *COUNTS) == expect(
        [
            ("1003", "10:00", 2, 1, 1, 2, 1, 1),
            ("1008", "10:00", 2, 1, 1, 1, 1, 1),
            ("1003", "11:00", 2, 1, 1, 2, 1, 1),
            ("1008", "11:00", 2, 0, 2, 2, 0, 2),
            ("1099", "11:00", 1, 0, 1, 1, 0, 1),
            ("1008", "12:00", 1, 1, 0, 0, 0, 0),
        ]
    )


LINE = (
    "fpy_pcbs", "fpy_percent", "pass_pcb_linewise", "scrap_pcb_linewise", "total_pcb_linewise",
    "pass_pcb_linewise_percent", "scrap_pcb_linewise_percent",
)


def test_linewise(bookings):
    frame = linewise(quality(bookings), first_pass(bookings))
    assert rows_of(frame, "date_hour", "part_number", *LINE) == expect(
        [
            ("10:00", "P1", 0, "0.00", 1, 0, 1, "100.00", "0.00"),
            ("11:00", "P1", 0, "0.00", 1, 0, 1, "100.00", "0.00"),
            ("11:00", "P2", 2, "200.00", 1, 0, 1, "100.00", "0.00"),
            ("11:00", "P3", 0, None, None, 1, None, None, None),
            ("12:00", "P1", 0, None, 0, 0, 0, None, None),
        ]
    )


def test_legacy_linewise(bookings):
    frame = legacy_linewise(bookings, legacy_quality(bookings))
    assert rows_of(frame, "date_hour", *LINE) == expect(
        [
            ("10:00", 0, "0.00", 1, 2, 3, "33.33", "66.67"),
            ("11:00", 2, "66.67", 2, 1, 3, "66.67", "33.33"),
            ("12:00", 0, None, 0, 0, 0, None, None),
        ]
    )


def test_oee_and_fact_agree_with_merge(bookings, ideal):
    direct = station_hour_fact(bookings, ideal)
    merged = merge_models(cycle_totals(bookings), ideal, availability(bookings), quality(bookings))
    assert rows_of(direct, *direct.columns) == rows_of(merged, *direct.columns)
    got = rows_of(oee(direct), "station_number", "date_hour", "quality_percent", "oee_percent")
    assert got == expect(
        [
            ("1003", "10:00", "100.00", "16.46"),
            ("1008", "10:00", "100.00", "23.80"),
            ("1003", "11:00", "50.00", "46.67"),
            ("1008", "11:00", "100.00", "8.34"),
            ("1099", "11:00", "100.00", None),
            ("1008", "12:00", None, None),
        ]
    )
