"""One board at one station holds a third of all bookings: no task gets a third of the rows."""

import pytest
from pyspark.sql import functions as F

from yieldline.operators import attempts, windows
from yieldline.sources.events import read_bookings


@pytest.fixture(scope="module")
def skewed(spark, folder):
    hot = F.col("book_state") == "FAIL"
    return read_bookings(spark, folder).withColumns(
        {
            "station_number": F.when(hot, "1008").otherwise(F.col("station_number")),
            "serial_number": F.when(hot, "HOT").otherwise(F.col("serial_number")),
            "date_created": F.when(hot, F.expr("timestamp_ntz'2024-01-01 10:00:00'")).otherwise(F.col("date_created")),
        }
    )


@pytest.mark.parametrize(
    "reduced, limit",
    [
        (lambda b: attempts.attempts_per_bucket(b), 4),  # one row per part
        (lambda b: attempts.running_latest(b), 1),
        (lambda b: attempts.board_history(b, "part_number"), 4),
    ],
    ids=["quality", "legacy", "first_pass"],
)
def test_hot_board_shrinks_before_it_is_gathered(skewed, reduced, limit):
    raw = skewed.where("serial_number = 'HOT'").count()
    left = reduced(skewed).where("serial_number = 'HOT'").count()
    assert raw > 100 and left <= limit


@pytest.mark.parametrize("run", [windows.previous_booking, lambda b, g: windows.running_max(b, g, "test_count", "most")], ids=["lag", "max"])
def test_windows_get_aggregated_rows_only(skewed, run):
    """A third of all bookings share one second. Below every window and its shuffle there is an aggregate."""
    frame = run(skewed, ["station_number"])
    text = frame._jdf.queryExecution().sparkPlan().toString()
    lines = text.splitlines()
    for i, line in enumerate(lines):
        if "Window" in line:
            below = next(x for x in lines[i + 1 :] if "Aggregate" in x or "Scan" in x)
            assert "Aggregate" in below
    assert frame.count() == skewed.count()


def test_previous_booking_with_ties(make_bookings):
    def booking(i, at):
        return (f"b{i}", "S1", "1003", "PASS", f"2025-10-25T{at}", "P1", "4.00", i)

    rows = make_bookings([booking(3, "10:00:00"), booking(1, "10:00:00"), booking(2, "10:00:00.5"), booking(5, "10:00:07"), booking(4, "10:00:07")])
    found = {r.booking_id: str(r.previous_created)[11:] for r in windows.previous_booking(rows, ["station_number"]).collect()}
    assert found == {"b1": "", "b3": "10:00:00", "b2": "10:00:00", "b4": "10:00:00.500000", "b5": "10:00:07"}
    most = {r.booking_id: r.most for r in windows.running_max(rows, ["station_number"], "test_count", "most").collect()}
    assert most == {"b1": 3, "b3": 3, "b2": 3, "b4": 5, "b5": 5}
