"""Exact rounding and zone-free time helpers."""

import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from yieldline.functions import exact, timing


def half_up(n, d, scale):
    if n is None or d in (None, 0):
        return None
    with localcontext() as context:
        context.prec = 80
        return (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


def test_rounded_quotient_matches_decimal_arithmetic(spark):
    rng = random.Random(7)
    pairs = [(1, 8), (5, 1000), (-5, 1000), (5, -1000), (0, 3), (7, 0), (None, 3), (3, None)]
    pairs += [(4019999, 4_000_000), (10**17, 3), (1, 2 * 10**17)]
    pairs += [(rng.randint(-(10**12), 10**12), rng.randint(1, 10**6)) for _ in range(500)]
    pairs += [(200 * k + 1, 400) for k in range(-20, 20)]
    frame = spark.createDataFrame(pairs, "n long, d long")
    out = frame.select(
        "n",
        "d",
        exact.rounded_quotient(F.col("n"), F.col("d"), 2, 20).alias("two"),
        exact.rounded_quotient(F.col("n"), F.col("d"), 4, 24).alias("four"),
    ).where("n is null or abs(n) < 1e16")
    for row in out.collect():
        assert row.two == half_up(row.n, row.d, 2), row
        assert row.four == half_up(row.n, row.d, 4), row


def test_mean_rounds_once(spark):
    """The plain average rounds to six decimals first and then gives 1.01."""
    totals = spark.sql("SELECT CAST(1999999 * 1.01BD + 2000001 * 1.00BD AS DECIMAL(20,2)) AS total, 4000000L AS n")
    assert totals.select(exact.mean(F.col("total"), F.col("n"))).first()[0] == Decimal("1.00")


def test_percent_of_nothing_is_null(spark):
    row = spark.range(1).select(exact.percent(F.lit(3), F.lit(0)), exact.percent(F.lit(1), F.lit(3))).first()
    assert tuple(row) == (None, Decimal("33.33"))


@pytest.fixture(params=["UTC", "Europe/Berlin", "America/New_York"])
def zone(spark, request):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", before)


def wall(text):
    return F.expr(f"timestamp_ntz'{text}'")


def test_buckets_do_not_depend_on_the_zone(spark, zone):
    """02:30 does not exist in Berlin that night, but the wall clock says so."""
    ts = wall("2025-03-30 02:30:15.123456")
    row = spark.range(1).select(
        *[timing.bucket(ts, g).cast("string") for g in ("second", "minute", "hour", "day")],
        timing.elapsed(wall("2025-03-30 01:59:59.999999"), wall("2025-03-30 03:00:00")),
        timing.from_instant(timing.to_instant(ts)).cast("string"),
        F.unix_micros(timing.to_instant(ts)),
        timing.from_epoch_millis(F.lit(1743301815123)).cast("string"),
        timing.bucket(wall("1969-12-31 23:59:59.5")).cast("string"),
    ).first()
    instant = dt.datetime(2025, 3, 30, 2, 30, 15, 123456, tzinfo=dt.timezone.utc)
    assert tuple(row) == (
        "2025-03-30 02:30:15",
        "2025-03-30 02:30:00",
        "2025-03-30 02:00:00",
        "2025-03-30 00:00:00",
        Decimal("3600.000001"),
        "2025-03-30 02:30:15.123456",
        int(instant.timestamp()) * 1_000_000 + 123456,
        "2025-03-30 02:30:15.123",
        "1969-12-31 23:00:00",
    )


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        timing.bucket("date_created", "week")
