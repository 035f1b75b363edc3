"""Wall-clock time helpers for TIMESTAMP_NTZ columns.

Bookings carry local wall-clock time without a zone. `date_trunc`, `timestampdiff` and
`timestampadd` first turn such a value into an instant of the session zone, which moves times that
fall into a clock change. Everything here stays in NTZ and gives the same answer in any zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GRAIN_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
MICROS = 1_000_000


def epoch() -> Column:
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def bucket(ts: Column | str, grain: str = "hour") -> Column:
    """Start of the hour, day, minute or second that `ts` falls into."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    day = F.to_date(ts).cast("timestamp_ntz")
    if grain == "day":
        return day
    parts = [F.lit(0), F.hour(ts)]
    if grain in ("minute", "second"):
        parts.append(F.minute(ts))
    if grain == "second":
        parts.append(F.second(ts))
    if grain not in GRAIN_SECONDS:
        raise ValueError(f"unknown grain {grain!r}")
    return day + F.make_dt_interval(*parts)


def elapsed(start: Column, end: Column) -> Column:
    """Seconds between two NTZ values, exact to the microsecond."""
    return (end - start).cast("interval second").cast("decimal(18,6)")


def elapsed_micros(start: Column, end: Column) -> Column:
    return (elapsed(start, end) * MICROS).cast("bigint")


def duration(seconds: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds).cast("decimal(18,6)"))


def to_instant(ts: Column) -> Column:
    """NTZ read as UTC: watermarks accept only TIMESTAMP."""
    return F.timestamp_micros(elapsed_micros(epoch(), ts))


def from_instant(instant: Column) -> Column:
    """Inverse of `to_instant`."""
    return from_epoch_micros(F.unix_micros(instant))


def from_epoch_micros(micros: Column) -> Column:
    seconds = (micros.cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(7,6)")).cast("decimal(18,6)")
    return epoch() + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def from_epoch_millis(millis: Column) -> Column:
    """NULL outside the years 1 to 9999, so no number can overflow."""
    fits = millis.between(-62_135_596_800_000, 253_402_300_799_999)
    return from_epoch_micros(F.when(fits, millis) * 1000)
