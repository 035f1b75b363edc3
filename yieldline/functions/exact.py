"""Exact decimal quotients, rounded half away from zero exactly once.

A decimal division in Spark first rounds to its result scale, so `round(a / b, 2)` rounds twice.
These helpers divide integers instead: round(n/d, s) is (2*10^s*n + d) div (2*d), over 10^s.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WIDE = "decimal(38,0)"


def null_if_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def hundredths(value: Column) -> Column:
    """A scale-2 decimal as a whole number of hundredths."""
    return (value * 100).cast(WIDE)


def rounded_quotient(numerator: Column, denominator: Column, scale: int, precision: int) -> Column:
    """round(numerator / denominator, scale) for whole numbers; NULL when the denominator is 0."""
    n, d = numerator.cast(WIDE), null_if_zero(denominator.cast(WIDE))
    steps = F.call_function("div", F.abs(n) * (2 * 10**scale) + F.abs(d), F.abs(d) * 2)
    signed = F.when((n < 0) != (d < 0), -steps).otherwise(steps)
    unit = F.lit("0." + "0" * (scale - 1) + "1").cast(f"decimal({scale + 1},{scale})")
    return (signed.cast("decimal(19,0)") * unit).cast(f"decimal({precision},{scale})")


def mean(total: Column, count: Column) -> Column:
    """Average of a scale-2 decimal, to 2 decimals."""
    return rounded_quotient(hundredths(total), count.cast(WIDE) * 100, 2, 12)


def percent(part: Column, whole: Column, precision: int = 18) -> Column:
    """100 * part / whole to 2 decimals, for counts."""
    return rounded_quotient(part.cast(WIDE) * 100, whole, 2, precision)
