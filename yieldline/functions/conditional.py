"""Aggregates that look only at rows meeting a condition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_where(condition: Column, value: Column | None = None) -> Column:
    """Rows that meet `condition` (and have a `value`); 0 when there is none."""
    return F.count(F.when(condition, F.lit(1) if value is None else value))


def sum_where(condition: Column, value: Column) -> Column:
    """Sum over rows that meet `condition`; NULL, not 0, when there is none."""
    return F.sum(F.when(condition, value))


def max_where(condition: Column, value: Column) -> Column:
    return F.max(F.when(condition, value))


def min_where(condition: Column, value: Column) -> Column:
    return F.min(F.when(condition, value))
