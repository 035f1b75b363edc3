"""Per-booking window results that do not need a whole group in one task.

A plain window sends every booking of a group to one task. Here bookings are first aggregated, map-side, to one row per
group and timestamp, which is all that the results depend on. These rows are cut into short time slots: a first window
works inside (group, slot), a second one runs over one summary row per slot and carries the earlier slots' result
forward. Bookings take the result by an equi join on (group, timestamp). So no window gets raw bookings, however many
share a second. Group columns must not be NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldline.functions.timing import bucket


def _with_carry(points: DataFrame, group: list[str], slot: str, summary: Column, carried: Column) -> DataFrame:
    """Join to each point `carried`, a window over the per-slot `summary` (column `tail`)."""
    slotted = points.withColumn("slot", bucket("date_created", slot))
    tails = slotted.groupBy(*group, "slot").agg(summary.alias("tail")).withColumn("carried", carried).drop("tail")
    return slotted.join(tails, [*group, "slot"], "left")


def previous_booking(bookings: DataFrame, group: list[str], key: str = "booking_id", slot: str = "second") -> DataFrame:
    """Add `previous_created`: date_created of the booking before this one in its group.

    Of bookings with one timestamp the one with the least `key` comes first; the others follow it at once.
    """
    points = bookings.groupBy(*group, "date_created").agg(F.min(key).alias("first_key"))
    by_slot = Window.partitionBy(*group).orderBy("slot")
    rows = _with_carry(points, group, slot, F.max("date_created"), F.lag("tail").over(by_slot))
    inside = Window.partitionBy(*group, "slot").orderBy("date_created")
    before = F.coalesce(F.lag("date_created").over(inside), F.col("carried"))
    known = rows.select(*group, "date_created", "first_key", before.alias("before"))
    joined = bookings.join(known, [*group, "date_created"], "left")
    previous = F.when(F.col(key) == F.col("first_key"), F.col("before")).otherwise(F.col("date_created"))
    return joined.select(*bookings.columns, previous.alias("previous_created"))


def running_max(bookings: DataFrame, group: list[str], value: str, name: str, slot: str = "second") -> DataFrame:
    """Add the maximum of `value` over bookings up to and including this time (peers included)."""
    points = bookings.groupBy(*group, "date_created").agg(F.max(value).alias("most"))
    earlier = Window.partitionBy(*group).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    rows = _with_carry(points, group, slot, F.max("most"), F.max("tail").over(earlier))
    inside = (
        Window.partitionBy(*group, "slot").orderBy("date_created").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    most = F.greatest(F.max("most").over(inside), F.col("carried"))
    known = rows.select(*group, "date_created", most.alias(name))
    return bookings.join(known, [*group, "date_created"], "left").select(*bookings.columns, name)


def group_max(bookings: DataFrame, group: list[str], value: str, name: str) -> DataFrame:
    """Add the maximum of `value` over the whole group: one aggregate and one equi join."""
    most = bookings.groupBy(*group).agg(F.max(value).alias(name))
    return bookings.join(most, group, "left").select(*bookings.columns, name)
