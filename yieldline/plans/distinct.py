"""Distinct boards of any period from stored hours, without a look at the bookings.

Counts of distinct boards do not add up, sets of them do. Every board gets the next whole number when it is first seen, and each
load stores, per station and hour, which numbers it has booked, failed and passed: as bitmaps of 32,768 numbers each.
Boards are numbered in the order of their loads, so an hour's boards share few bitmaps. A shift, day or month is the union
of its hours' bitmaps, and its count is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldline.functions.conditional import count_where
from yieldline.functions.timing import bucket
from yieldline.operators.attempts import is_fail, is_pass
from yieldline.operators.merge import insert_missing, rows_already_in
from yieldline.session import new_folder
from yieldline.sources.commits import remove_folder
from yieldline.sources.layered import DAY, Log, Member
from yieldline.sources.tables import Warehouse

SETS = {"boards": None, "fail_boards": "fails", "pass_boards": "passes"}
HOUR_KEYS = ("station_number", "date_hour", "block")
NUMBERS = T.StructType([T.StructField("serial_number", T.StringType()), T.StructField("number", T.LongType())])
BITMAPS = T.StructType(
    [
        T.StructField("station_number", T.StringType()),
        T.StructField("date_hour", T.TimestampNTZType()),
        T.StructField("block", T.LongType()),
        *[T.StructField(name, T.BinaryType()) for name in SETS],
        T.StructField(DAY, T.DateType()),
    ]
)


def united(rows: DataFrame, *keys: str | Column) -> DataFrame:
    return rows.groupBy(*keys).agg(*[F.bitmap_or_agg(name).alias(name) for name in SETS])


@dataclass(frozen=True)
class DistinctBoards:
    """Board numbers and hourly bitmaps beside a warehouse's facts."""

    warehouse: Warehouse

    @property
    def _numbers(self) -> Log:
        members = {"numbers": Member(NUMBERS, lookup=("serial_number",))}
        return Log(self.warehouse.spark, self.warehouse.path("board_numbers"), members)

    @property
    def _hours(self) -> Log:
        fold = lambda rows: united(rows, *HOUR_KEYS, DAY).select(*BITMAPS.names)
        return Log(self.warehouse.spark, self.warehouse.path("board_bitmaps"), {"hours": Member(BITMAPS, by_day=True, fold=fold)})

    def add(self, bookings: DataFrame, stream: str | None = None, batch_id: int | None = None) -> None:
        """Take in a load. A load that is repeated, or lost between numbers and bitmaps, changes no count."""
        seen = bookings.groupBy("station_number", bucket("date_created").alias("date_hour"), "serial_number").agg(
            count_where(is_fail()).alias("fails"), count_where(is_pass()).alias("passes")
        )
        aside = new_folder(self.warehouse.spark, "seen")
        seen.where("serial_number IS NOT NULL").write.parquet(aside)
        seen = self.warehouse.spark.read.parquet(aside)
        self._number(seen)
        known = self._numbers.lookup("numbers", seen.select("serial_number"))
        numbered = seen.join(known, "serial_number")
        position = F.bitmap_bit_position("number")
        kinds = {name: position if of is None else F.when(F.col(of) > 0, position) for name, of in SETS.items()}
        hours = numbered.groupBy("station_number", "date_hour", F.bitmap_bucket_number("number").alias("block")).agg(
            *[F.bitmap_construct_agg(at).alias(name) for name, at in kinds.items()]
        )
        self._hours.append(hours.withColumn(DAY, F.to_date("date_hour")).select(*BITMAPS.names), stream, batch_id)
        remove_folder(self.warehouse.spark, aside)

    def _number(self, seen: DataFrame) -> None:
        """Give boards that have none the numbers after the last one: by their place in the written partitions."""
        spark = self.warehouse.spark
        boards = seen.select("serial_number").distinct()
        known = rows_already_in(boards, self._numbers.lookup("numbers", boards), ["serial_number"])
        fresh = insert_missing(boards, known, ["serial_number"])
        place = F.monotonically_increasing_id()
        aside = new_folder(spark, "numbers")
        fresh.select("serial_number", F.shiftright(place, 33).alias("part"), place.bitwiseAND((1 << 33) - 1).alias("at")).write.parquet(aside)
        placed = spark.read.parquet(aside)
        counts = {r.part: r.n for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect()}  # one for each task
        if counts:
            start, starts = sum(layer["rows"] for layer in self._numbers.layers()), []
            for part in sorted(counts):
                starts.append((part, start))
                start += counts[part]
            offsets = spark.createDataFrame(starts, "part BIGINT, start BIGINT")
            self._numbers.append(placed.join(offsets, "part").select("serial_number", (F.col("start") + F.col("at")).alias("number")))
        remove_folder(spark, aside)

    def hours(self) -> DataFrame:
        """station_number, date_hour, block and the three bitmaps; several rows of a key are to be united."""
        return self._hours.read().drop(DAY)

    def counts(self, *period: Column | str) -> DataFrame:
        """Distinct boards per `period`, columns of station_number and date_hour: booked, failed at least once, passed."""
        rows = self.hours().select(*period, "block", *SETS)
        keys = [c for c in rows.columns if c not in (*SETS, "block")]
        blocks = united(rows, *keys, "block")
        return blocks.groupBy(*keys).agg(*[F.sum(F.bitmap_count(name)).alias(name) for name in SETS])
