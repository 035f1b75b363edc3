"""Tables under one root: the booking facts with what is looked up in them, the reference tables and the KPI tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldline import schemas
from yieldline.operators.attempts import attempts_per_bucket
from yieldline.operators.checks import demand
from yieldline.operators.merge import (
    insert_missing,
    keep_first,
    rows_already_in,
    upsert_keep_existing,
    upsert_overwrite,
)
from yieldline.sources.commits import files_of, remove_folder, subfolders  # noqa: F401
from yieldline.sources.layered import DAY, DayTable, Log, Member

FACT_SCHEMA = T.StructType([*schemas.STATION_RECORDS.fields, T.StructField(DAY, T.DateType())])
WIDE_FACT_SCHEMA = T.StructType([*schemas.STATION_RECORDS.fields, schemas.EXTRAS, T.StructField(DAY, T.DateType())])
BOARD_KEYS = ["station_number", "serial_number", "part_number", "date_hour"]
BOARD_SUMS = ("total_bookings", "fail_bookings", "pass_bookings")
BOARD_MOST = ("top_attempt", "top_fail", "top_pass", "last_test_time")
BOARD_SCHEMA = T.StructType(
    [
        *[T.StructField(c, T.StringType()) for c in BOARD_KEYS[:3]],
        T.StructField("date_hour", T.TimestampNTZType()),
        *[T.StructField(c, T.LongType()) for c in BOARD_SUMS],
        *[T.StructField(c, T.IntegerType()) for c in ("top_attempt", "top_fail", "top_pass", "low_attempt")],
        T.StructField("last_test_time", T.TimestampNTZType()),
        T.StructField(DAY, T.DateType()),
    ]
)
BOARD_DAY_SCHEMA = T.StructType([T.StructField("serial_number", T.StringType()), T.StructField(DAY, T.DateType())])
ID_SCHEMA = T.StructType([T.StructField("booking_id", T.StringType())])


def boards_of(bookings: DataFrame) -> DataFrame:
    """Bookings summed up per board, station, part and hour."""
    low, last = F.min("test_count").alias("low_attempt"), F.max("date_created").alias("last_test_time")
    return with_day(attempts_per_bucket(bookings, "hour", low, last), "date_hour").select(*BOARD_SCHEMA.names)


def merged_boards(rows: DataFrame) -> DataFrame:
    sums, most = [F.sum(c).alias(c) for c in BOARD_SUMS], [F.max(c).alias(c) for c in BOARD_MOST]
    merged = rows.groupBy(*BOARD_KEYS, DAY).agg(*sums, *most, F.min("low_attempt").alias("low_attempt"))
    return merged.select(*BOARD_SCHEMA.names)


def days_by_board(bookings: DataFrame) -> DataFrame:
    return bookings.select("serial_number", DAY).distinct()


# The facts, and what each load adds to: their boards by day, the days of each board, and the ids.
FACT_MEMBERS = {
    "station_records": Member(WIDE_FACT_SCHEMA, by_day=True, sort=("station_number", "date_created")),
    "boards": Member(BOARD_SCHEMA, by_day=True, sort=("serial_number",), derive=boards_of, fold=merged_boards),
    "board_days": Member(BOARD_DAY_SCHEMA, lookup=("serial_number",), derive=days_by_board, fold=days_by_board),
    "ids": Member(ID_SCHEMA, lookup=("booking_id",), derive=lambda bookings: bookings.select("booking_id")),
}


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a finished write left its success marker at `path`."""
    files, jvm_path = files_of(spark, f"{path}/_SUCCESS")
    return files.exists(jvm_path)


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """Write an empty table if there is none; leave an existing one alone."""
    try:
        spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = spark.createDataFrame([], schema)
        empty.write.partitionBy(*partition_by).mode("append").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def with_day(rows: DataFrame, ts: str) -> DataFrame:
    return rows.withColumn(DAY, F.to_date(ts))


def distinct_days(rows: DataFrame, day: str = DAY) -> list[dt.date]:
    """The days present, as literals for partition pruning: at most one per calendar day."""
    return sorted(r[0] for r in rows.select(F.col(day).cast("date")).distinct().collect() if r[0])


@dataclass(frozen=True)
class Warehouse:
    """Paths and reads/writes of one line's tables."""

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def create(self) -> "Warehouse":
        """Load the two reference tables; the others come into being with their first rows.

        A station already there is kept as it is; an ideal cycle time is brought up to date.
        """
        if subfolders(self.spark, self.path("station_records")):
            raise ValueError(f"{self.root} has bookings in an earlier layout; append them to a new warehouse")
        self._load("stations", schemas.STATIONS, schemas.stations(self.spark), upsert_keep_existing)
        ideal = schemas.ideal_cycle_times(self.spark)
        self._load("ideal_cycle_times", schemas.IDEAL_CYCLE_TIMES, ideal, upsert_overwrite)
        return self

    def _load(self, name: str, schema: T.StructType, rows: DataFrame, upsert: Callable) -> None:
        stored = self._stored(name)
        if not stored.exists():
            self.replace_reference(name, rows)
            return
        present = stored.read(schema)
        merged = upsert(present, rows, [schemas.PRIMARY_KEYS[name]])
        if not merged.exceptAll(present).isEmpty():
            self.replace_reference(name, merged)

    def replace_reference(self, name: str, rows: DataFrame) -> None:
        """Put checked rows in the place of a reference table."""
        demand(rows, name)
        self._stored(name).replace(rows.coalesce(1))

    def ideal_cycle_times(self) -> DataFrame:
        return self._stored("ideal_cycle_times").read(schemas.IDEAL_CYCLE_TIMES)

    def stations(self) -> DataFrame:
        return self._stored("stations").read(schemas.STATIONS)

    def _stored(self, name: str) -> DayTable:
        return DayTable(self.spark, self.path(name))

    # facts -------------------------------------------------------------------------------------

    @property
    def log(self) -> Log:
        """Bookings, boards, days of boards and ids; a load is in all of them or in none."""
        return Log(self.spark, self.path("facts"), FACT_MEMBERS)

    def facts(self, days: list[dt.date] | None = None) -> DataFrame:
        """Bookings; `days` prunes whole partitions before anything is read."""
        facts = self.log.read("station_records").select(*FACT_SCHEMA.names)
        return facts if days is None else facts.where(F.col(DAY).isin(days))

    def wide_facts(self) -> DataFrame:
        """Bookings with `extras`, the map of all fields that messages brought beyond the declared ones."""
        return self.log.read("station_records")

    def facts_with_added_columns(self, names: list[str]) -> DataFrame:
        """Bookings with some of the added fields as text columns; rows without a field have NULL there.

        A field is found by its exact name, whatever characters it has and however else it is spelt.
        """
        return self.wide_facts().select(
            *schemas.STATION_RECORDS.names, DAY, *[F.try_element_at("extras", F.lit(n)).alias(n) for n in names]
        )

    def added_fields(self) -> DataFrame:
        """Names of added fields and how many bookings have each, as rows."""
        names = self.wide_facts().select(F.explode(F.map_keys("extras")).alias("name"))
        return names.groupBy("name").agg(F.count("*").alias("bookings"))

    def stored_ids(self, bookings: DataFrame) -> DataFrame:
        """Ids of `bookings` that the facts already hold, however long ago they were stored.

        Ids lie in buckets; only the buckets of the incoming ids are read. They are probed with the incoming ids, so what is
        stored is not shuffled as long as these fit under the broadcast threshold.
        """
        known = self.log.lookup("ids", bookings.select("booking_id"))
        return rows_already_in(bookings, known, ["booking_id"])

    def append_facts(self, bookings: DataFrame, skip_present: bool = True, load: tuple[str, int] | None = None) -> None:
        """Append bookings, keeping the earliest row of a booking_id and any row already stored.

        Without `skip_present` the caller vouches for ids that are new and occur once. `load` is the stream and batch id
        of a load that may be repeated: it is stored once.
        """
        if load is not None and self.log.has(*load):
            return
        if skip_present:
            first = keep_first(bookings, ["booking_id"], "date_created")
            bookings = insert_missing(first, self.stored_ids(bookings), ["booking_id"])
        if "extras" not in bookings.columns:
            bookings = bookings.withColumn("extras", F.lit(None).cast(schemas.EXTRAS.dataType))
        self.log.append(with_day(bookings, "date_created").select(*WIDE_FACT_SCHEMA.names), *(load or ()))

    # boards ------------------------------------------------------------------------------------

    def boards(self, days: list[dt.date]) -> DataFrame:
        """Per station, board, part and hour of some days: counts, attempts and last time, over all loads."""
        return merged_boards(self._board_rows(days)).drop(DAY)

    def board_parts(self, days: list[dt.date]) -> DataFrame:
        """Rows of `boards` as the loads wrote them, one or more for each: for keys, sums and extremes, which need no merge before."""
        return self._board_rows(days).drop(DAY)

    def _board_rows(self, days: list[dt.date]) -> DataFrame:
        return self.log.read("boards").where(F.col(DAY).isin(days))

    def days_of_boards(self, rows: DataFrame) -> list[dt.date]:
        """All days in which the boards of `rows` have a booking. Only the boards' buckets of the index are read."""
        return distinct_days(rows_already_in_days(self.log.lookup("board_days", rows.select("serial_number")), rows))

    # KPI tables --------------------------------------------------------------------------------

    def has_table(self, name: str) -> bool:
        return self._stored(name).exists()

    def replace_table(self, name: str, rows: DataFrame, as_of: int = 0) -> DataFrame:
        """Full refresh: write the whole table to a folder of its own, then commit that folder as the table.

        A refresh that is lost on the way leaves the old table. Column comments of `rows` are stored. `as_of` is the number of
        the facts' commit that `rows` come from: a table from newer facts is not replaced.
        """
        self._stored(name).replace(rows, as_of, self._sort_keys(rows), "date_hour")
        return self.table(name, rows.schema)

    def replace_days(self, name: str, rows: DataFrame, days: list[dt.date], as_of: int = 0) -> DataFrame:
        """Overwrite exactly `days`, including days that no longer have any row, in one commit."""
        self._stored(name).replace_days(rows, days, as_of, self._sort_keys(rows))
        return self.table(name, rows.schema)

    @staticmethod
    def _sort_keys(rows: DataFrame) -> list[str]:
        return [c for c in ("date_hour", "station_number", "part_number") if c in rows.columns]

    def table(self, name: str, schema: T.StructType | str, days: list[dt.date] | None = None) -> DataFrame:
        """A stored table with the columns a model has now, whichever columns its days were written with: added ones are
        NULL, dropped ones are gone, changed types are cast."""
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        return self._stored(name).read(schema, days)

    def synced(self, name: str, schema: T.StructType | str) -> DataFrame:
        return self.table(name, schema)

    def notes(self, name: str) -> dict[str, str]:
        """Column comments as the stored table has them."""
        return {f.name: f.metadata["comment"] for f in self._stored(name).stored_schema() if "comment" in f.metadata}


def rows_already_in_days(board_days: DataFrame, rows: DataFrame) -> DataFrame:
    return board_days.join(rows.select("serial_number").distinct(), "serial_number", "left_semi")
