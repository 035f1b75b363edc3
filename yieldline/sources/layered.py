"""Two kinds of tables out of committed folders: tables replaced by day, and logs that are folded as they grow."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldline.operators.merge import align_columns
from yieldline.session import at_once
from yieldline.sources.commits import CommitLog, remove_folder, retired, subfolders, swept

DAY = "event_day"
# So many layers of a size are merged to one of the next size, so a reader meets at most FOLD of each.
FOLD = 16
# Rows of a lookup bucket at most, on average.
BUCKET_ROWS = 1 << 20


class StaleRefresh(RuntimeError):
    """A table was computed from older facts than the table that it would replace."""


def write_layer(writer: DataFrameWriter, folder: str) -> None:
    """Every layer is written by this: a folder that no commit names may be a lost job's, and is written over."""
    writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(folder)


def by_key(rows: DataFrame, key: str) -> DataFrame:
    """Gather each value of `key` for writing. AQE splits one that is too big and joins small ones."""
    return rows.hint("rebalance", F.col(key))


def folder_of(path: str, version: str) -> str:
    return f"{path}/version={version}"


def read_versions(spark: SparkSession, path: str, versions: list[str], schema: T.StructType) -> DataFrame:
    """Rows of some versions with their `version`; `schema` names the stored columns and other folder levels."""
    stored = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
    if not versions:
        return spark.createDataFrame([], stored)
    return spark.read.schema(stored).option("basePath", path).parquet(*[folder_of(path, v) for v in versions])


@dataclass(frozen=True)
class DayTable:
    """A table that is replaced as a whole or by day. A layer has some days; each day lives in one layer.

    The commit notes each layer's own columns, so a table may hold days that were written before its model changed.
    """

    spark: SparkSession
    path: str

    @property
    def commits(self) -> CommitLog:
        return CommitLog(self.spark, self.path)

    def layers(self) -> list[dict]:
        return self.commits.latest()[1].get("layers", [])

    def exists(self) -> bool:
        return bool(self.commits.numbers())

    def as_of(self) -> int:
        """Number of the facts' commit that the newest layer was computed from."""
        return self.commits.latest()[1].get("as_of", 0)

    def replace(self, rows: DataFrame, as_of: int = 0, keys: list[str] = (), day_of: str | None = None) -> None:
        """Put `rows` in the place of the whole table. With `day_of` they are partitioned by the day of that column."""
        layer = self._write(rows, list(keys), day_of)

        def change(state: dict) -> dict:
            self._demand_newer(state, as_of)
            gone = [folder_of(self.path, x["version"]) for x in state.get("layers", [])]
            return swept(self.spark, {"layers": [layer], "as_of": max(as_of, state.get("as_of", 0)), "retired": retired(state, gone)})

        self._commit(change, layer)

    def replace_days(self, rows: DataFrame, days: list[dt.date], as_of: int = 0, keys: list[str] = (), day_of: str = "date_hour") -> None:
        """Put `rows` in the place of exactly `days`, including days that no longer have any row."""
        layer = self._write(rows, list(keys), day_of)
        replaced = {d.isoformat() for d in days}

        def change(state: dict) -> dict:
            self._demand_newer(state, as_of)
            left = [x | {"days": [d for d in x["days"] if d not in replaced]} for x in state.get("layers", [])] + [layer]
            gone = [folder_of(self.path, x["version"]) for x in left if not x["days"]]
            kept = [x for x in left if x["days"]]
            return swept(self.spark, {"layers": kept, "as_of": max(as_of, state.get("as_of", 0)), "retired": retired(state, gone)})

        self._commit(change, layer)
        self._fold(list(keys), day_of)

    def _demand_newer(self, state: dict, as_of: int) -> None:
        if state.get("as_of", 0) > as_of > 0:
            raise StaleRefresh(f"{self.path} was refreshed from newer facts meanwhile")

    def _commit(self, change: Callable[[dict], dict], layer: dict) -> None:
        try:
            self.commits.commit(change)
        except StaleRefresh:
            remove_folder(self.spark, folder_of(self.path, layer["version"]))
            raise

    def _write(self, rows: DataFrame, keys: list[str], day_of: str | None) -> dict:
        version = uuid.uuid4().hex
        folder = folder_of(self.path, version)
        if day_of is None:
            write_layer(rows.write, folder)
            days = [""]
        else:
            dated = by_key(rows.withColumn(DAY, F.to_date(day_of)), DAY).sortWithinPartitions(DAY, *keys)
            write_layer(dated.write.partitionBy(DAY), folder)
            days = [d.removeprefix(f"{DAY}=") for d in subfolders(self.spark, folder) if d.startswith(f"{DAY}=")]
        return {"version": version, "days": days, "schema": rows.schema.jsonValue()}

    def _fold(self, keys: list[str], day_of: str) -> None:
        """Merge the layers behind the first one once there are too many; they are what incremental refreshes wrote."""
        layers = self.layers()
        if len(layers) <= FOLD:
            return
        newest = T.StructType.fromJson(layers[-1]["schema"])
        some = layers[1:]
        merged = self._write(self._aligned(some, newest), keys, day_of)

        def change(state: dict) -> dict | None:
            if [x for x in state["layers"] if x in some] != some:
                return None  # a day of them was replaced meanwhile; the next refresh folds
            kept = [x for x in state["layers"] if x not in some]
            gone = [folder_of(self.path, x["version"]) for x in some]
            return swept(self.spark, state | {"layers": [kept[0], merged, *kept[1:]], "retired": retired(state, gone)})

        if merged not in self.commits.commit(change)["layers"]:
            remove_folder(self.spark, folder_of(self.path, merged["version"]))

    def read(self, schema: T.StructType, days: list[dt.date] | None = None) -> DataFrame:
        """The table with the columns of `schema`: columns that a layer lacks are NULL, others are gone, changed types are cast."""
        wanted = None if days is None else {d.isoformat() for d in days}
        layers = [x if wanted is None else x | {"days": [d for d in x["days"] if d in wanted]} for x in self.layers()]
        return self._aligned([x for x in layers if x["days"]], schema)

    def _aligned(self, layers: list[dict], schema: T.StructType) -> DataFrame:
        """Layers of the same columns are one scan, pruned to the days that live in each."""
        if not layers:
            return self.spark.createDataFrame([], schema)
        alike: dict[str, list[dict]] = {}
        for layer in layers:
            stored = T.StructType.fromJson(layer["schema"])
            alike.setdefault(stored.json(), []).append(layer)
        parts = []
        for group in alike.values():
            stored = T.StructType.fromJson(group[0]["schema"])
            dated = group[0]["days"] != [""]
            folders = T.StructType([*stored.fields, *([T.StructField(DAY, T.DateType())] if dated else [])])
            rows = read_versions(self.spark, self.path, [x["version"] for x in group], folders)
            if dated:
                rows = rows.where(reduce(lambda a, b: a | b, [self._alive(x) for x in group]))
            parts.append(align_columns(rows, schema))
        return reduce(DataFrame.unionAll, parts)

    @staticmethod
    def _alive(layer: dict) -> Column:
        known = [dt.date.fromisoformat(d) for d in layer["days"] if d[:1].isdigit()]
        inside = F.col(DAY).isin(known) if known else F.lit(False)
        if len(known) < len(layer["days"]):
            inside = inside | F.col(DAY).isNull()
        return (F.col("version") == layer["version"]) & inside

    def stored_schema(self) -> T.StructType:
        """Columns of the newest layer, with their notes."""
        return T.StructType.fromJson(self.layers()[-1]["schema"])


def buckets_for(rows: int) -> int:
    """A power of two, so that a row's bucket among fewer ones is the remainder of its bucket among more."""
    return 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length()


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Member:
    """One of the tables that a log's loads write. The first one gets the load's rows, the others what they `derive` from these.

    `lookup` members are dealt to buckets by these keys and sorted by them; others may be partitioned by day. `fold` merges the
    rows of several loads.
    """

    schema: T.StructType
    by_day: bool = False
    lookup: tuple[str, ...] = ()
    sort: tuple[str, ...] = ()
    derive: Callable[[DataFrame], DataFrame] | None = None
    fold: Callable[[DataFrame], DataFrame] = lambda rows: rows


@dataclass(frozen=True)
class Log:
    """Rows that come load by load, in one or more tables that are committed together.

    A load of a stream is known by its stream and batch id: storing it again changes nothing. Layers of loads are merged
    as they become many, beside running writers: a merge commits only if its layers are still there.
    """

    spark: SparkSession
    path: str
    members: dict[str, Member] = field(default_factory=dict)

    @property
    def commits(self) -> CommitLog:
        return CommitLog(self.spark, self.path)

    def member_path(self, member: str) -> str:
        return f"{self.path}/{member}"

    def number(self) -> int:
        """How many commits there have been."""
        return self.commits.latest()[0]

    def layers(self) -> list[dict]:
        return self.commits.latest()[1].get("layers", [])

    def marks(self) -> dict[str, int]:
        """Newest batch id of each stream that is stored."""
        return self.commits.latest()[1].get("marks", {})

    def has(self, stream: str, batch_id: int) -> bool:
        return self.marks().get(stream, -1) >= batch_id

    def append(self, rows: DataFrame, stream: str | None = None, batch_id: int | None = None) -> bool:
        """Store a load, all its tables or none. False if it was stored before."""
        if stream is not None and self.has(stream, batch_id):
            return False
        layer = self._write(rows)

        def change(state: dict) -> dict | None:
            marks = state.get("marks", {})
            if stream is not None:
                if marks.get(stream, -1) >= batch_id:
                    return None
                marks = marks | {stream: batch_id}
            return swept(self.spark, state | {"layers": [*state.get("layers", []), layer], "marks": marks})

        if layer not in self.commits.commit(change).get("layers", []):
            self._discard(layer)
            return False
        self.fold()
        return True

    def _folders(self, layer: dict) -> list[str]:
        return [folder_of(self.member_path(m), layer["version"]) for m in self.members]

    def _discard(self, layer: dict) -> None:
        for folder in self._folders(layer):
            remove_folder(self.spark, folder)

    def _write(self, rows: DataFrame) -> dict:
        """Write a load's rows once; what the other members derive is read from there."""
        layer = {"version": uuid.uuid4().hex, "tier": 0, "rows": 0, "buckets": 1}
        first, *others = self.members
        self._put(first, rows, layer)
        kept = self._read(first, [layer])
        layer["rows"] = kept.count()
        layer["buckets"] = buckets_for(layer["rows"])
        at_once(self.spark, [lambda m=m: self._put(m, self.members[m].derive(kept), layer) for m in others])
        return layer

    def _put(self, name: str, rows: DataFrame, layer: dict) -> None:
        member, folder = self.members[name], folder_of(self.member_path(name), layer["version"])
        partition = []
        if member.lookup:
            partition = ["bucket"]
            rows = rows.withColumn("bucket", bucket_of(list(member.lookup), layer["buckets"]))
        elif member.by_day:
            partition = [DAY]
        rows = rows.hint("rebalance", *[F.col(c) for c in partition])
        sort = [*partition, *member.lookup, *member.sort]
        write_layer((rows.sortWithinPartitions(*sort) if sort else rows).write.partitionBy(*partition), folder)

    def fold(self) -> None:
        """Merge FOLD layers of one tier to one of the next, while there are so many."""
        while True:
            layers = self.layers()
            tiers = [x["tier"] for x in layers]
            full = sorted({t for t in tiers if tiers.count(t) >= FOLD})
            if not full:
                return
            some = [x for x in layers if x["tier"] == full[0]]
            rows = sum(x["rows"] for x in some)
            merged = {"version": uuid.uuid4().hex, "tier": full[0] + 1, "rows": rows, "buckets": buckets_for(rows)}
            at_once(self.spark, [lambda m=m: self._put(m, self.members[m].fold(self._read(m, some)), merged) for m in self.members])

            def change(state: dict, some=some, merged=merged) -> dict | None:
                if not all(x in state["layers"] for x in some):
                    return None
                kept = [x for x in state["layers"] if x not in some]
                gone = [f for x in some for f in self._folders(x)]
                return swept(self.spark, state | {"layers": [merged, *kept], "retired": retired(state, gone)})

            if merged not in self.commits.commit(change)["layers"]:
                self._discard(merged)
                return

    def _read(self, member: str, layers: list[dict]) -> DataFrame:
        spec = self.members[member]
        names = [c for c in spec.schema.names if c != DAY or not spec.by_day]
        levels = [T.StructField(DAY, T.DateType())] if spec.by_day else []
        schema = T.StructType([*[spec.schema[c] for c in names], *levels])
        return read_versions(self.spark, self.member_path(member), [x["version"] for x in layers], schema).select(*spec.schema.names)

    def read(self, member: str | None = None) -> DataFrame:
        """Rows of all loads; loads that were not committed are not seen."""
        return self._read(member or next(iter(self.members)), self.layers())

    def lookup(self, member: str, keys: DataFrame) -> DataFrame:
        """Stored rows of a lookup member that may have one of `keys`, for a semi join: only the keys' buckets are read.

        `keys` has the member's lookup columns. Bucket numbers reach the driver, at most as many as there are buckets.
        """
        spec, layers = self.members[member], self.layers()
        if not layers:
            return self.spark.createDataFrame([], spec.schema)
        most = max(x["buckets"] for x in layers)
        asked = [0]
        if most > 1:
            asked = [r[0] for r in keys.select(bucket_of(list(spec.lookup), most)).distinct().collect()]
        schema = T.StructType([*spec.schema.fields, T.StructField("bucket", T.IntegerType())])
        parts = []
        for buckets in sorted({x["buckets"] for x in layers}):
            some = [x["version"] for x in layers if x["buckets"] == buckets]
            rows = read_versions(self.spark, self.member_path(member), some, schema)
            parts.append(rows.where(F.col("bucket").isin(sorted({a % buckets for a in asked}))).select(*spec.schema.names))
        return reduce(DataFrame.unionAll, parts)
