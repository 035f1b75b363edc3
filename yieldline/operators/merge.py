"""Upserts, keyed replacement and column alignment, written as anti joins and unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rows_already_in(rows: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of `rows` that `target` holds. `target` is only scanned when `rows` can be broadcast."""
    return target.select(*keys).join(rows.select(*keys).distinct(), keys, "left_semi")


def insert_missing(rows: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among `present`."""
    return rows.join(present.select(*keys), keys, "left_anti")


def keep_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the earliest by `order`. Aggregates map-side, so a key may repeat freely."""
    whole = F.struct(*rows.columns)
    first = rows.groupBy(*keys).agg(F.min_by(whole, F.struct(order, whole_order(rows, order))).alias("first"))
    return first.select("first.*")


def whole_order(rows: DataFrame, order: str):
    """A tie break that depends only on the row's content."""
    maps = {f.name for f in rows.schema if isinstance(f.dataType, T.MapType)}
    others = [F.to_json(c) if c in maps else F.col(c) for c in rows.columns if c != order]
    return F.xxhash64(*others)


def first_of_key(rows: DataFrame, keys: list[str], order: str | None) -> DataFrame:
    """One row per key: the first by `order`, or without one the first by all other columns, in their order."""
    others = [c for c in rows.columns if c not in keys]
    by = F.struct(order, *[c for c in others if c != order]) if order else F.struct(*(others or keys))
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), by).alias("first"))
    return first.select("first.*")


def upsert_keep_existing(target: DataFrame, rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Insert, do nothing on conflict. Of rows that repeat a key the first one counts (`first_of_key`)."""
    fresh = insert_missing(first_of_key(rows, keys, order), target, keys)
    return target.unionByName(fresh)


def upsert_overwrite(target: DataFrame, rows: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """Insert, take the new row on conflict. Of rows that repeat a key the first one counts (`first_of_key`)."""
    return merge_by_key(target, first_of_key(rows, keys, order), keys)


def merge_by_key(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Delete target rows whose key appears in `rows`, then insert `rows`.

    `keys` may be coarser than a row: all target rows of a matching key go.
    """
    return insert_missing(target, rows, keys).unionByName(rows)


def align_columns(target: DataFrame, schema: T.StructType) -> DataFrame:
    """`target` with exactly the columns of `schema`: new ones are NULL, removed ones are dropped."""
    return target.select(
        *[
            (F.col(f.name).cast(f.dataType) if f.name in target.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )
