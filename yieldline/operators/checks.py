"""Constraint checks that report violations as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldline import schemas


def duplicate_keys(rows: DataFrame, key: str) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return rows.groupBy(key).agg(F.count("*").alias("occurrences")).where(F.col("occurrences") > 1)


def uniqueness(rows: DataFrame, table: str, key: str) -> DataFrame:
    """One row: how many key values repeat and how many rows are surplus."""
    return duplicate_keys(rows, key).agg(
        F.lit(table).alias("table_name"),
        F.lit(key).alias("key_column"),
        F.count("*").alias("repeated_keys"),
        F.coalesce(F.sum(F.col("occurrences") - 1), F.lit(0)).cast("bigint").alias("surplus_rows"),
    )


def null_counts(rows: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One row per column with its number of NULLs, from a single pass over the table."""
    counted = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counted.select(F.lit(table).alias("table_name"), F.inline(pairs))


def too_long(column: Column, limit: int) -> Column:
    """Text beyond its declared length; surplus trailing blanks do not count."""
    return F.length(F.rtrim(column)) > limit


def fitted(column: Column, limit: int) -> Column:
    """Text with surplus trailing blanks cut off."""
    return F.when(F.length(column) > limit, F.substring(column, 1, limit)).otherwise(column)


def length_violations(rows: DataFrame, table: str, limits: dict[str, int]) -> DataFrame:
    """One row per limited column with the number of values that do not fit."""
    counted = rows.agg(*[F.count_if(too_long(F.col(c), n)).alias(c) for c, n in limits.items()])
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.lit(n).alias("max_length"), F.col(c).alias("too_long"))
            for c, n in limits.items()
        ]
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(pairs))


def table_report(rows: DataFrame, table: str) -> DataFrame:
    """All declared constraints of a table: rule, column, and how many rows break it."""
    key = uniqueness(rows, table, schemas.PRIMARY_KEYS[table])
    parts = [
        key.select("table_name", F.lit("unique").alias("rule"), F.col("key_column").alias("column_name"), F.col("surplus_rows").alias("rows")),
        null_counts(rows, table, schemas.REQUIRED[table]).select(
            "table_name", F.lit("required").alias("rule"), "column_name", F.col("null_count").alias("rows")
        ),
        length_violations(rows, table, schemas.MAX_LENGTHS[table]).select(
            "table_name", F.lit("length").alias("rule"), "column_name", F.col("too_long").alias("rows")
        ),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def demand(rows: DataFrame, table: str) -> None:
    """Refuse rows that break a declared constraint of the table."""
    broken = table_report(rows, table).where("rows > 0").collect()  # one row per constraint at most
    if broken:
        raise ValueError("; ".join(f"{r.table_name}.{r.column_name}: {r.rows} rows break {r.rule}" for r in broken))
