"""Hand-over of model tables to dashboards: JDBC where a database is there, Parquet otherwise."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame


def export_parquet(rows: DataFrame, path: str) -> DataFrame:
    """One read-optimised copy with the columns a dashboard imports."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def export_jdbc(rows: DataFrame, table: str, connections: int | None = None) -> None:
    """Overwrite a database table. Address and login come from the environment, never from code.

    `connections` is what the database allows at once: the finished rows are dealt to so many tasks, and the work before
    keeps its own number.
    """
    (
        (rows.repartition(connections) if connections else rows)
        .write.format("jdbc")
        .option("url", os.environ["SERVING_JDBC_URL"])
        .option("user", os.environ["SERVING_JDBC_USER"])
        .option("password", os.environ["SERVING_JDBC_PASSWORD"])
        .option("dbtable", table)
        .option("truncate", "true")
        .mode("overwrite")
        .save()
    )
