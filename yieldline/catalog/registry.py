"""Name -> query and name -> checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, run: Query, sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"{name} is registered twice")
    QUERIES[name] = run
    if sql is not None:
        ORACLES[name] = sql


def query(name: str, sql: str | None = None):
    """Decorator form of `register`."""

    def wrap(run: Query) -> Query:
        register(name, run, sql)
        return run

    return wrap
