"""Registered queries, each with the SQL that must give the same rows.

Importing the modules fills the registry.
"""

from yieldline.catalog import (  # noqa: F401
    aggregates,
    expressions,
    joins,
    kpis,
    loads,
    streams,
    validation,
)
from yieldline.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
