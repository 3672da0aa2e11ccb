"""Named queries over the driver's tables, and DuckDB SQL for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import point_queries, raster_queries, surface_queries, system_queries

_GROUPS = (point_queries, raster_queries, surface_queries, system_queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for g in _GROUPS for name, f in g.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for g in _GROUPS for name, text in g.ORACLES.items()}
