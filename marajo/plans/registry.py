"""Named queries over the star tables, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

FLAGSHIP = "s9_state_panel"

#: Modules of this package that register queries.
MODULES: tuple[str, ...] = ("cleaning_queries", "table_queries", "load_queries", "pipeline_queries", "programme_queries", "scale_queries")

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    return [import_module(f"marajo.plans.{name}") for name in MODULES]


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    found: dict[str, Query] = {}
    for module in _modules():
        found |= module.QUERIES
    return found


def oracle_sql() -> dict[str, str]:
    """The SQL twin of each query that has one."""
    found: dict[str, str] = {}
    for module in _modules():
        found |= module.ORACLES
    return found
