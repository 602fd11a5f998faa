"""All queries of the library by name, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.plans import contract, evidence, headlines, pages, reporting, streaming

_MODULES = (contract, reporting, headlines, evidence, pages, streaming)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for module in _MODULES for name, f in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.SQL.items()}
