"""The library's queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Modules of ``quern.plans`` that hold ``QUERIES`` and ``ORACLE_SQL``.
MODULES = ["marts", "cleaning", "keyed", "quality"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in import_module(f"quern.plans.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"quern.plans.{m}").ORACLE_SQL.items()}
