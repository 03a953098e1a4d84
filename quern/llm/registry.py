"""The queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

#: Modules of this subpackage that hold ``QUERIES`` and ``ORACLE_SQL``.
MODULES = ["q_bpe", "q_labels", "q_lm", "q_html", "q_decontam", "q_neardup", "q_ann", "q_chat", "q_secrets", "q_quality", "q_whitening", "q_repair", "q_pipeline"]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for m in MODULES for k, v in import_module(f"quern.llm.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in import_module(f"quern.llm.{m}").ORACLE_SQL.items()}
