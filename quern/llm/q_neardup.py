"""Query of operator 1: near-duplicate components of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import neardup
from quern.llm.common import table


def op1_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op1_near_duplicates": op1_near_duplicates}
#: In SQL the join of all shingles with each other doesn't end on whole tables; the tests compare with brute force.
ORACLE_SQL: dict[str, str] = {}
