"""Query of operator 2: nearest neighbours of every hundredth vector among all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import ann
from quern.llm.common import table


def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


QUERIES = {"op2_nearest": op2_nearest}
#: An approximate search need not equal SQL's exact one; the tests measure recall against brute force.
ORACLE_SQL: dict[str, str] = {}
