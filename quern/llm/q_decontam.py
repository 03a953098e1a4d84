"""Query of operator 4: the benchmark items that documents hold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import decontam
from quern.llm.common import table


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item in it; documents without any have no row."""
    found = decontam.find(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("hits").alias("hit")).select("doc_id", "hit.item_id", "hit.distance", F.col("hit.end").alias("end_at"))


QUERIES = {"op4_decontaminate": op4_decontaminate}
#: SQL can't search for substrings within an edit distance; the tests compare with a plain search of all places.
ORACLE_SQL: dict[str, str] = {}
