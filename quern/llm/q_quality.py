"""Query of operator 12: quality of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import quality
from quern.llm.common import table


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


QUERIES = {"op12_quality": op12_quality}
#: SQL has no boosted trees; the tests compare the counts with plain Python and measure held-out accuracy.
ORACLE_SQL: dict[str, str] = {}
