"""Query of operator 11: whitened embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import whitening
from quern.llm.common import table


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"), "embedding", "vec_id", most=16)


QUERIES = {"op11_whitening": op11_whitening}
#: SQL has no singular vectors; the tests compare with numpy's.
ORACLE_SQL: dict[str, str] = {}
