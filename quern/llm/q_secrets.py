"""Query of operator 8: candidates for secrets in all documents, rated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import secrets
from quern.llm.common import table


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secret itself is given as its digest."""
    found = secrets.occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "start", "length", F.sha2("secret", 256).alias("secret_sha256"), "score", "is_secret")


QUERIES = {"op8_secrets": op8_secrets}
#: SQL has no random forest; the tests compare with a plain search for the planted shape.
ORACLE_SQL: dict[str, str] = {}
