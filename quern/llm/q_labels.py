"""Queries of operators 5 and 6: toxicity and language of all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import langid, toxicity
from quern.llm.common import table, text_crc


def held_out(parts: int, part: int) -> Column:
    """Whether a document is kept from learning; a null id counts as not held out."""
    return F.coalesce(text_crc("doc_id") % parts == part, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out(3, 1))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    tree = langid.fit(docs.where(~held_out(4, 2)))
    return langid.predict(docs.select("doc_id", "text"), tree).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op5_toxicity": op5_toxicity, "op6_language": op6_language}
#: SQL has no classifier; the tests measure held-out accuracy.
ORACLE_SQL: dict[str, str] = {}
