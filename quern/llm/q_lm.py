"""Query of operator 7: language-model scores of all documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import lmscore
from quern.llm.common import table
from quern.llm.q_labels import held_out


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lmscore.score(docs, ~held_out(5, 1))
    return scored.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES = {"op7_lm_score": op7_lm_score}
#: SQL can't fit the weights; the tests compare with a brute-force model.
ORACLE_SQL: dict[str, str] = {}
