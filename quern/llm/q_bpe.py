"""Query of operator 3: encode and decode all documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe
from quern.llm.common import table

RANKS = "byte_bpe_multi_50k.tiktoken"


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, path).select("doc_id", "n_tokens", "token_ids")
    both = bpe.decode(coded, path)
    return both.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {"op3_bpe": op3_bpe}
#: SQL has no tokenizer; the tests compare with the tiktoken library.
ORACLE_SQL: dict[str, str] = {}
