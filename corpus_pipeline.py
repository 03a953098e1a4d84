"""The corpus pipeline: documents through five stages, each written and read again by the next.

Language identification drops texts without a language, near-dedup leaves one document of each group,
decontamination drops documents that hold a benchmark item, secrets are replaced in place, and the last
stage adds token ids and whether decoding them gives the text again. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, decontam, langid, neardup, secrets
from quern.llm.common import discard, fresh, quoted, stored, table

#: A language prediction below this score is rejected, besides ``und``.
LEAST_SCORE = 0.2
RANKS = "byte_bpe_multi_50k.tiktoken"


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a score of ``LEAST_SCORE`` at least; learned from their own labels.

    Null texts and texts without a letter go; a null lang, doc_id or source does not matter; repeated rows stay. Where
    no row has a language (an empty table too) nothing is learned, and none stays. All columns stay, whatever their names.
    """
    name, score = fresh(docs, "told"), fresh(docs, "certain")
    told = langid.predict(docs, langid.fit(docs), lang=name, score=score)
    return told.where((F.col(name) != langid.UNDETERMINED) & (F.col(score) >= LEAST_SCORE)).select(*[F.col(quoted(c)) for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of a similarity of 0.8 and more over five-word shingles.

    Null, empty and word-free texts and rows without doc_id stay; of rows that repeat a doc_id one stays
    (see ``deduplicated``). An empty table stays empty, and all columns stay.
    """
    return neardup.deduplicated(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts and repeated rows stay, as do all columns."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced. Null and empty texts and repeated rows stay as they are, as do all columns."""
    return secrets.redacted(docs)


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with n_tokens, token_ids (packed) and whether decoding gives the text again.

    A null text counts as empty: no tokens. Repeated rows stay; columns that have the new ones' names are replaced.
    """
    return bpe.round_trip(docs, public_tokenizers.path(RANKS))


STAGES = [
    ("language ID", known_language),
    ("near-dedup", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("secret scan", without_secrets),
    ("tokenisation", tokenised),
]

#: Classifiers, sketches and tokens are not for SQL; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's table is deleted once its successor is written; the last one that was written stays."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES[:-1]):
        before, docs = docs, stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
        if number:
            discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)
