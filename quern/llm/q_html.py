"""Query of operator 10: main text of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm import htmltext
from quern.llm.common import table


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmltext.extract(pages, htmltext.fit(pages)).select("page_id", "url", "text", "n_chars")


QUERIES = {"op10_html_text": op10_html_text}
#: SQL has no network; the tests compare with the known parts of composed and given pages.
ORACLE_SQL: dict[str, str] = {}
