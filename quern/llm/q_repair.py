"""Query of operator 13: all conversations, damaged by a rule and repaired."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import repair
from quern.llm.common import table


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, absent): each row dropped (absent), emptied, without ends of sentences, twice, as a user's, or as it is.

    Which, a CRC of conversation and turn tells; nulls count as one space.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    role = F.when(hit == 4, "user").otherwise(space("role"))
    text = F.when(hit == 1, "").when(hit == 2, F.translate(space("text"), repair.ENDS, "")).otherwise(space("text"))
    each = F.explode(F.array_repeat(hit == 0, F.when(hit == 3, 2).otherwise(1)))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), each.alias("absent"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.repair(damaged(table(spark, sf_dir, "conversations")), absent="absent")
    return found.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


QUERIES = {"op13_repair": op13_repair}
#: The checksum and the cheapest path are not for SQL; the tests compare with plain Python.
ORACLE_SQL: dict[str, str] = {}
