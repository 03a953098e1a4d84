"""Day marts that hold sketches, and their merging into any longer or wider group without the facts.

A median or a count of distinct members of a month is not to be had from those of its days, but from their
sketches: quantiles (KLL) and distinct members (HLL) of each day and group are stored, and union into months,
areas and quarters. Their size is bounded, whatever the number of requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.fact import Dims
from quern.operators.marts import WITHIN, by_day, every

#: KLL's k: a quantile of n values is off by about 0.4 % of n in rank at most (exact below some hundred values); HLL's lg k: counts are off by about 1.6 %.
QUANTILES, DISTINCT = 800, 12
COUNTS = ["total_complaints", "closed", "valid_response_count", "within_sla_count"]


def day_sketches(facts: DataFrame, dims: Dims, by: list[str], distinct: list[str]) -> DataFrame:
    """(date_key, by, COUNTS, hours, distinct_<column>): each group's day, with a sketch of its response times and one of each column's members."""
    return by_day(facts, dims).groupBy("date_key", *by).agg(
        every().alias("total_complaints"), F.count_if("is_closed").alias("closed"), F.count("valid_hours").alias("valid_response_count"), F.count_if(F.col("valid_sla").isin(WITHIN)).alias("within_sla_count"),
        F.kll_sketch_agg_double("valid_hours", F.lit(QUANTILES)).alias("hours"), *[F.hll_sketch_agg(c, F.lit(DISTINCT)).alias(f"distinct_{c}") for c in distinct],
    )


def rolled_up(mart: DataFrame, by: list[Column | str], shares: tuple[float, ...] = (0.5, 0.9)) -> DataFrame:
    """(by, COUNTS, q50, q90, distinct members) of groups of a sketch mart's rows; only the mart is read.

    A quantile is null where no request of the group has a response time.
    """
    members = [c for c in mart.columns if c.startswith("distinct_")]
    merged = mart.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS], F.kll_merge_agg_double("hours").alias("hours"), *[F.hll_union_agg(c).alias(c) for c in members])
    quantile = lambda p: F.when(F.col("valid_response_count") > 0, F.kll_sketch_get_quantile_double("hours", F.lit(p)))
    return merged.select("*", *[quantile(p).alias(f"q{round(p * 100)}") for p in shares]).withColumns({c: F.hll_sketch_estimate(c) for c in members}).drop("hours")


def quarter(key: str = "date_key") -> Column:
    """yyyyq of a yyyyMMdd key."""
    return (F.floor(F.col(key) / 10_000) * 10 + F.ceil(F.floor(F.col(key) / 100) % 100 / 3)).cast("int").alias("quarter_key")


def rank_errors(rows: DataFrame, told: DataFrame, by: list[str], value: str, estimate: str, share: float) -> DataFrame:
    """(by, off): how far an estimate's rank among the exact values is from ``share``, as a share of them; 0 within a run of equal values."""
    x = F.col(value)
    ranked = rows.where(x.isNotNull()).join(told.select(*by, estimate), by).groupBy(*by).agg(F.avg((x < F.col(estimate)).cast("double")).alias("below"), F.avg((x <= F.col(estimate)).cast("double")).alias("upto"))
    return ranked.select(*by, F.greatest(F.lit(0.0), F.col("below") - share, share - F.col("upto")).alias("off"))
