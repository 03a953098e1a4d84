"""Daily features for forecasts of the request volume."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.metrics import Rolling, change, ratio, rounded
from quern.operators.dims import season
from quern.operators.fact import Dims
from quern.operators.marts import by_day

STARTED = ["OPEN", "ASSIGNED", "STARTED"]


def forecast_features(facts: DataFrame, dims: Dims, start: str = "2020-01-01", group_cols: tuple[str, ...] = (), first: int | None = None) -> DataFrame:
    """One row for each day (and group): the volume, its lags and rolling figures, and marks of the season.

    Lags and frames go by rows; with ``first``, a day number, by days from it on, of which those without a row count 0.
    """
    base = by_day(facts, dims).where(F.col("date_actual") >= F.lit(start).cast("date"))
    timed = F.when(F.col("is_closed") & (F.col("response_time_hours") >= 0), F.col("response_time_hours"))
    days = base.groupBy(*group_cols, "date_key", "date_actual").agg(
        F.count(F.lit(1)).alias("y"), F.count_if("is_closed").alias("closed_complaints"), F.count_if(F.upper("status").isin(STARTED)).alias("in_progress_count"), F.avg(timed).alias("mean_hours"), *[F.max(c).alias(c) for c in ("year", "month", "holiday_name")], *[F.max(c).cast("int").alias(c) for c in ("is_weekend", "is_holiday", "is_business_day")]
    )
    y, roll = F.col("y"), Rolling(*group_cols, first=first)
    rolled = days.withColumns({"week": roll.mean(y, 7), "mean": roll.mean(y, 30), "std": roll.deviation(y, 30), **{f"lag_{n}day": roll.lag(y, n) for n in (1, 7, 30, 365)}})
    m = F.col("month")
    flag = lambda *months: m.isin(*months).cast("int")
    return rolled.select(
        *group_cols, F.col("date_actual").alias("ds"), "y", "date_key", "year", "month", "is_weekend", "is_holiday", "is_business_day", "holiday_name", season(m).alias("season"), F.col("y").alias("total_complaints"), "closed_complaints", "in_progress_count",
        ratio("closed_complaints", "y").alias("closure_rate"), ratio("in_progress_count", "closed_complaints", 2, 1.0).alias("workload_ratio"), rounded("mean_hours").alias("avg_response_time_hours"), rounded("week").alias("rolling_7day_avg"), rounded("mean").alias("rolling_30day_avg"),
        *[f"lag_{n}day" for n in (1, 7, 30, 365)], rounded("std").alias("rolling_30day_std"), flag(7, 8).alias("is_summer_break"), flag(10, 11, 12, 1, 2, 3).alias("is_heating_season"), flag(1, 2, 7, 8).alias("is_extreme_weather_month"), F.col("is_holiday").alias("is_near_holiday"),
        change("y", "lag_7day").alias("week_over_week_change_pct"), F.when(F.col("std") > 0, rounded((F.col("y") - F.col("mean")) / F.col("std"), 3)).alias("z_score_30day"),
    )
