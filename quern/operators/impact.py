"""A period's impact: before, during and after, against the same months of a base year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.metrics import change, median, ratio, rounded
from quern.operators.dims import season
from quern.operators.fact import Dims, valid_measures

NAMES = ("Pre-COVID", "COVID Peak", "Post-COVID")


def every() -> Column:
    return F.count(F.lit(1))


def labelled(facts: DataFrame, dims: Dims, cuts: tuple[str, str], years: tuple[int, int]) -> DataFrame:
    """Facts of the years, each with its period; the years are also a literal filter, so partitions are pruned."""
    first, last = (F.lit(c).cast("date") for c in cuts)
    day = F.col("date_actual")
    days = dims.date.where(F.col("year").between(*years)).select(F.col("date_key").alias("created_date_key"), "year", "month", "month_name", F.when(day < first, NAMES[0]).when(day <= last, NAMES[1]).otherwise(NAMES[2]).alias("covid_period"))
    base = valid_measures(facts.where(F.col("created_year").between(*years)), null_open=True)
    return base.join(days, "created_date_key").join(dims.kind.select("complaint_type_key", "complaint_category"), "complaint_type_key", "left")


# The counts by category and by part of the type.
CATEGORIES = {"noise": "Noise", "transportation": "Transportation", "housing": "Building & Housing", "sanitation": "Sanitation & Cleanliness", "quality_of_life": "Quality of Life"}
PATTERNS = {"covid_specific": "COVID", "residential_noise": "NOISE - RESIDENTIAL", "outdoor_dining": "OUTDOOR DINING", "illegal_parking": "ILLEGAL PARKING"}
SLA = {"same_day_closure_rate": "SAME_DAY", "within_week_rate": "WITHIN_WEEK", "within_month_rate": "WITHIN_MONTH", "over_month_rate": "OVER_MONTH"}


def monthly(base: DataFrame) -> DataFrame:
    timed = F.count_if(F.col("is_closed") & F.col("valid_hours").isNotNull())
    return base.groupBy("year", "month", "covid_period").agg(
        F.max("month_name").alias("month_name"), every().alias("total_complaints"), F.count_if("is_closed").alias("closed_complaints"), timed.alias("complaints_with_valid_response_time"),
        F.avg("valid_hours").alias("avg_response_time_hours"), F.avg("valid_days").alias("avg_response_time_days"), median("valid_hours").alias("median_response_time_hours"), median("valid_days").alias("median_response_time_days"),
        *[ratio(F.count_if(F.col("valid_sla") == s), F.count("valid_sla")).alias(n) for n, s in SLA.items()], F.count("valid_sla").alias("total_valid_for_sla"), F.count_if("has_invalid_closed_date").alias("invalid_closed_dates"),
        F.count_if("has_closed_status_without_date").alias("closed_without_date"), F.count_if("open_status_with_closed_date").alias("open_with_closed_date"), ratio(timed, F.count_if("is_closed")).alias("response_time_data_quality_pct"),
        *[F.count_if(F.col("complaint_category") == c).alias(f"{n}_complaints") for n, c in CATEGORIES.items()], *[F.count_if(F.upper("complaint_type").contains(p)).alias(f"{n}_complaints") for n, p in PATTERNS.items()],
    )


BASELINE = {
    "baseline_monthly_complaints": "total_complaints", "baseline_noise_complaints": "noise_complaints", "baseline_transportation_complaints": "transportation_complaints", "baseline_response_time_hours": "avg_response_time_hours",
    "baseline_response_time_days": "avg_response_time_days", "baseline_same_day_rate": "same_day_closure_rate", "baseline_within_week_rate": "within_week_rate",
}


def phase(peak_year: int) -> Column:
    month = F.col("month")
    peak = F.when((F.col("year") == peak_year) & month.between(3, 6), "Lockdown Phase").when((F.col("year") == peak_year) & (month >= 7), "Early Recovery").when(F.col("year") == peak_year + 1, "Late Recovery")
    return F.when(F.col("covid_period") == NAMES[1], peak).when(F.col("covid_period") == NAMES[2], "New Normal").otherwise("Baseline")


def period_impact(facts: DataFrame, dims: Dims, cuts: tuple[str, str] = ("2020-03-16", "2021-06-30"), years: tuple[int, int] = (2019, 2023), baseline_year: int = 2019, zero_score: Column | None = None) -> DataFrame:
    """Months by period, with changes against the base year's months.

    The score divides noise by transportation counts; a count of 1 gives null, as does 0 unless
    ``zero_score`` says otherwise. A month that a cut parts has two rows, each compared with the whole month.
    """
    rows = monthly(labelled(facts, dims, cuts, years))
    base = rows.where((F.col("covid_period") == NAMES[0]) & (F.col("year") == baseline_year)).groupBy("month").agg(*[F.avg(c).alias(n) for n, c in BASELINE.items()])
    t, noise, cars = F.col("total_complaints"), F.col("noise_complaints"), F.col("transportation_complaints")
    pattern = (
        F.when(noise > F.coalesce("baseline_noise_complaints", F.lit(0)) * 1.3, "High Noise Period")
        .when(cars < F.coalesce("baseline_transportation_complaints", cars.cast("double")) * 0.7, "Low Transit Period")
        .when(t < F.coalesce("baseline_monthly_complaints", t.cast("double")) * 0.85, "Low Activity Period")
        .when(F.col("residential_noise_complaints") > noise * 0.5, "WFH Impact High")
        .otherwise("Normal Pattern")
    )
    score = F.when(cars != 1, F.coalesce(ratio(noise, cars, 2, 1.0), F.lit(None).cast("double") if zero_score is None else zero_score))
    points = lambda a, b: F.round(F.col(a) - F.col(b), 2)
    kept = [c for c in rows.columns if c not in ("year", "month", "month_name", "covid_period")]
    return rows.join(base, "month", "left").select(
        "year", "month", "month_name", "covid_period", *kept, *BASELINE, change(t, "baseline_monthly_complaints").alias("volume_change_pct"), (t - F.coalesce("baseline_monthly_complaints", F.lit(0.0))).alias("volume_change_absolute"),
        ratio("closed_complaints", t).alias("closure_rate"), change("avg_response_time_hours", "baseline_response_time_hours").alias("response_time_hours_change_pct"), change("avg_response_time_days", "baseline_response_time_days").alias("response_time_days_change_pct"),
        points("same_day_closure_rate", "baseline_same_day_rate").alias("same_day_rate_change_points"), points("within_week_rate", "baseline_within_week_rate").alias("within_week_rate_change_points"), ratio("invalid_closed_dates", t).alias("invalid_date_pct"),
        change(noise, "baseline_noise_complaints").alias("noise_change_pct"), change(cars, "baseline_transportation_complaints").alias("transportation_change_pct"), *[ratio(f"{n}_complaints", t).alias(f"{n}_mix_pct") for n in CATEGORIES],
        pattern.alias("covid_pattern_indicator"), score.alias("wfh_impact_score"), season(F.col("month")).alias("season"), phase(int(cuts[0][:4])).alias("covid_phase"),
    )


def impact_by(base: DataFrame, column: str, unknown: str) -> DataFrame:
    """Closure, response times and shares by ``column`` and period."""
    share = lambda c: ratio(F.count_if(F.col("complaint_category") == c), every())
    return base.where(F.col(column) != unknown).groupBy(column, "covid_period").agg(
        every().alias("complaints_count"), F.count_if("is_closed").alias("closed_count"), ratio(F.count_if("is_closed"), every()).alias("closure_rate"), rounded(F.avg("valid_hours")).alias("avg_response_time_hours"), rounded(F.avg("valid_days")).alias("avg_response_time_days"),
        F.count_if(F.col("complaint_category") == "Noise").alias("noise_count"), share("Noise").alias("noise_percentage"), F.count_if(F.col("complaint_category") == "Transportation").alias("transportation_count"), share("Transportation").alias("transportation_percentage"),
        ratio(F.count_if(F.col("valid_sla") == "SAME_DAY"), F.count("valid_sla")).alias("same_day_rate"),
    )


def top_types_by_period(base: DataFrame, n: int) -> DataFrame:
    rows = base.where(F.col("complaint_type") != "UNKNOWN").groupBy("covid_period", "complaint_type").agg(every().alias("complaint_count"), F.count_if("is_closed").alias("closed_count"), rounded(F.avg("valid_days")).alias("avg_days_to_close"))
    order = Window.partitionBy("covid_period").orderBy(F.desc("complaint_count"), "complaint_type")
    return rows.withColumn("rank_in_period", F.row_number().over(order)).where(F.col("rank_in_period") <= n)
