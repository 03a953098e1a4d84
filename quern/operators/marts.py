"""Daily and monthly summaries of the facts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions.metrics import Rolling, change, day_number, median, ratio, rounded, top_n, trailing, trend
from quern.functions.shared import discard, stored
from quern.operators.dims import date_key
from quern.operators.fact import Dims, valid_measures
from quern.operators.versions import Version, current, merge, overwrite

# Groups of states, and the classes within the service level.
IN_PROGRESS = ["ASSIGNED", "STARTED", "IN PROGRESS"]
WITHIN = ["SAME_DAY", "WITHIN_WEEK"]


def every() -> Column:
    return F.count(F.lit(1))


def created_since(facts: DataFrame, since: int | None) -> DataFrame:
    """Facts from a day on (yyyyMMdd); the year alone prunes partitions, where the facts have it."""
    if since is None:
        return facts
    recent = facts.where(F.col("created_date_key") >= since)
    return recent.where(F.col("created_year") >= since // 10000) if "created_year" in facts.columns else recent


def by_day(facts: DataFrame, dims: Dims, kinds: bool = False) -> DataFrame:
    """Facts with valid measures and their day; with the category of their type, if asked for.

    The inner join drops facts whose day is null or outside the dimension.
    """
    days = dims.date.select(F.col("date_key"), "date_actual", "year", "month", "month_name", "is_weekend", "is_holiday", "holiday_name", "is_business_day")
    out = valid_measures(facts).withColumn("date_key", F.col("created_date_key")).join(days, "date_key")
    return out.join(dims.kind.select("complaint_type_key", "complaint_category"), "complaint_type_key", "left") if kinds else out


def closed_metrics() -> list[Column]:
    """Aggregates that all summaries share."""
    return [
        every().alias("total_complaints"),
        F.count_if("is_closed").alias("closed"),
        F.avg("valid_hours").alias("avg_hours"),
        median("valid_hours").alias("median_hours"),
        F.count("valid_hours").alias("valid_response_count"),
        F.count_if(F.col("valid_sla").isin(WITHIN)).alias("within_sla_count"),
        F.count("valid_sla").alias("total_valid_closed_for_sla"),
        F.count_if(F.col("is_closed") & F.col("valid_hours").isNull()).alias("closed_without_valid_time"),
        F.count_if(F.col("is_closed") & F.col("valid_sla").isNull()).alias("closed_without_valid_sla"),
        *[F.count_if(F.col("status").isin(s)).alias(name) for name, s in (("opened", ["OPEN"]), ("in_progress", IN_PROGRESS), ("pending", ["PENDING"]), ("other_status", ["CANCEL", "UNSPECIFIED"]))],
    ]


def counts(base: DataFrame, by: list[str], name: str) -> DataFrame:
    return base.where(F.col(name).isNotNull()).groupBy(*by, name).agg(every().alias("n"))


def daily_core(facts: DataFrame, dims: Dims) -> DataFrame:
    """Counts, response times and service level of each day."""
    return by_day(facts, dims).groupBy("date_key").agg(F.max("date_actual").alias("date_actual"), *closed_metrics())


@dataclass(frozen=True)
class Since:
    """A look-back: the first day to build (yyyyMMdd), and what rolling frames need of the rows before it (keys, date_key, total_complaints)."""

    day: int
    past: DataFrame

    @staticmethod
    def of(mart: DataFrame, by: list[str], last_day: str, lookback: int, rows: int, days: bool = False) -> Since:
        """From ``lookback`` days before ``last_day`` on, with the last ``rows`` rows of each key of a stored mart (or those of so many days before)."""
        start = F.date_sub(F.lit(last_day).cast("date"), lookback)
        first = mart.sparkSession.range(1).select(date_key(start).alias("a"), date_key(F.date_sub(start, rows)).alias("b")).first()
        before = mart.where(F.col("date_key") < first.a).select(*by, "date_key", "total_complaints")
        if days:
            return Since(first.a, before.where(F.col("date_key") >= first.b))
        newest = Window.partitionBy(*by).orderBy(F.desc("date_key"))
        return Since(first.a, before.withColumn("__n", F.row_number().over(newest)).where(F.col("__n") <= rows).drop("__n"))


def rolled(rows: DataFrame, since: Since | None, columns: dict[str, Column]) -> DataFrame:
    """Add columns over windows, in which the rows before a look-back take part."""
    if since is None:
        return rows.withColumns(columns)
    both = rows.withColumn("__new", F.lit(True)).unionByName(since.past, allowMissingColumns=True)
    return both.withColumns(columns).where("__new").drop("__new")


def first_day(facts: DataFrame, dims: Dims) -> int:
    """The number of the first day that a mart of these facts has: two columns are read, one value comes back."""
    keys = facts.select(F.col("created_date_key").alias("date_key")).join(dims.date.select("date_key"), "date_key", "left_semi")
    return keys.agg(F.min(day_number())).first()[0] or 0


def agg_daily(facts: DataFrame, dims: Dims, since: Since | None = None, first: int | None = None) -> DataFrame:
    """The daily summary: one row for each day of creation.

    With ``since``, the days from there on, equal to those of a full build: read are the facts created since and, in a scan of
    their own, those closed since. With ``first`` (see ``first_day``), rolling figures go by days and not by rows.
    """
    recent = created_since(facts, since and since.day)
    base = by_day(recent, dims)
    days = daily_core(recent, dims)
    ended = base if since is None else by_day(facts.where(F.col("closed_date_key") >= since.day), dims)
    closed = ended.where("is_closed").groupBy(F.col("closed_date_key").alias("date_key")).agg(every().alias("closed_complaints"))
    types, agencies = (top_n(counts(base, ["date_key"], c), ["date_key"], c, "n", 3, p) for c, p in (("complaint_type", "top_complaint_type"), ("agency_code", "top_agency")))
    total, roll = F.col("total_complaints"), Rolling(first=first)  # one row for each day
    framed = rolled(days, since, {"week": roll.mean(total, 7), "month": roll.mean(total, 30), "yesterday": roll.lag(total), "week_ago": roll.lag(total, 7)})
    joined = framed.join(closed, "date_key", "left").join(types, "date_key", "left").join(agencies, "date_key", "left")
    tops = [f"{p}_{i}{s}" for p in ("top_complaint_type", "top_agency") for i in (1, 2, 3) for s in ("", "_count")]
    return joined.select(
        "date_key", "date_actual", "total_complaints", total.alias("new_complaints"), F.col("closed").alias("completed_count"), F.col("opened").alias("new_count"), F.col("in_progress").alias("in_progress_count"),
        F.col("pending").alias("waiting_count"), F.col("other_status").alias("other_status_count"), "valid_response_count", "within_sla_count", "total_valid_closed_for_sla", "closed_without_valid_time", "closed_without_valid_sla", *tops,
        F.coalesce("closed_complaints", F.lit(0)).alias("closed_complaints"), ratio("closed", total).alias("completion_rate"), ratio("in_progress", total).alias("in_progress_rate"),
        rounded("avg_hours").alias("avg_response_time_hours"), rounded("median_hours").alias("median_response_time_hours"), ratio("within_sla_count", "total_valid_closed_for_sla").alias("sla_compliance_rate"),
        ratio("closed_without_valid_time", "closed").alias("pct_closed_missing_valid_time"), rounded("week").alias("complaints_7day_avg"), rounded("month").alias("complaints_30day_avg"),
        change(total, "yesterday").alias("day_over_day_change_pct"), change(total, "week_ago").alias("week_over_week_change_pct"), trend(total, "yesterday", 1.1, 0.9, ("UP", "DOWN")).alias("trend_direction"),
    )


def agency_backlog(facts: DataFrame, dims: Dims, as_of: str) -> DataFrame:
    """Requests of each agency that are open now, and their mean age in days."""
    today = F.lit(as_of).cast("date")
    return by_day(facts, dims).where(~F.col("is_closed")).groupBy("agency_key").agg(every().alias("backlog_count"), F.avg(F.datediff(today, "date_actual")).alias("avg_open_days")).withColumn("date_key", date_key(today))


def agg_agency(facts: DataFrame, dims: Dims, as_of: str, since: Since | None = None, first: int | None = None) -> DataFrame:
    """Each agency's day: rates, ranks, top categories, and the backlog on the row of ``as_of``.

    With ``since``, the days from there on, equal to those of a full build: the backlog comes from a scan of the
    open requests alone, however old. With ``first``, rolling figures go by days.
    """
    base, by = by_day(created_since(facts, since and since.day), dims, kinds=True), ["date_key", "agency_key"]
    quick = F.count_if(F.col("is_closed") & (F.col("valid_hours") <= 24)).alias("same_day")
    touch = F.count_if(F.col("has_resolution") & (F.col("valid_hours") <= 48)).alias("first_touch")
    rows = base.groupBy(*by).agg(*closed_metrics(), quick, touch)
    day, roll = Window.partitionBy("date_key"), Rolling("agency_key", first=first)
    total = F.col("total_complaints")
    share = F.when(F.col("total_valid_closed_for_sla") > 0, F.col("within_sla_count") / F.col("total_valid_closed_for_sla")).otherwise(0.0)
    framed = rolled(
        rows, since,
        {
            "of_day": F.sum(total).over(day), "week": roll.mean(total, 7), "week_ago": roll.lag(total, 7),
            "agency_rank_by_volume": F.row_number().over(day.orderBy(F.desc("total_complaints"), "agency_key")), "agency_rank_by_sla": F.row_number().over(day.orderBy(share.desc(), "agency_key")),
        },
    )
    top = top_n(counts(base, by, "complaint_category"), by, "complaint_category", "n", 3, "top_complaint_category")
    names = dims.agency.select(F.col("agency_id").alias("agency_key"), "agency_name", "agency_category")
    joined = framed.join(names, "agency_key").join(top, by, "left").join(agency_backlog(facts, dims, as_of), by, "left")
    done = F.try_divide(F.col("closed") * F.lit(100.0), total)
    kept = F.try_divide(F.col("within_sla_count") * F.lit(100.0), F.col("total_valid_closed_for_sla").cast("double"))
    return joined.select(
        *by, "agency_name", "agency_category", "total_complaints", total.alias("new_complaints"), F.col("closed").alias("closed_complaints"), F.col("in_progress").alias("in_progress_complaints"), F.col("pending").alias("pending_complaints"),
        "valid_response_count", "total_valid_closed_for_sla", "closed_without_valid_time", "closed_without_valid_sla", *[f"top_complaint_category_{i}{s}" for i in (1, 2, 3) for s in ("", "_count")],
        "agency_rank_by_volume", "agency_rank_by_sla", rounded("avg_hours").alias("avg_response_time_hours"), rounded("median_hours").alias("median_response_time_hours"), rounded(kept).alias("sla_compliance_rate"),
        ratio("same_day", "closed").alias("same_day_resolution_rate"), ratio("first_touch", total).alias("first_touch_resolution_rate"), ratio("closed_without_valid_time", "closed").alias("pct_closed_missing_valid_time"),
        ratio(total, "of_day").alias("pct_of_total_daily_complaints"), ratio(total, "week", 2, 1.0).alias("workload_index"), rounded("week").alias("complaints_7day_avg"), trend(total, "week_ago", 1.1, 0.9, ("UP", "DOWN")).alias("trend_direction"),
        F.coalesce("avg_open_days", F.lit(0.0)).alias("avg_open_days"), F.coalesce("backlog_count", F.lit(0)).alias("backlog_count"), rounded(done * kept / 100.0).alias("productivity_score"),
    )


def agg_location(facts: DataFrame, dims: Dims, hot: tuple[float, float, float] = (2.0, 1.5, 1.2), since: Since | None = None, first: int | None = None) -> DataFrame:
    """Each location's day: ranks, and how it stands out from its area's mean.

    With ``since``, the days from there on, equal to those of a full build; with ``first``, rolling figures go by days.
    """
    base, by = by_day(created_since(facts, since and since.day), dims), ["date_key", "location_key"]
    rows = base.groupBy(*by).agg(F.max("borough").alias("borough"), F.max("city").alias("city"), *closed_metrics())
    total, roll = F.col("total_complaints"), Rolling("location_key", first=first)
    area, place = Window.partitionBy("date_key", "borough"), Window.partitionBy("date_key", "borough", "city")
    largest = [F.desc("total_complaints"), "location_key"]
    framed = rolled(
        rows, since,
        {
            "week": roll.mean(total, 7), "week_ago": roll.lag(total, 7), "yesterday": roll.lag(total), "mean": F.avg(total).over(area), "of_area": F.sum(total).over(area),
            "locations_in_borough": F.count("location_key").over(area), "borough_rank_daily": F.row_number().over(area.orderBy(*largest)), "city_rank_in_borough": F.row_number().over(place.orderBy(*largest)),
            "citywide_rank": F.row_number().over(Window.partitionBy("date_key").orderBy(*largest)),
        },
    )
    top = top_n(counts(base, by, "complaint_type"), by, "complaint_type", "n", 3, "top_complaint_type")
    zips = dims.location.select(F.col("location_id").alias("location_key"), "zip_code")
    high, medium, low = (total > F.col("mean") * k for k in hot)
    off = F.abs(total - F.col("week"))
    return framed.join(zips, "location_key", "left").join(top, by, "left").select(
        *by, "borough", "city", "zip_code", "total_complaints", F.col("opened").alias("open_complaints"), F.col("closed").alias("closed_complaints"), total.alias("new_complaints"), "valid_response_count", "total_valid_closed_for_sla",
        "closed_without_valid_time", *[f"top_complaint_type_{i}{s}" for i in (1, 2, 3) for s in ("", "_count")], "borough_rank_daily", "city_rank_in_borough", "citywide_rank", "locations_in_borough",
        rounded("avg_hours").alias("avg_response_time_hours"), rounded("median_hours").alias("median_response_time_hours"), ratio("within_sla_count", "total_valid_closed_for_sla").alias("sla_compliance_rate"), ratio("closed", total).alias("completion_rate"),
        ratio("closed_without_valid_time", "closed").alias("pct_closed_missing_valid_time"), rounded("week").alias("complaints_7day_avg"), change(total, "week_ago").alias("complaints_vs_prev_week_pct"), change(total, "yesterday").alias("complaints_vs_prev_day_pct"),
        medium.alias("is_hotspot"), F.when(high, "HIGH").when(medium, "MEDIUM").when(low, "LOW").otherwise("NORMAL").alias("hotspot_severity"), rounded("mean").alias("borough_avg_complaints"), ratio(total, "mean").alias("pct_of_borough_avg"),
        ratio(total, "of_area").alias("pct_of_borough_total"), trend(total, "week_ago", 1.2, 0.8, ("INCREASING", "DECREASING")).alias("trend_direction"),
        F.when(off > F.col("week") * 0.3, "HIGH_VARIANCE").when(off > F.col("week") * 0.15, "MEDIUM_VARIANCE").otherwise("LOW_VARIANCE").alias("volatility"),
    )


def agg_type(facts: DataFrame, dims: Dims, since: Since | None = None) -> DataFrame:
    """Each type's day, with its commonest agency and area (the smallest of equals); with ``since``, the days from there on."""
    return by_day(created_since(facts, since and since.day), dims, kinds=True).groupBy("date_key", "complaint_type_key").agg(
        *[F.max(c).alias(c) for c in ("date_actual", "complaint_type", "descriptor", "complaint_category")], every().alias("total_complaints"), F.count_if("is_closed").alias("closed_complaints"), F.avg("valid_hours").alias("avg_response_time_hours"),
        median("valid_hours").alias("median_response_time_hours"), F.count("valid_hours").alias("valid_response_count"), F.mode("agency_code", True).alias("most_common_agency"), F.mode("borough", True).alias("most_common_borough"),
    )


def monthly_core(facts: DataFrame, dims: Dims) -> DataFrame:
    base = by_day(facts, dims)
    month_key = (F.col("year") * 100 + F.col("month")).cast("int").alias("month_key")
    return base.groupBy("year", "month", month_key).agg(F.max("month_name").alias("month_name"), F.min("date_actual").alias("month_start_date"), F.max("date_actual").alias("month_end_date"), *closed_metrics(), F.count_distinct("date_actual").alias("days_in_month"))


def shifted(months: DataFrame, by: int, names: dict[str, str], compat: bool = False) -> DataFrame:
    """Values of ``by`` months before, on each month's row. ``compat`` adds ``by`` to the yyyyMM key itself, which links no December to January."""
    index = F.col("month_key") if compat else F.col("year") * 12 + F.col("month")
    past = months.select((index + by).alias("__at"), *[F.col(c).alias(n) for c, n in names.items()])
    return months.withColumn("__at", index).join(past, "__at", "left").drop("__at")


def month_end_open(facts: DataFrame, dims: Dims) -> DataFrame:
    """Open requests that were created on the last day of each month that has data."""
    days = by_day(facts, dims).groupBy("year", "month", "date_actual").agg(F.count_if(F.col("status") == "OPEN").alias("n"))
    last = days.groupBy("year", "month").agg(F.max(F.struct("date_actual", "n")).alias("last"))
    return last.select((F.col("year") * 100 + F.col("month")).cast("int").alias("month_key"), F.nullif(F.col("last.n"), F.lit(0)).alias("open_at_end"))


def agg_monthly(facts: DataFrame, dims: Dims, compat: bool = False) -> DataFrame:
    """The monthly summary with growth by month and year."""
    base = by_day(facts, dims, kinds=True).withColumn("month_key", (F.col("year") * 100 + F.col("month")).cast("int"))
    months = monthly_core(facts, dims)
    kept = {"total_complaints": "total_complaints", "valid_response_count": "valid_response_count"}
    grown = shifted(months, 1, {c: f"{n}_prev_month" for c, n in kept.items()}, compat)
    grown = shifted(grown, 12, {c: f"{n}_prev_year" for c, n in kept.items()})
    quarter = trailing("month_key", 3)
    grown = grown.withColumns({f"{n}_3": F.avg(n).over(quarter) for n in ("total_complaints", "closed", "valid_response_count")})
    cats = top_n(counts(base, ["month_key"], "complaint_category"), ["month_key"], "complaint_category", "n", 5, "top_complaint_category")
    ags = top_n(counts(base, ["month_key"], "agency_code"), ["month_key"], "agency_code", "n", 3, "top_agency")
    joined = grown.join(cats, "month_key", "left").join(ags, "month_key", "left").join(month_end_open(facts, dims), "month_key", "left")
    for i in (1, 2, 3):
        joined = joined.join(dims.agency.select(F.col("agency_key").alias(f"top_agency_{i}"), F.col("agency_name").alias(f"top_agency_{i}_name")), f"top_agency_{i}", "left")
    total = F.col("total_complaints")
    past = lambda c: F.coalesce(c, F.lit(0))
    three = lambda p: sum(past(f"{p}_{i}_count") for i in (1, 2, 3))
    return joined.select(
        "month_key", "year", "month", "month_name", "month_start_date", "month_end_date", "days_in_month", "total_complaints", F.col("closed").alias("completed_complaints"), F.col("opened").alias("open_complaints"), F.col("in_progress").alias("in_progress_complaints"),
        F.col("pending").alias("pending_complaints"), "valid_response_count", "total_valid_closed_for_sla", "closed_without_valid_time", *[f"top_complaint_category_{i}{s}" for i in range(1, 6) for s in ("", "_count")],
        *[c for i in (1, 2, 3) for c in (F.col(f"top_agency_{i}").alias(f"top_agency_{i}_code"), f"top_agency_{i}_name", f"top_agency_{i}_count")], ratio(total, "days_in_month", 2, 1.0).alias("avg_daily_complaints"), F.coalesce("open_at_end", "opened").alias("open_complaints_eom"),
        rounded("avg_hours").alias("avg_response_time_hours"), rounded("median_hours").alias("median_response_time_hours"), ratio("within_sla_count", "total_valid_closed_for_sla").alias("sla_compliance_rate"), ratio("closed", total).alias("completion_rate"),
        ratio("closed_without_valid_time", "closed").alias("pct_closed_missing_valid_time"), ratio(total, "closed", 2, 1.0).alias("completion_ratio"), ratio("opened", total).alias("open_rate"), ratio("in_progress", total).alias("in_progress_rate"),
        past("total_complaints_prev_month").alias("total_complaints_prev_month"), change(total, "total_complaints_prev_month").alias("mom_growth_rate"), (total - past("total_complaints_prev_month")).alias("mom_growth_absolute"),
        past("valid_response_count_prev_month").alias("valid_response_count_prev_month"), change("valid_response_count", "valid_response_count_prev_month").alias("mom_valid_data_growth_rate"), past("total_complaints_prev_year").alias("total_complaints_prev_year"),
        change(total, "total_complaints_prev_year").alias("yoy_growth_rate"), (total - past("total_complaints_prev_year")).alias("yoy_growth_absolute"), trend(total, "total_complaints_prev_year", 1.1, 0.9, ("GROWTH", "DECLINE")).alias("yoy_trend"),
        past("valid_response_count_prev_year").alias("valid_response_count_prev_year"), change("valid_response_count", "valid_response_count_prev_year").alias("yoy_valid_data_growth_rate"), rounded("total_complaints_3").alias("complaints_3month_avg"),
        rounded("closed_3").alias("completed_3month_avg"), rounded("valid_response_count_3").alias("valid_responses_3month_avg"), ratio(three("top_complaint_category"), total).alias("top_3_categories_pct"), ratio(three("top_agency"), total).alias("top_3_agencies_pct"),
    )


def refresh(spark: SparkSession, path: str, build: Callable[[Since], DataFrame], by: list[str], last_day: str, lookback: int, rows: int = 30, days: bool = False) -> Version:
    """Build the last ``lookback`` days of the mart at ``path`` anew and merge them into it by (``date_key``, ``by``).

    Rolling frames take what they need of earlier days, ``rows`` rows of each key (or days), from the mart itself; of facts
    only those are read that ``build`` asks for from its look-back on. Rows of these days that are no more built are removed. The
    mart is partitioned by month, so months before the look-back are carried by reference.
    """
    mart = current(spark, path)
    if mart is None:
        raise ValueError(f"{path} has no mart yet: put down a full build first")
    keys = ["date_key", *by]
    since = Since.of(mart, by, last_day, lookback, rows, days)
    built = stored(build(since), "mart-days")
    gone = mart.where(F.col("date_key") >= since.day).join(built.select(*keys), keys, "left_anti")
    updates = with_month(built).withColumn("gone", F.lit(False)).unionByName(gone.withColumn("gone", F.lit(True)))
    done = merge(spark, path, updates, keys, deletes="gone")
    discard(built)
    return done


def with_month(mart: DataFrame) -> DataFrame:
    """A day mart with its partition column."""
    return mart.withColumn("mart_month", F.floor(F.col("date_key") / 100).cast("int"))


def put_down(spark: SparkSession, path: str, mart: DataFrame) -> Version:
    """A full build of a day mart, as the next version of the table at ``path``."""
    return overwrite(spark, path, with_month(mart), ["mart_month"])


def incremental(build: Callable[[Since], DataFrame], mart: DataFrame, by: list[str], last_day: str, lookback: int, rows: int = 30, days: bool = False) -> DataFrame:
    """The last ``lookback`` days of a day mart, up to ``last_day``, equal to those of a full build, from an earlier mart and the new facts."""
    since = Since.of(mart, by, last_day, lookback, rows, days)
    return build(since).where(F.col("date_key") >= since.day)


def incremental_months(build: Callable[[DataFrame], DataFrame], facts: DataFrame, last_month: int, lookback: int) -> DataFrame:
    """The months from ``lookback`` before ``last_month`` (as 202401) on; read are those and the twelve months before, for changes by year."""
    back = lambda n: (last_month // 100 * 12 + last_month % 100 - 1 - n) // 12 * 100 + (last_month // 100 * 12 + last_month % 100 - 1 - n) % 12 + 1
    recent = facts.where(F.col("created_date_key") >= back(lookback + 12) * 100)
    return build(recent).where(F.col("month_key") >= back(lookback))
