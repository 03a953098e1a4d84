"""Queries of the star schema, the summaries, the impact study and the forecast features."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.metrics import top_n
from quern.operators import features, impact, marts
from quern.operators import fact as facts
from quern.plans.views import AS_OF, CAL, FACT, REQUESTS, contract, half_up, star

CUTS, YEARS, BASE_YEAR = ("1998-01-01", "1999-06-30"), (1997, 2001), 1997

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = half_up(sql)
        return f

    return register


DAY = "monthname(date_actual) AS month_name, strftime(date_actual, '%b') AS month_short, strftime(date_actual, '%Y-%m') AS year_month, weekofyear(date_actual)::INT AS week_of_year"


@query(
    f"""WITH {CAL} SELECT date_key, date_actual, year, quarter, 'Q' || quarter || '-' || year AS quarter_name, month, {DAY}, dom AS day_of_month, dow AS day_of_week_num, dayname(date_actual) AS day_name,
    strftime(date_actual, '%a') AS day_short, dayofyear(date_actual)::INT AS day_of_year, is_weekend, (year + (month >= 7)::INT)::INT AS fiscal_year, ((quarter + 1) % 4 + 1)::INT AS fiscal_quarter,
      holiday_name, NOT is_weekend AS is_weekday,
    'FY' || (year + (month >= 7)::INT) AS fiscal_year_name, 'FY' || (year + (month >= 7)::INT) || '-Q' || ((quarter + 1) % 4 + 1) AS fiscal_period, holiday_name IS NOT NULL AS is_holiday,
      NOT is_weekend AND holiday_name IS NULL AS is_business_day,
    CASE WHEN date_actual = DATE '{AS_OF}' THEN 'Today' WHEN date_actual = DATE '{AS_OF}' - 1 THEN 'Yesterday' WHEN date_actual >= DATE '{AS_OF}' - 7 THEN 'Last 7 Days' WHEN date_actual >= DATE '{AS_OF}' - 30 THEN 'Last 30 Days'
      WHEN date_actual >= DATE '{AS_OF}' - 90 THEN 'Last 90 Days' ELSE 'Past' END AS relative_date,
    CASE WHEN month IN (12, 1, 2) THEN 'Winter' WHEN month < 6 THEN 'Spring' WHEN month < 9 THEN 'Summer' ELSE 'Fall' END AS season,
    (SELECT count(*) FROM orders WHERE o_orderdate::DATE = date_actual) AS requests FROM hol"""
)
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    """The date dimension with the number of requests of each day."""
    _, d = star(spark, sf)
    per = contract(spark, sf).groupBy(F.to_date("created_date").alias("date_actual")).agg(F.count(F.lit(1)).alias("requests"))
    return d.date.join(per, "date_actual", "left").withColumn("requests", F.coalesce("requests", F.lit(0)))


@query(f"{FACT} SELECT agency_id, agency_code AS agency_key, agency_code AS agency_name, 'Other' AS agency_category FROM ag")
def dim_agency(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)[1].agency


@query(
    f"""{FACT} SELECT location_id, b AS borough, z AS zip_code, b || '|' || z AS location_key, md5(b || '|' || z) AS location_hash, CASE WHEN b IN ('MANHATTAN',
      'BROOKLYN') THEN 'Core Boroughs' WHEN b IN ('QUEENS', 'BRONX', 'STATEN ISLAND') THEN 'Outer Boroughs' ELSE 'Other' END AS borough_category,
    CASE WHEN z[:3] IN ('100', '101', '102') THEN 'Manhattan' ELSE 'Other' END AS zip_region, TRUE AS has_zip, TRUE AS is_specified, 'Complete' AS data_quality FROM loc"""
)
def dim_location(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)[1].location


@query(
    f"""{FACT} SELECT DISTINCT complaint_type_key, complaint_type, descriptor, complaint_category, FALSE AS is_malicious_data, FALSE AS is_test_data FROM fct"""
)
def dim_type(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)[1].kind


FACT_COLUMNS = """unique_key, agency_key, location_key, complaint_type_key, created_date_key, closed_date_key, borough, city, agency_code, complaint_type,
  descriptor, created_year, created_month, created_hour, is_business_hours,
    is_created_on_weekend, is_created_on_holiday, is_created_on_business_day, created_fiscal_year, response_time_hours, response_time_days, response_sla_category,
      status, is_closed, has_resolution, has_invalid_closed_date,
    has_historical_closed_date, has_future_closed_date, has_closed_status_without_date, open_status_with_closed_date"""


@query(f"{FACT} SELECT {FACT_COLUMNS} FROM fct")
def fact_core(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)[0].select(*[c.strip() for c in FACT_COLUMNS.split(",")])


@query(f"{FACT} SELECT response_sla_category, count(*) AS n, round(avg(response_time_hours), 2) AS mean_hours, round(max(response_time_days), 2) AS longest_days FROM fct GROUP BY 1")
def response_sla(spark: SparkSession, sf: str) -> DataFrame:
    return star(spark, sf)[0].groupBy("response_sla_category").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("response_time_hours"), 2).alias("mean_hours"), F.round(F.max("response_time_days"), 2).alias("longest_days"))


@query(f"{FACT} SELECT created_hour, is_business_hours, count(*) AS n FROM fct GROUP BY ALL")
def business_hours(spark: SparkSession, sf: str) -> DataFrame:
    return contract(spark, sf).groupBy(F.hour("created_date").alias("created_hour"), facts.business_hours().alias("is_business_hours")).agg(F.count(F.lit(1)).alias("n"))


CORE = """count(*) AS total_complaints, count(*) FILTER (is_closed) AS closed, avg(vh) AS avg_hours, quantile_disc(vh, 0.5) AS median_hours, count(vh) AS valid_response_count,
    count(*) FILTER (sla IN ('SAME_DAY', 'WITHIN_WEEK')) AS within_sla_count, count(sla) AS total_valid_closed_for_sla, count(*) FILTER (is_closed AND vh IS NULL) AS closed_without_valid_time,
    count(*) FILTER (is_closed AND sla IS NULL) AS closed_without_valid_sla, count(*) FILTER (status = 'OPEN') AS opened, count(*) FILTER (status = 'PENDING') AS pending"""


def sql_top(by: str, name: str, n: int, prefix: str, table: str = "v") -> str:
    parts = ", ".join(f"max({name}) FILTER (r = {i}) AS {prefix}_{i}, max(n) FILTER (r = {i}) AS {prefix}_{i}_count" for i in range(1, n + 1))
    return f"(SELECT {by}, {parts} FROM (SELECT {by}, {name}, count(*) AS n, row_number() OVER (PARTITION BY {by} ORDER BY count(*) DESC, {name}) AS r FROM {table} GROUP BY {by}, {name}) GROUP BY {by})"


def sql_pct(a: str, b: str, times: str = "100") -> str:
    return f"round({a} * {times}::DOUBLE / nullif({b}, 0), 2)"


def sql_change(now: str, past: str) -> str:
    return f"round(({now} - {past}) * 100::DOUBLE / nullif({past}, 0), 2)"


def sql_trend(now: str, past: str, up: float, down: float, a: str, b: str) -> str:
    return f"CASE WHEN {past} IS NULL THEN 'NO_DATA' WHEN {now} > {past} * {up}::DOUBLE THEN '{a}' WHEN {now} < {past} * {down}::DOUBLE THEN '{b}' ELSE 'STABLE' END"


TOPS = lambda p, n: ", ".join(f"{p}_{i}, {p}_{i}_count" for i in range(1, n + 1))
TIMES = "round(avg_hours, 2) AS avg_response_time_hours, round(median_hours, 2) AS median_response_time_hours"


@query(
    f"""{FACT}, m AS (SELECT date_key, max(date_actual) AS date_actual, {CORE} FROM v GROUP BY 1),
    w AS (SELECT *, avg(total_complaints) OVER (ORDER BY date_key ROWS 6 PRECEDING) AS a7, avg(total_complaints) OVER (ORDER BY date_key ROWS 29 PRECEDING) AS a30,
      lag(total_complaints) OVER (ORDER BY date_key) AS d1, lag(total_complaints, 7) OVER (ORDER BY date_key) AS d7 FROM m)
    SELECT date_key, date_actual, total_complaints, total_complaints AS new_complaints, closed AS completed_count, opened AS new_count, 0::BIGINT AS in_progress_count,
      pending AS waiting_count, 0::BIGINT AS other_status_count, valid_response_count, within_sla_count,
      total_valid_closed_for_sla, closed_without_valid_time, closed_without_valid_sla, {TOPS("top_complaint_type", 3)}, {TOPS("top_agency", 3)}, coalesce(c.n,
        0) AS closed_complaints, {sql_pct("closed", "total_complaints")} AS completion_rate, 0::DOUBLE AS in_progress_rate,
      {TIMES}, {sql_pct("within_sla_count", "total_valid_closed_for_sla")} AS sla_compliance_rate, {sql_pct("closed_without_valid_time", "closed")} AS pct_closed_missing_valid_time,
        round(a7, 2) AS complaints_7day_avg, round(a30, 2) AS complaints_30day_avg,
      {sql_change("total_complaints", "d1")} AS day_over_day_change_pct, {sql_change("total_complaints", "d7")} AS week_over_week_change_pct, {sql_trend("total_complaints", "d1", 1.1, 0.9, "UP", "DOWN")} AS trend_direction
    FROM w LEFT JOIN (SELECT closed_date_key AS date_key, count(*) AS n FROM v WHERE is_closed GROUP BY 1) c USING (date_key) LEFT JOIN {sql_top("date_key", "complaint_type", 3, "top_complaint_type")} USING (date_key) LEFT JOIN {sql_top("date_key", "agency_code", 3, "top_agency")} USING (date_key)"""
)
def daily_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_daily(*star(spark, sf))


@query(f"{FACT} SELECT * FROM {sql_top('date_key', 'complaint_type', 3, 'top_complaint_type')}")
def top_types_daily(spark: SparkSession, sf: str) -> DataFrame:
    return top_n(marts.counts(marts.by_day(*star(spark, sf)), ["date_key"], "complaint_type"), ["date_key"], "complaint_type", "n", 3, "top_complaint_type")


BACKLOG = f"(SELECT agency_key, count(*) AS backlog_count, avg(DATE '{AS_OF}' - date_actual) AS avg_open_days, {AS_OF.replace('-', '')} AS date_key FROM v WHERE NOT is_closed GROUP BY 1)"


@query(f"{FACT} SELECT agency_key, backlog_count, round(avg_open_days, 4) AS avg_open_days, date_key::INT AS date_key FROM {BACKLOG}")
def agency_backlog(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agency_backlog(*star(spark, sf), AS_OF).withColumn("avg_open_days", F.round("avg_open_days", 4))


AGENCY = f"""{FACT}, m AS (SELECT date_key, agency_key, max(agency_code) AS agency_name, {CORE}, count(*) FILTER (is_closed AND vh <= 24) AS same_day, count(*) FILTER (has_resolution AND vh <= 48) AS touched FROM v GROUP BY 1,
  2),
    w AS (SELECT *, sum(total_complaints) OVER (PARTITION BY date_key)::BIGINT AS of_day, avg(total_complaints) OVER (PARTITION BY agency_key ORDER BY date_key ROWS 6 PRECEDING) AS a7,
      lag(total_complaints, 7) OVER (PARTITION BY agency_key ORDER BY date_key) AS d7,
      row_number() OVER (PARTITION BY date_key ORDER BY total_complaints DESC, agency_key)::INT AS agency_rank_by_volume,
      row_number() OVER (PARTITION BY date_key ORDER BY CASE WHEN total_valid_closed_for_sla > 0 THEN within_sla_count / total_valid_closed_for_sla ELSE 0 END DESC,
        agency_key)::INT AS agency_rank_by_sla FROM m)"""


@query(
    f"""{AGENCY} SELECT date_key, agency_key, agency_name, 'Other' AS agency_category, total_complaints, total_complaints AS new_complaints, closed AS closed_complaints,
      0::BIGINT AS in_progress_complaints, pending AS pending_complaints, valid_response_count, total_valid_closed_for_sla,
      closed_without_valid_time, closed_without_valid_sla, {TOPS("top_complaint_category", 3)}, agency_rank_by_volume, agency_rank_by_sla, {TIMES}, {sql_pct("within_sla_count", "total_valid_closed_for_sla")} AS sla_compliance_rate,
        {sql_pct("same_day", "closed")} AS same_day_resolution_rate,
      {sql_pct("touched", "total_complaints")} AS first_touch_resolution_rate, {sql_pct("closed_without_valid_time", "closed")} AS pct_closed_missing_valid_time,
        {sql_pct("total_complaints", "of_day")} AS pct_of_total_daily_complaints, {sql_pct("total_complaints", "a7", "1")} AS workload_index,
      round(a7, 2) AS complaints_7day_avg, {sql_trend("total_complaints", "d7", 1.1, 0.9, "UP", "DOWN")} AS trend_direction, coalesce(avg_open_days, 0) AS avg_open_days,
        coalesce(backlog_count, 0) AS backlog_count,
      round((closed * 100::DOUBLE / total_complaints) * (within_sla_count * 100::DOUBLE / nullif(total_valid_closed_for_sla, 0)) / 100, 2) AS productivity_score
    FROM w LEFT JOIN {sql_top("date_key, agency_key", "complaint_category", 3, "top_complaint_category")} USING (date_key, agency_key) LEFT JOIN {BACKLOG} USING (date_key, agency_key)"""
)
def agency_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_agency(*star(spark, sf), AS_OF)


@query(f"{AGENCY} SELECT date_key, agency_key, total_complaints, agency_rank_by_volume, agency_rank_by_sla FROM w WHERE agency_rank_by_volume <= 2")
def agency_rank(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_agency(*star(spark, sf), AS_OF).where("agency_rank_by_volume <= 2").select("date_key", "agency_key", "total_complaints", "agency_rank_by_volume", "agency_rank_by_sla")


LOCATION = f"""{FACT}, m AS (SELECT date_key, location_key, max(borough) AS borough, max(city) AS city, {CORE} FROM v GROUP BY 1, 2),
    w AS (SELECT *, avg(total_complaints) OVER (PARTITION BY location_key ORDER BY date_key ROWS 6 PRECEDING) AS a7, lag(total_complaints, 7) OVER o AS d7,
      lag(total_complaints) OVER o AS d1, avg(total_complaints) OVER a AS mean, sum(total_complaints) OVER a AS of_area,
      count(*) OVER a AS locations_in_borough, row_number() OVER (PARTITION BY date_key, borough ORDER BY total_complaints DESC, location_key)::INT AS borough_rank_daily,
        row_number() OVER (PARTITION BY date_key, borough, city ORDER BY total_complaints DESC, location_key)::INT AS city_rank_in_borough,
      row_number() OVER (PARTITION BY date_key ORDER BY total_complaints DESC, location_key)::INT AS citywide_rank FROM m WINDOW o AS (PARTITION BY location_key ORDER BY date_key),
        a AS (PARTITION BY date_key, borough))"""
SEVERITY = "CASE WHEN total_complaints > mean * 2 THEN 'HIGH' WHEN total_complaints > mean * 1.5::DOUBLE THEN 'MEDIUM' WHEN total_complaints > mean * 1.2::DOUBLE THEN 'LOW' ELSE 'NORMAL' END"


@query(
    f"""{LOCATION} SELECT date_key, location_key, borough, city, z AS zip_code, total_complaints, opened AS open_complaints, closed AS closed_complaints,
      total_complaints AS new_complaints, valid_response_count, total_valid_closed_for_sla, closed_without_valid_time, {TOPS("top_complaint_type", 3)},
      borough_rank_daily, city_rank_in_borough, citywide_rank, locations_in_borough, {TIMES}, {sql_pct("within_sla_count", "total_valid_closed_for_sla")} AS sla_compliance_rate,
        {sql_pct("closed", "total_complaints")} AS completion_rate, {sql_pct("closed_without_valid_time", "closed")} AS pct_closed_missing_valid_time,
      round(a7, 2) AS complaints_7day_avg, {sql_change("total_complaints", "d7")} AS complaints_vs_prev_week_pct, {sql_change("total_complaints", "d1")} AS complaints_vs_prev_day_pct,
        total_complaints > mean * 1.5::DOUBLE AS is_hotspot, {SEVERITY} AS hotspot_severity,
      round(mean, 2) AS borough_avg_complaints, {sql_pct("total_complaints", "mean")} AS pct_of_borough_avg, {sql_pct("total_complaints", "of_area")} AS pct_of_borough_total,
        {sql_trend("total_complaints", "d7", 1.2, 0.8, "INCREASING", "DECREASING")} AS trend_direction,
      CASE WHEN abs(total_complaints - a7) > a7 * 0.3::DOUBLE THEN 'HIGH_VARIANCE' WHEN abs(total_complaints - a7) > a7 * 0.15::DOUBLE THEN 'MEDIUM_VARIANCE' ELSE 'LOW_VARIANCE' END AS volatility
    FROM w JOIN loc ON location_id = location_key LEFT JOIN {sql_top("date_key, location_key", "complaint_type", 3, "top_complaint_type")} USING (date_key, location_key)"""
)
def location_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_location(*star(spark, sf))


@query(f"{LOCATION} SELECT date_key, location_key, total_complaints, {SEVERITY} AS hotspot_severity FROM w WHERE total_complaints > mean * 1.5::DOUBLE")
def hotspots(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_location(*star(spark, sf)).where("is_hotspot").select("date_key", "location_key", "total_complaints", "hotspot_severity")




@query(
    f"""{FACT}, am AS (SELECT date_key, complaint_type_key, agency_code AS most_common_agency FROM v GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY date_key,
      complaint_type_key ORDER BY count(*) DESC, agency_code) = 1),
    bm AS (SELECT date_key, complaint_type_key, borough AS most_common_borough FROM v GROUP BY 1, 2, 3 QUALIFY row_number() OVER (PARTITION BY date_key, complaint_type_key ORDER BY count(*) DESC, borough) = 1)
    SELECT date_key, complaint_type_key, max(date_actual) AS date_actual, max(complaint_type) AS complaint_type, max(descriptor) AS descriptor, max(complaint_category) AS complaint_category,
      count(*) AS total_complaints, count(*) FILTER (is_closed) AS closed_complaints,
      round(avg(vh), 6) AS avg_response_time_hours, quantile_disc(vh, 0.5) AS median_response_time_hours, count(vh) AS valid_response_count, max(most_common_agency) AS most_common_agency,
        max(most_common_borough) AS most_common_borough
    FROM v JOIN am USING (date_key, complaint_type_key) JOIN bm USING (date_key, complaint_type_key) GROUP BY 1, 2"""
)
def type_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_type(*star(spark, sf)).withColumn("avg_response_time_hours", F.round("avg_response_time_hours", 6))


MONTH = f"""{FACT}, mv AS (SELECT *, (year * 100 + month)::INT AS month_key FROM v),
    m AS (SELECT month_key, year, month, monthname(min(date_actual)) AS month_name, min(date_actual) AS month_start_date, max(date_actual) AS month_end_date,
      {CORE}, count(DISTINCT date_actual) AS days_in_month FROM mv GROUP BY 1, 2, 3),
    g AS (SELECT m.*, p.total_complaints AS pt, p.valid_response_count AS pv, y.total_complaints AS yt, y.valid_response_count AS yv, avg(m.total_complaints) OVER t AS t3,
      avg(m.closed) OVER t AS c3, avg(m.valid_response_count) OVER t AS v3
      FROM m LEFT JOIN m p ON p.year * 12 + p.month + 1 = m.year * 12 + m.month LEFT JOIN m y ON y.year + 1 = m.year AND y.month = m.month WINDOW t AS (ORDER BY m.month_key ROWS 2 PRECEDING)),
    e AS (SELECT month_key, nullif(count(*) FILTER (status = 'OPEN'), 0) AS open_at_end FROM mv JOIN (SELECT month_key, max(date_actual) AS d FROM mv GROUP BY 1) x USING (month_key) WHERE date_actual = d GROUP BY 1)"""


def sql_sum3(p: str) -> str:
    return "(" + " + ".join(f"coalesce({p}_{i}_count, 0)" for i in (1, 2, 3)) + ")"


@query(
    f"""{MONTH} SELECT month_key, year, month, month_name, month_start_date, month_end_date, days_in_month, total_complaints, closed AS completed_complaints,
      opened AS open_complaints, 0::BIGINT AS in_progress_complaints, pending AS pending_complaints, valid_response_count, total_valid_closed_for_sla,
      closed_without_valid_time, {TOPS("top_complaint_category", 5)}, {", ".join(f"top_agency_{i} AS top_agency_{i}_code, top_agency_{i} AS top_agency_{i}_name, top_agency_{i}_count" for i in (1, 2, 3))},
        {sql_pct("total_complaints", "days_in_month", "1")} AS avg_daily_complaints,
      coalesce(open_at_end, opened) AS open_complaints_eom, {TIMES}, {sql_pct("within_sla_count", "total_valid_closed_for_sla")} AS sla_compliance_rate,
        {sql_pct("closed", "total_complaints")} AS completion_rate, {sql_pct("closed_without_valid_time", "closed")} AS pct_closed_missing_valid_time,
      {sql_pct("total_complaints", "closed", "1")} AS completion_ratio, {sql_pct("opened", "total_complaints")} AS open_rate, 0::DOUBLE AS in_progress_rate,
        coalesce(pt, 0) AS total_complaints_prev_month, {sql_change("total_complaints", "pt")} AS mom_growth_rate, total_complaints - coalesce(pt, 0) AS mom_growth_absolute,
      coalesce(pv, 0) AS valid_response_count_prev_month, {sql_change("valid_response_count", "pv")} AS mom_valid_data_growth_rate, coalesce(yt, 0) AS total_complaints_prev_year,
        {sql_change("total_complaints", "yt")} AS yoy_growth_rate, total_complaints - coalesce(yt, 0) AS yoy_growth_absolute,
      {sql_trend("total_complaints", "yt", 1.1, 0.9, "GROWTH", "DECLINE")} AS yoy_trend, coalesce(yv, 0) AS valid_response_count_prev_year, {sql_change("valid_response_count", "yv")} AS yoy_valid_data_growth_rate,
        round(t3, 2) AS complaints_3month_avg, round(c3, 2) AS completed_3month_avg,
      round(v3, 2) AS valid_responses_3month_avg, {sql_pct(sql_sum3("top_complaint_category"), "total_complaints")} AS top_3_categories_pct, {sql_pct(sql_sum3("top_agency"), "total_complaints")} AS top_3_agencies_pct
    FROM g LEFT JOIN e USING (month_key) LEFT JOIN {sql_top("month_key", "complaint_category", 5, "top_complaint_category", "mv")} USING (month_key) LEFT JOIN {sql_top("month_key", "agency_code", 3, "top_agency", "mv")} USING (month_key)"""
)
def monthly_summary(spark: SparkSession, sf: str) -> DataFrame:
    return marts.agg_monthly(*star(spark, sf))


@query(f"{MONTH} SELECT month_key, total_complaints, pt AS total_prev_month, {sql_change('total_complaints', 'pt')} AS mom_growth_rate, yt AS total_prev_year, {sql_change('total_complaints', 'yt')} AS yoy_growth_rate FROM g")
def mom_yoy(spark: SparkSession, sf: str) -> DataFrame:
    months = marts.monthly_core(*star(spark, sf))
    out = marts.shifted(marts.shifted(months, 1, {"total_complaints": "total_prev_month"}), 12, {"total_complaints": "total_prev_year"})
    return out.select("month_key", "total_complaints", "total_prev_month", marts.change("total_complaints", "total_prev_month").alias("mom_growth_rate"), "total_prev_year", marts.change("total_complaints", "total_prev_year").alias("yoy_growth_rate"))


@query(f"{MONTH} SELECT month_key, open_at_end FROM e")
def month_end_open(spark: SparkSession, sf: str) -> DataFrame:
    return marts.month_end_open(*star(spark, sf))


COUNTED = {"noise": "complaint_category = 'Noise'", "transportation": "complaint_category = 'Transportation'", "housing": "complaint_category = 'Building & Housing'", "sanitation": "FALSE", "quality_of_life": "FALSE", "covid_specific": "FALSE", "residential_noise": "contains(complaint_type, 'NOISE - RESIDENTIAL')", "outdoor_dining": "FALSE", "illegal_parking": "contains(complaint_type, 'ILLEGAL PARKING')"}
PERIOD = f"""{FACT}, b AS (SELECT *, nullif(sla, 'OPEN') AS sl, CASE WHEN date_actual < DATE '{CUTS[0]}' THEN 'Pre-COVID' WHEN date_actual <= DATE '{CUTS[1]}' THEN 'COVID Peak' ELSE 'Post-COVID' END AS covid_period FROM v WHERE year BETWEEN {YEARS[0]} AND {YEARS[1]}),
    mi AS (SELECT year, month, covid_period, monthname(min(date_actual)) AS month_name, count(*) AS total_complaints, count(*) FILTER (is_closed) AS closed_complaints,
      count(vh) AS complaints_with_valid_response_time, avg(vh) AS avg_response_time_hours, avg(vd) AS avg_response_time_days,
      quantile_disc(vh, 0.5) AS median_response_time_hours, quantile_disc(vd, 0.5) AS median_response_time_days, {", ".join(f"round(count(*) FILTER (sl = '{s}') * 100::DOUBLE / nullif(count(sl), 0), 2) AS {n}" for n, s in impact.SLA.items())},
        count(sl) AS total_valid_for_sla,
      count(*) FILTER (has_invalid_closed_date) AS invalid_closed_dates, count(*) FILTER (has_closed_status_without_date) AS closed_without_date, count(*) FILTER (open_status_with_closed_date) AS open_with_closed_date,
      {sql_pct("count(vh)", "count(*) FILTER (is_closed)")} AS response_time_data_quality_pct, {", ".join(f"count(*) FILTER ({c}) AS {n}_complaints" for n, c in COUNTED.items())} FROM b GROUP BY 1, 2, 3),
    pb AS (SELECT month, {", ".join(f"avg({c}) AS {n}" for n, c in impact.BASELINE.items())} FROM mi WHERE year = {BASE_YEAR} AND covid_period = 'Pre-COVID' GROUP BY 1)"""
ROUNDED = ["avg_response_time_hours", "avg_response_time_days", *impact.BASELINE, "volume_change_absolute"]


@query(
    f"""{PERIOD} SELECT year, month, month_name, covid_period, total_complaints, closed_complaints, complaints_with_valid_response_time, round(avg_response_time_hours,
      6) AS avg_response_time_hours, round(avg_response_time_days, 6) AS avg_response_time_days, median_response_time_hours, median_response_time_days,
      {", ".join(impact.SLA)}, total_valid_for_sla, invalid_closed_dates, closed_without_date, open_with_closed_date, response_time_data_quality_pct, {", ".join(f"{n}_complaints" for n in COUNTED)},
        {", ".join(f"round({n}, 6) AS {n}" for n in impact.BASELINE)},
      {sql_change("total_complaints", "baseline_monthly_complaints")} AS volume_change_pct, round(total_complaints - coalesce(baseline_monthly_complaints,
        0), 6) AS volume_change_absolute, {sql_pct("closed_complaints", "total_complaints")} AS closure_rate,
      {sql_change("avg_response_time_hours", "baseline_response_time_hours")} AS response_time_hours_change_pct, {sql_change("avg_response_time_days", "baseline_response_time_days")} AS response_time_days_change_pct,
        round(same_day_closure_rate - baseline_same_day_rate, 2) AS same_day_rate_change_points,
      round(within_week_rate - baseline_within_week_rate, 2) AS within_week_rate_change_points, {sql_pct("invalid_closed_dates", "total_complaints")} AS invalid_date_pct,
        {sql_change("noise_complaints", "baseline_noise_complaints")} AS noise_change_pct,
      {sql_change("transportation_complaints", "baseline_transportation_complaints")} AS transportation_change_pct, {", ".join(sql_pct(f"{n}_complaints", "total_complaints") + f" AS {n}_mix_pct" for n in impact.CATEGORIES)},
      CASE WHEN noise_complaints > coalesce(baseline_noise_complaints, 0) * 1.3::DOUBLE THEN 'High Noise Period' WHEN transportation_complaints < coalesce(baseline_transportation_complaints,
        transportation_complaints) * 0.7::DOUBLE THEN 'Low Transit Period'
        WHEN total_complaints < coalesce(baseline_monthly_complaints, total_complaints) * 0.85::DOUBLE THEN 'Low Activity Period' WHEN residential_noise_complaints > noise_complaints * 0.5::DOUBLE THEN 'WFH Impact High' ELSE 'Normal Pattern' END AS covid_pattern_indicator,
      CASE WHEN transportation_complaints > 1 THEN round(noise_complaints / transportation_complaints, 2) END AS wfh_impact_score, CASE WHEN month IN (12,
        1, 2) THEN 'Winter' WHEN month < 6 THEN 'Spring' WHEN month < 9 THEN 'Summer' ELSE 'Fall' END AS season,
      CASE covid_period WHEN 'Pre-COVID' THEN 'Baseline' WHEN 'Post-COVID' THEN 'New Normal' ELSE CASE WHEN year = 1998 AND month BETWEEN 3 AND 6 THEN 'Lockdown Phase' WHEN year = 1998 AND month >= 7 THEN 'Early Recovery' WHEN year = 1999 THEN 'Late Recovery' END END AS covid_phase
    FROM mi LEFT JOIN pb USING (month)"""
)
def period_impact(spark: SparkSession, sf: str) -> DataFrame:
    out = impact.period_impact(*star(spark, sf), CUTS, YEARS, BASE_YEAR)
    return out.withColumns({c: F.round(c, 6) for c in ROUNDED})


def sql_impact(column: str) -> str:
    share = lambda c: f"round(count(*) FILTER (complaint_category = '{c}') * 100::DOUBLE / count(*), 2)"
    return f"""{PERIOD} SELECT {column}, covid_period, count(*) AS complaints_count, count(*) FILTER (is_closed) AS closed_count, {sql_pct("count(*) FILTER (is_closed)", "count(*)")} AS closure_rate,
      round(avg(vh), 2) AS avg_response_time_hours, round(avg(vd), 2) AS avg_response_time_days,
      count(*) FILTER (complaint_category = 'Noise') AS noise_count, {share("Noise")} AS noise_percentage, count(*) FILTER (complaint_category = 'Transportation') AS transportation_count,
        {share("Transportation")} AS transportation_percentage,
      {sql_pct("count(*) FILTER (sl = 'SAME_DAY')", "count(sl)")} AS same_day_rate FROM b GROUP BY 1, 2"""


def study(spark: SparkSession, sf: str) -> DataFrame:
    return impact.labelled(*star(spark, sf), CUTS, YEARS)


@query(sql_impact("borough"))
def impact_by_area(spark: SparkSession, sf: str) -> DataFrame:
    return impact.impact_by(study(spark, sf), "borough", "UNSPECIFIED")


@query(sql_impact("agency_code"))
def impact_by_agency(spark: SparkSession, sf: str) -> DataFrame:
    return impact.impact_by(study(spark, sf), "agency_code", "UNKNOWN")


@query(
    f"""{PERIOD} SELECT covid_period, complaint_type, count(*) AS complaint_count, count(*) FILTER (is_closed) AS closed_count, round(avg(vd), 2) AS avg_days_to_close,
      row_number() OVER (PARTITION BY covid_period ORDER BY count(*) DESC, complaint_type)::INT AS rank_in_period
    FROM b GROUP BY 1, 2 QUALIFY rank_in_period <= 3"""
)
def top_types_by_period(spark: SparkSession, sf: str) -> DataFrame:
    return impact.top_types_by_period(study(spark, sf), 3)


@query(
    f"""{FACT}, d AS (SELECT date_actual AS ds, count(*) AS y, max(date_key) AS date_key, max(year) AS year, max(month) AS month, max(is_weekend::INT) AS is_weekend,
      (max(holiday_name) IS NOT NULL)::INT AS is_holiday, max(holiday_name) AS holiday_name, count(*) FILTER (is_closed) AS closed_complaints,
      count(*) FILTER (status = 'OPEN') AS in_progress_count, avg(response_time_hours) AS h FROM v WHERE date_actual >= DATE '1996-01-01' GROUP BY 1),
    w AS (SELECT *, avg(y) OVER (ORDER BY ds ROWS 6 PRECEDING) AS a7, avg(y) OVER (ORDER BY ds ROWS 29 PRECEDING) AS a30, stddev_samp(y) OVER (ORDER BY ds ROWS 29 PRECEDING) AS s30,
      lag(y) OVER o AS lag_1day, lag(y, 7) OVER o AS lag_7day, lag(y, 30) OVER o AS lag_30day, lag(y, 365) OVER o AS lag_365day FROM d WINDOW o AS (ORDER BY ds))
    SELECT ds, y, date_key, year, month, is_weekend, is_holiday, (is_weekend = 0 AND is_holiday = 0)::INT AS is_business_day, holiday_name, CASE WHEN month IN (12,
      1, 2) THEN 'Winter' WHEN month < 6 THEN 'Spring' WHEN month < 9 THEN 'Summer' ELSE 'Fall' END AS season, y AS total_complaints, closed_complaints,
      in_progress_count, {sql_pct("closed_complaints", "y")} AS closure_rate, {sql_pct("in_progress_count", "closed_complaints", "1")} AS workload_ratio,
        round(h, 2) AS avg_response_time_hours, round(a7, 2) AS rolling_7day_avg, round(a30, 2) AS rolling_30day_avg, lag_1day, lag_7day, lag_30day, lag_365day,
      round(s30, 2) AS rolling_30day_std, (month IN (7, 8))::INT AS is_summer_break, (month >= 10 OR month <= 3)::INT AS is_heating_season, (month IN (1,
        2, 7, 8))::INT AS is_extreme_weather_month, is_holiday AS is_near_holiday, {sql_change("y", "lag_7day")} AS week_over_week_change_pct,
      CASE WHEN s30 > 0 THEN round((y - a30) / s30, 3) END AS z_score_30day FROM w"""
)
def forecast_features(spark: SparkSession, sf: str) -> DataFrame:
    return features.forecast_features(*star(spark, sf), "1996-01-01")


@query(f"{REQUESTS} SELECT unique_key, created_date::DATE AS created_day, agency, borough, complaint_type FROM req")
def requests_view(spark: SparkSession, sf: str) -> DataFrame:
    return contract(spark, sf).select("unique_key", F.to_date("created_date").alias("created_day"), "agency", "borough", "complaint_type")
