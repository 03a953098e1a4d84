"""Queries of the checks and of the forecasts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators import checks as K
from quern.operators import forecast as P
from quern.functions.shared import stored
from quern.operators.features import forecast_features
from quern.operators.marts import agg_daily, by_day
from quern.operators.silver import BOUNDS
from quern.operators.sketches import COUNTS as SKETCH_COUNTS
from quern.operators.sketches import day_sketches, quarter, rank_errors, rolled_up
from quern.plans import marts as M
from quern.plans.cleaning import STEPS, cleaned
from quern.plans.views import AS_OF, CAL, FACT, half_up, star
from quern.sources.landing import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = half_up(sql)
        return f

    return register


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return K.unique(load(spark, sf, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT o_orderkey FROM orders ANTI JOIN lineitem ON l_orderkey = o_orderkey")
def check_fk(spark: SparkSession, sf: str) -> DataFrame:
    return K.relationships(load(spark, sf, "orders"), "o_orderkey", load(spark, sf, "lineitem"), "l_orderkey").select("o_orderkey")


@query(f"{FACT} SELECT count(*) FILTER (status = 'PENDING') AS n, count(*) AS total, round(count(*) FILTER (status = 'PENDING') * 100::DOUBLE / count(*), 2) AS share FROM fct HAVING count(*) FILTER (status = 'PENDING') * 100::DOUBLE / count(*) > 2")
def check_share(spark: SparkSession, sf: str) -> DataFrame:
    return K.share_over(star(spark, sf)[0], F.col("status") == "PENDING", 2.0)


@query(f"{FACT}, days AS (SELECT DISTINCT date_actual AS d FROM v) SELECT date_actual AS day FROM cal WHERE date_actual BETWEEN (SELECT min(d) FROM days) AND (SELECT max(d) FROM days) AND date_actual NOT IN (SELECT d FROM days)")
def check_gaps(spark: SparkSession, sf: str) -> DataFrame:
    facts, dims = star(spark, sf)
    days = facts.join(dims.date.select(F.col("date_key").alias("created_date_key"), F.col("date_actual").alias("day")), "created_date_key").select("day").distinct()
    return K.date_gaps(days, "day")


SUITE: list[K.Check | K.Rule] = [
    K.Check("unique_key_unique", "error", lambda t: K.unique(t["fact"], "unique_key")),
    K.Rule("keys_not_null", "error", "fact", lambda: K.nulls("unique_key", "agency_key", "location_key", "created_date_key")),
    K.Rule("status_accepted", "warn", "fact", lambda: ~F.col("status").isin("OPEN", "CLOSED")),
    K.Check("agency_known", "error", lambda t: K.relationships(t["fact"], "agency_key", t["agency"], "agency_id")),
    K.Rule("hour_in_range", "error", "fact", lambda: K.outside("created_hour", 0, 23)),
    K.Rule("response_not_negative", "error", "fact", lambda: ~(F.col("response_time_hours") >= 0)),
    K.Rule("closed_after_created", "error", "fact", lambda: F.col("closed_date_key") < F.col("created_date_key")),
    K.Rule("hours_match_days", "error", "fact", lambda: F.abs(F.col("response_time_hours") / 24 - F.col("response_time_days")) > 1),
    K.Check("area_matches", "error", lambda t: K.mismatched(t["fact"], "borough", "location_key", t["location"], "location_id", "borough")),
    K.Rule("closed_has_time", "error", "fact", K.untimed),
    K.Rule("closed_has_time_unless_flagged", "error", "fact", lambda: K.untimed(True)),
    K.Rule("null_keys", "warn", "fact", lambda: K.nulls("agency_key", "location_key", "complaint_type_key")),
    K.Check("expected_agencies", "warn", lambda t: K.missing_members(t["agency"], "agency_key", ["BUILDING", "MACHINERY", "NOWHERE"])),
    K.Rule("not_too_long", "warn", "fact", lambda: F.col("response_time_days") > 730),
    K.Check("date_gaps", "error", lambda t: K.date_gaps(t["date"], "date_actual")),
    K.Rule("coordinates", "error", "silver", lambda: K.out_of_bounds(BOUNDS)),
]

#: What holds in a table of forecast features, and in the daily summary that it goes with.
FEATURE_SUITE: list[K.Check | K.Rule] = [
    K.Check("ds_unique", "error", lambda t: K.unique(t["features"], "ds")),
    K.Rule("features_not_null", "error", "features", lambda: K.nulls("ds", "y", "date_key", "season", "is_weekend", "is_holiday")),
    K.Rule("volume_in_range", "error", "features", lambda: K.outside("y", 0, 50_000)),
    K.Rule("volume_likely", "warn", "features", lambda: K.outside("y", 2)),
    K.Rule("closure_in_range", "error", "features", lambda: K.outside("closure_rate", 0, 100)),
    K.Rule("flags_accepted", "error", "features", lambda: ~(F.col("is_weekend").isin(0, 1) & F.col("is_holiday").isin(0, 1) & F.col("is_business_day").isin(0, 1))),
    K.Rule("season_accepted", "error", "features", lambda: ~F.col("season").isin("Winter", "Spring", "Summer", "Fall")),
    K.Rule("response_not_negative", "error", "features", lambda: F.col("avg_response_time_hours") < 0),
    K.Rule("closed_within_total", "error", "features", lambda: F.col("closed_complaints") > F.col("total_complaints")),
    K.Rule("lag_after_a_week", "warn", "features", lambda: F.col("lag_7day").isNull()),
    K.Check("day_unique", "error", lambda t: K.unique(t["daily"], "date_key")),
    K.Rule("within_valid_closed", "error", "daily", lambda: ~((F.col("within_sla_count") <= F.col("total_valid_closed_for_sla")) & (F.col("valid_response_count") <= F.col("completed_count")))),
    K.Rule("service_level_in_range", "error", "daily", lambda: K.outside("sla_compliance_rate", 0, 100)),
]

COUNTS = {
    "unique_key_unique": "SELECT count(*) - count(DISTINCT unique_key) FROM fct", "keys_not_null": "SELECT count(*) FROM fct WHERE unique_key IS NULL OR agency_key IS NULL OR location_key IS NULL OR created_date_key IS NULL", "status_accepted": "SELECT count(*) FROM fct WHERE status = 'PENDING'", "agency_known": "SELECT count(*) FROM fct WHERE agency_key NOT IN (SELECT agency_id FROM ag)", "hour_in_range": "SELECT count(*) FROM fct WHERE created_hour NOT BETWEEN 0 AND 23", "response_not_negative": "SELECT count(*) FROM fct WHERE response_time_hours < 0",
    "closed_after_created": "SELECT count(*) FROM fct WHERE closed_date_key < created_date_key", "hours_match_days": "SELECT count(*) FROM fct WHERE abs(response_time_hours / 24 - response_time_days) > 1", "area_matches": "SELECT count(*) FROM fct JOIN loc ON location_id = location_key WHERE fct.borough <> loc.b",
    "closed_has_time": "SELECT count(*) FROM fct WHERE is_closed AND response_time_hours IS NULL", "closed_has_time_unless_flagged": "SELECT count(*) FROM fct WHERE is_closed AND response_time_hours IS NULL AND NOT (has_invalid_closed_date OR has_historical_closed_date OR has_future_closed_date)", "null_keys": "SELECT count(*) FROM fct WHERE agency_key IS NULL OR location_key IS NULL OR complaint_type_key IS NULL", "expected_agencies": "SELECT 3 - count(*) FROM ag WHERE agency_code IN ('BUILDING', 'MACHINERY', 'NOWHERE')",
    "not_too_long": "SELECT count(*) FROM fct WHERE response_time_days > 730", "date_gaps": "SELECT max(date_actual) - min(date_actual) + 1 - count(DISTINCT date_actual) FROM hol", "coordinates": f"{STEPS} SELECT count(*) FROM f WHERE has_valid_location AND NOT (latitude BETWEEN 40.477399 AND 40.917577 AND longitude BETWEEN -74.259090 AND -73.700009)",
}


@query(
    f"{FACT}, c AS ("
    + " UNION ALL ".join(f"SELECT '{c.name}' AS check_name, '{c.severity}' AS severity, ({COUNTS[c.name]})::BIGINT AS violations" for c in SUITE)
    + ") SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE severity END AS status FROM c"
)
def check_suite(spark: SparkSession, sf: str) -> DataFrame:
    facts, dims = star(spark, sf)
    return K.run_checks({"fact": facts, "agency": dims.agency, "location": dims.location, "date": dims.date, "silver": cleaned(spark, sf)}, SUITE)


FEATURE_COUNTS = {
    "ds_unique": "SELECT count(*) - count(DISTINCT ds) FROM ff", "features_not_null": "SELECT count(*) FROM ff WHERE ds IS NULL OR y IS NULL OR date_key IS NULL OR season IS NULL OR is_weekend IS NULL OR is_holiday IS NULL",
    "volume_in_range": "SELECT count(*) FROM ff WHERE y < 0 OR y > 50000", "volume_likely": "SELECT count(*) FROM ff WHERE y < 2", "closure_in_range": "SELECT count(*) FROM ff WHERE closure_rate NOT BETWEEN 0 AND 100",
    "flags_accepted": "SELECT count(*) FROM ff WHERE is_weekend NOT IN (0, 1) OR is_holiday NOT IN (0, 1) OR is_business_day NOT IN (0, 1)", "season_accepted": "SELECT count(*) FROM ff WHERE season NOT IN ('Winter', 'Spring', 'Summer', 'Fall')",
    "response_not_negative": "SELECT count(*) FROM ff WHERE avg_response_time_hours < 0", "closed_within_total": "SELECT count(*) FROM ff WHERE closed_complaints > total_complaints", "lag_after_a_week": "SELECT count(*) FROM ff WHERE lag_7day IS NULL",
    "day_unique": "SELECT count(*) - count(DISTINCT date_key) FROM dd", "within_valid_closed": "SELECT count(*) FROM dd WHERE within_sla_count > total_valid_closed_for_sla OR valid_response_count > completed_count",
    "service_level_in_range": "SELECT count(*) FROM dd WHERE sla_compliance_rate NOT BETWEEN 0 AND 100",
}


@query(
    f"WITH ff AS ({M.ORACLE_SQL['forecast_features']}), dd AS ({M.ORACLE_SQL['daily_summary']}), c AS ("
    + " UNION ALL ".join(f"SELECT '{c.name}' AS check_name, '{c.severity}' AS severity, ({FEATURE_COUNTS[c.name]})::BIGINT AS violations" for c in FEATURE_SUITE)
    + ") SELECT *, CASE WHEN violations = 0 THEN 'pass' ELSE severity END AS status FROM c"
)
def check_features(spark: SparkSession, sf: str) -> DataFrame:
    facts, dims = star(spark, sf)
    tables = {"features": forecast_features(facts, dims, "1996-01-01"), "daily": agg_daily(facts, dims)}
    return K.run_checks({k: stored(t, k) for k, t in tables.items()}, FEATURE_SUITE)


@query("SELECT 'labels.' || c AS column_name, n AS rows, nulls, round(nulls * 100::DOUBLE / n, 2) AS null_pct FROM (SELECT 'doc_id' AS c, count(*) AS n, count(*) - count(doc_id) AS nulls FROM labels UNION ALL SELECT 'quality', count(*), count(*) - count(quality) FROM labels UNION ALL SELECT 'toxic', count(*), count(*) - count(toxic) FROM labels)")
def column_profile(spark: SparkSession, sf: str) -> DataFrame:
    return K.profile(load(spark, sf, "labels")).withColumn("column_name", F.concat(F.lit("labels."), "column_name"))


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last, round((epoch(max(ts) + INTERVAL 26 HOUR) - epoch(max(ts))) / 3600, 2) AS age_hours, 'warn' AS status FROM events")
def source_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """As of 26 hours after the last event."""
    events = load(spark, sf, "events")
    last = events.agg(F.max("ts").cast("timestamp") + F.expr("interval 26 hours")).first()[0]
    return K.freshness(events, "ts", str(last)).withColumn("last", F.date_format("last", "yyyy-MM-dd HH:mm:ss"))


@query(f"{FACT} SELECT complaint_category, response_sla_category, count(*) AS n, count(DISTINCT agency_code) AS agencies FROM fct GROUP BY 1, 2 HAVING count(*) > 1")
def category_sla(spark: SparkSession, sf: str) -> DataFrame:
    facts, dims = star(spark, sf)
    rows = facts.join(dims.kind.select("complaint_type_key", "complaint_category"), "complaint_type_key")
    return rows.groupBy("complaint_category", "response_sla_category").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("agency_code").alias("agencies")).where("n > 1")


# ---- forecasts ----
SERIES = f"{FACT}, ser AS (SELECT date_actual AS ds, count(*) AS y FROM v WHERE date_actual >= DATE '1996-01-01' GROUP BY 1), nai AS (SELECT *, (lag(y, 7) OVER (ORDER BY ds))::DOUBLE AS yhat FROM ser)"


def series(spark: SparkSession, sf: str) -> DataFrame:
    return forecast_features(*star(spark, sf), "1996-01-01")


@query(
    f"""{SERIES} SELECT count(*) AS n, round(avg(abs(y - yhat)), 4) AS mae, round(avg(abs(y - yhat) * 200 / (y + yhat)), 4) AS smape, round(quantile_cont(abs(y - yhat) * 100 / y,
      0.5), 4) AS mdape, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
    CASE WHEN smape < 10 THEN 'excellent' WHEN smape < 15 THEN 'good' WHEN smape < 20 THEN 'acceptable' ELSE 'needs improvement' END AS readiness FROM nai WHERE yhat IS NOT NULL"""
)
def naive_forecast_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return P.accuracy(P.naive(series(spark, sf).select("ds", "y")))


@query(
    f"""{SERIES}, b AS (SELECT CASE WHEN p < 10 THEN '<10%' WHEN p < 20 THEN '10-20%' WHEN p < 50 THEN '20-50%' ELSE '>=50%' END AS bucket, count(*) AS n FROM (SELECT abs(y - yhat) * 100 / y AS p FROM nai WHERE yhat IS NOT NULL) GROUP BY 1)
    SELECT bucket, n, round(n * 100::DOUBLE / sum(n) OVER (), 2) AS pct FROM b"""
)
def error_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return P.error_buckets(P.naive(series(spark, sf).select("ds", "y")))


@query(
    f"""{SERIES}, r AS (SELECT y - yhat AS res FROM nai WHERE yhat IS NOT NULL), s AS (SELECT min(res) AS lo, max(res) AS hi FROM r)
    SELECT least(30, floor((res - lo) * 30 / (hi - lo)) + 1)::INT AS bin, count(*) AS n FROM r, s GROUP BY 1"""
)
def residual_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return P.residual_histogram(P.naive(series(spark, sf).select("ds", "y")))


@query(f"{SERIES}, big AS (SELECT * FROM ser WHERE y >= 2), st AS (SELECT avg(y) AS m, stddev_samp(y) AS sd FROM big) SELECT ds, y FROM big, st WHERE abs((y - m) / sd) <= 2")
def train_clean(spark: SparkSession, sf: str) -> DataFrame:
    return P.train_clean(series(spark, sf).select("ds", "y"), 2, 2.0)


@query(f"{SERIES}, last AS (SELECT * FROM ser ORDER BY ds DESC LIMIT 90), st AS (SELECT avg(y) AS m, stddev_samp(y) AS sd, max(ds) AS e FROM last) SELECT ds, y FROM last, st WHERE ds <= e - 3 AND (y - m) / sd >= -3")
def test_clean(spark: SparkSession, sf: str) -> DataFrame:
    return P.test_clean(P.time_split(series(spark, sf).select("ds", "y")).where("is_test").drop("is_test"))


def split(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    rows = P.fill_medians(P.time_split(series(spark, sf).select("ds", "y", *P.REGRESSORS)))
    return P.train_clean(rows.where("not is_test"), 1).drop("is_test"), P.test_clean(rows.where("is_test")).drop("is_test")


@query()
def regression_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """The last 90 days predicted from the days before."""
    train, test = split(spark, sf)
    return P.predict_regression(P.fit_regression(train), test)


@query()
def generalisation(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split(spark, sf)
    model = P.fit_regression(train)
    return P.generalisation(P.predict_regression(model, train), P.predict_regression(model, test))


@query()
def regressor_impact(spark: SparkSession, sf: str) -> DataFrame:
    return P.regressor_impact(P.fit_regression(split(spark, sf)[0]), spark, "2001-01-01")


@query()
def grouped_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """A fortnight ahead for each area."""
    return P.grouped_forecast(forecast_features(*star(spark, sf), "1996-01-01", ("borough",)), "borough")


AREAS = f"{FACT}, ser AS (SELECT date_actual AS ds, borough, count(*) AS y FROM v WHERE date_actual >= DATE '1996-01-01' GROUP BY ALL), t AS (SELECT *, (date_diff('day', (SELECT max(ds) FROM ser), ds))::DOUBLE AS x, ln(1 + y) AS ly FROM ser)"


def areas(spark: SparkSession, sf: str) -> DataFrame:
    return forecast_features(*star(spark, sf), "1996-01-01", ("borough",))


@query(
    f"""{AREAS}, w AS (SELECT *, [1.0::DOUBLE, x / 365.25, sin(x * 2 * pi() / 7), cos(x * 2 * pi() / 7)] AS v FROM t), i AS (SELECT unnest(range(1, 5)) AS i),
      p AS (SELECT a.i AS i, b.i AS j FROM i a JOIN i b ON a.i <= b.i)
    SELECT borough, i::INT AS i, j::INT AS j, round(sum(v[i] * v[j]), 4) AS xx, round(sum(v[i] * ly), 4) AS xy, round(sum(ly * ly), 4) AS yy, count(*) AS n FROM w, p GROUP BY borough, i, j"""
)
def series_equations(spark: SparkSession, sf: str) -> DataFrame:
    """The sums from which each area's regression is solved: a trend and a weekly wave."""
    df = areas(spark, sf)
    last = df.agg(F.max("ds")).first()[0]
    shifted = df.withColumn("day", F.date_add(F.lit("1970-01-01").cast("date"), F.datediff("ds", F.lit(last))))
    terms = P.series_terms("day", 0, 1)
    found = P.normal_equations(shifted, ["borough"], terms, F.log1p("y"))
    places = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(k).alias("k")) for k, (i, j) in enumerate((i, j) for i in range(1, 5) for j in range(i, 5))])
    each = found.select("borough", "n", "xx", "xy", "yy", F.explode(places).alias("p"))
    four = lambda c: F.round(c, 4)
    return each.select("borough", F.col("p.i").alias("i"), F.col("p.j").alias("j"), four(F.get("xx", F.col("p.k"))).alias("xx"), four(F.get("xy", F.col("p.i") - 1)).alias("xy"), four(F.col("yy")).alias("yy"), "n")


@query(
    f"""{AREAS}, f AS (SELECT borough, regr_slope(ly, x) AS b, regr_intercept(ly, x) AS a, sqrt(greatest(0, regr_syy(ly, x) - regr_slope(ly, x) * regr_sxy(ly, x)) / count(*)) AS s FROM t GROUP BY 1)
    SELECT borough, ((SELECT max(ds) FROM ser) + k)::DATE AS ds, round(exp(a + b * k) - 1, 5) AS yhat, round(exp(a + b * k - 1.96::DOUBLE * s) - 1, 5) AS yhat_lower,
      round(exp(a + b * k + 1.96::DOUBLE * s) - 1, 5) AS yhat_upper FROM f, (SELECT unnest(range(1, 15))::INT AS k)"""
)
def trend_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """A fortnight ahead on each area's straight line, with its interval."""
    out = P.trend_forecast(areas(spark, sf), "borough")
    return out.withColumns({c: F.round(c, 5) for c in ("yhat", "yhat_lower", "yhat_upper")})


# ---- sketches ----
def sketch_mart(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(the facts' valid rows, the stored sketches of each agency's and area's day)."""
    facts, dims = star(spark, sf)
    return by_day(facts, dims), stored(day_sketches(facts, dims, ["agency_code", "borough"], ["complaint_type_key", "unique_key"]), "sketches")


def close(spark: SparkSession, sf: str, period, name: str, by: str) -> DataFrame:
    """A roll-up of the sketches, and whether it is as close to the exact figures as it should be (the facts are read for that alone)."""
    rows, mart = sketch_mart(spark, sf)
    told = rolled_up(mart, [period, by])
    exact = rows.withColumn(name, period).groupBy(name, by).agg(F.count_distinct("complaint_type_key").alias("kinds"), F.count_distinct("unique_key").alias("keys"))
    off = lambda q, p: rank_errors(rows.withColumn(name, period), told, [name, by], "valid_hours", q, p).withColumnRenamed("off", f"off_{q}")
    near = lambda e, x: F.abs(F.col(e) - F.col(x)) <= 1 + 0.06 * F.col(x)
    joined = told.join(exact, [name, by]).join(off("q50", 0.5), [name, by], "left").join(off("q90", 0.9), [name, by], "left")
    return joined.select(
        name, by, *SKETCH_COUNTS, (F.coalesce("off_q50", F.lit(0.0)) <= 0.02).alias("median_close"), (F.coalesce("off_q90", F.lit(0.0)) <= 0.02).alias("q90_close"),
        (near("distinct_complaint_type_key", "kinds") & near("distinct_unique_key", "keys")).alias("distinct_close"),
    )


SKETCHED = "count(*) AS total_complaints, count(*) FILTER (is_closed) AS closed, count(vh) AS valid_response_count, count(*) FILTER (sla IN ('SAME_DAY', 'WITHIN_WEEK')) AS within_sla_count, TRUE AS median_close, TRUE AS q90_close, TRUE AS distinct_close"


@query(f"{FACT} SELECT (date_key // 100)::INT AS month_key, agency_code, {SKETCHED} FROM v GROUP BY 1, 2")
def sketched_months(spark: SparkSession, sf: str) -> DataFrame:
    """Agencies' months from the sketches of their days: counts exact, median and ninth decile within 2 % in rank, distinct members within 6 %."""
    return close(spark, sf, F.floor(F.col("date_key") / 100).cast("int").alias("month_key"), "month_key", "agency_code")


@query(f"{FACT} SELECT (year * 10 + quarter(date_actual))::INT AS quarter_key, borough, {SKETCHED} FROM v GROUP BY 1, 2")
def sketched_quarters(spark: SparkSession, sf: str) -> DataFrame:
    """Areas' quarters from the same sketches."""
    return close(spark, sf, quarter(), "quarter_key", "borough")
