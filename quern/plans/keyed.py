"""Queries of keyed tables, of marts that are merged by look-back, of windows by days, and of what files a query opens."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.shared import work_dir
from quern.operators import clustering, features, marts
from quern.operators import versions as V
from quern.operators.fact import Dims
from quern.plans import marts as M
from quern.plans.views import AS_OF, FACT, half_up, star
from quern.sources import landing as L
from quern.streaming import evolving

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = half_up(sql)
        return f

    return register


# ---- merges that carry what they do not touch ----
def merged_orders(spark: SparkSession, sf: str) -> str:
    """A table of orders by year, in four versions: all; new states in 1997 and a late row of 1996; some gone in 1995; new ones."""
    path, orders = work_dir(spark), L.load(spark, sf, "orders")
    rows = orders.select("o_orderkey", F.year("o_orderdate").alias("o_year"), "o_orderstatus", "o_totalprice", F.lit(1).alias("seq"))
    k = F.col("o_orderkey")
    V.merge(spark, path, rows.where(k % 10 < 9), ["o_orderkey"], "seq", partition=["o_year"], batch_id=0)
    changed = rows.where((F.col("o_year") == 1997) & (k % 7 == 0) & (k % 10 < 9)).withColumns({"o_orderstatus": F.lit("X"), "seq": F.lit(2)})
    late = rows.where((F.col("o_year") == 1996) & (k % 10 < 9)).withColumns({"o_orderstatus": F.lit("late"), "seq": F.lit(0)})
    V.merge(spark, path, changed.unionByName(late), ["o_orderkey"], "seq", batch_id=1)
    gone = rows.where((F.col("o_year") == 1995) & (k % 11 == 0) & (k % 10 < 9)).withColumn("seq", F.lit(3))
    V.merge(spark, path, gone, ["o_orderkey"], "seq", deletes=F.lit(True), batch_id=2)
    V.merge(spark, path, rows.where(k % 10 == 9), ["o_orderkey"], "seq", batch_id=3)
    return path


ORDERS = """WITH o AS (SELECT o_orderkey, year(o_orderdate)::INT AS o_year, o_orderstatus, o_totalprice, 1 AS seq FROM orders),
    kept AS (SELECT * FROM o WHERE NOT (o_year = 1995 AND o_orderkey % 11 = 0 AND o_orderkey % 10 < 9)),
    told AS (SELECT o_orderkey, o_year, CASE WHEN o_year = 1997 AND o_orderkey % 7 = 0 AND o_orderkey % 10 < 9 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
      CASE WHEN o_year = 1997 AND o_orderkey % 7 = 0 AND o_orderkey % 10 < 9 THEN 2 ELSE 1 END AS seq FROM kept)"""


@query(f"{ORDERS} SELECT * FROM told")
def merge_by_folder(spark: SparkSession, sf: str) -> DataFrame:
    return V.current(spark, merged_orders(spark, sf))


@query(
    f"""{ORDERS}, y AS (SELECT count(DISTINCT o_year) FILTER (o_orderkey % 10 < 9) AS a, count(DISTINCT o_year) FILTER (o_orderkey % 10 = 9) AS b FROM o),
    c AS (SELECT (count(*) FILTER (o_year = 1997 AND o_orderkey % 7 = 0 AND o_orderkey % 10 < 9) > 0)::BIGINT AS x, (count(*) FILTER (o_year = 1995 AND o_orderkey % 11 = 0 AND o_orderkey % 10 < 9) > 0)::BIGINT AS d FROM o)
    SELECT 1::BIGINT AS version, 0::BIGINT AS batch, a AS folders_written, 0::BIGINT AS folders_carried FROM y UNION ALL SELECT 2, 1, x, a - x FROM y, c UNION ALL SELECT 3,
      2, d, a - d FROM y, c UNION ALL SELECT 4, 3, b, a FROM y"""
)
def merge_history(spark: SparkSession, sf: str) -> DataFrame:
    """What each merge wrote anew and what it carried: a late row and years without a change are not written."""
    return V.history(spark, merged_orders(spark, sf)).select("version", "batch", "folders_written", "folders_carried")


@query(f"{ORDERS} SELECT * FROM told")
def change_feed_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The first version with the feed of all later ones put in, which is the last version."""
    path = merged_orders(spark, sf)
    return V.replayed(V.at(spark, path, 1), V.changes(spark, path, 1), ["o_orderkey"])


@query(
    f"""{ORDERS} SELECT 2::BIGINT AS version, 'update' AS change, count(*) AS n FROM told WHERE seq = 2 GROUP BY ALL UNION ALL SELECT 3, 'delete', count(*) AS n FROM o WHERE o_year = 1995 AND o_orderkey % 11 = 0 AND o_orderkey % 10 < 9 HAVING count(*) > 0
    UNION ALL SELECT 4, 'insert', count(*) FROM o WHERE o_orderkey % 10 = 9 HAVING count(*) > 0"""
)
def change_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Changes by version and kind, read from the feed of version 2 on."""
    return V.changes(spark, merged_orders(spark, sf), 1).groupBy("version", "change").agg(F.count(F.lit(1)).alias("n"))


# ---- layout and pruning ----
#: Rows of a clustered file at most (some 40 MB of facts on their way to the task that writes it).
FILE_ROWS = 250_000


def clustered(spark: SparkSession, path: str, rows: int) -> None:
    """Cluster a fact table by agency and month: 64 files, and more once they would exceed ``FILE_ROWS``."""
    clustering.cluster(spark, path, ["agency_code", "created_month"], rows_per_file=min(max(1, rows // 64), FILE_ROWS))


def fact_table(spark: SparkSession, facts: DataFrame, salt: int = 1) -> str:
    """The facts as a keyed table by year of creation."""
    path = work_dir(spark)
    V.overwrite(spark, path, facts, ["created_year"], salt=salt)
    return path


@query(f"{FACT} SELECT agency_code, created_month, count(*) AS requests, TRUE AS opens_fewer FROM fct GROUP BY ALL")
def clustered_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Requests by agency and month from facts that were clustered by both, and whether a filter on the two opens fewer files than before."""
    facts, _ = star(spark, sf)
    path = fact_table(spark, facts, salt=8)
    before = V.current(spark, path)
    rows = facts.count()
    clustered(spark, path, rows)
    after = V.current(spark, path)
    pairs = [r.asDict() for r in facts.select("agency_code", "created_month").distinct().collect()]  # agencies x 12
    (all_before, *old), (all_after, *new) = clustering.opened(before, pairs), clustering.opened(after, pairs)
    fewer = [(p["agency_code"], p["created_month"], b / all_after < a / all_before) for p, a, b in zip(pairs, old, new)]
    told = spark.createDataFrame(fewer, "agency_code string, created_month int, opens_fewer boolean")
    return after.groupBy("agency_code", "created_month").agg(F.count(F.lit(1)).alias("requests")).join(told, ["agency_code", "created_month"])


@query()
def clustered_file_share(spark: SparkSession, sf: str) -> DataFrame:
    """(layout, files, share): the mean share of the files that a filter on an agency and a month has to open, before and after clustering.

    How rows fall into files is for Spark to choose, so there is no SQL; the tests hold the shares.
    """
    facts, _ = star(spark, sf)
    path, rows = fact_table(spark, facts, salt=8), facts.count()
    pairs = [r.asDict() for r in facts.select("agency_code", "created_month").distinct().collect()]  # agencies x 12
    told = [("by hash", *clustering.opened(V.current(spark, path), pairs))]
    clustered(spark, path, rows)
    told.append(("by curve", *clustering.opened(V.current(spark, path), pairs)))
    shares = [(name, files, round(sum(n) / len(n) / files, 4)) for name, files, *n in told]
    return spark.createDataFrame(shares, "layout string, files long, share double")


def holidays(facts: DataFrame, dims: Dims) -> DataFrame:
    """Facts of the public holidays of the second half of some fiscal years: the dates' filter prunes the facts' folders when it runs."""
    days = dims.date.where(F.col("is_holiday") & F.col("fiscal_year").isin(1997, 1998) & (F.col("month") >= 9)).select(F.col("date_key").alias("created_date_key"), F.col("year").alias("created_year"), "holiday_name")
    return facts.join(days, ["created_year", "created_date_key"])


@query(f"{FACT} SELECT year AS created_year, holiday_name, count(*) AS requests FROM v WHERE holiday_name IS NOT NULL AND created_fiscal_year IN (1997, 1998) AND month >= 9 GROUP BY ALL")
def pruned_holidays(spark: SparkSession, sf: str) -> DataFrame:
    """Holiday requests from facts stored by year; of the folders only those of the dates' years are opened."""
    facts, dims = star(spark, sf)
    stored = V.current(spark, fact_table(spark, facts))
    return holidays(stored, dims).groupBy("created_year", "holiday_name").agg(F.count(F.lit(1)).alias("requests"))


# ---- marts merged by look-back ----
def last_day(facts: DataFrame) -> str:
    last = facts.agg(F.max("created_date_key")).first()[0]
    return f"{last // 10000}-{last // 100 % 100:02d}-{last % 100:02d}"


def earlier(facts: DataFrame, day: str, days: int) -> DataFrame:
    """The facts as they were known so many days before."""
    return facts.where(F.to_date(F.col("created_date_key").cast("string"), "yyyyMMdd") < F.date_sub(F.lit(day).cast("date"), days))


def refreshed(spark: SparkSession, sf: str, build: Callable, by: list[str], rows: int) -> DataFrame:
    """A mart that was built 20 days before the last, then refreshed with a look-back of 30."""
    facts, dims = star(spark, sf)
    day, path = last_day(facts), work_dir(spark)
    marts.put_down(spark, path, build(earlier(facts, day, 20), dims, None))
    marts.refresh(spark, path, lambda since: build(facts, dims, since), by, day, 30, rows)
    return V.current(spark, path).drop("mart_month")


@query(f"WITH d AS ({M.ORACLE_SQL['daily_summary']}) SELECT * FROM d WHERE date_actual >= (SELECT max(date_actual) FROM d) - 30")
def incremental_daily_equals_full(spark: SparkSession, sf: str) -> DataFrame:
    """The look-back's days: requests that are new but closed before, by a wrong date, count on older days in a full build alone."""
    day = L.load(spark, sf, "orders").agg(F.to_date(F.max("o_orderdate")).alias("d")).first().d.isoformat()
    return refreshed(spark, sf, lambda f, d, s: marts.agg_daily(f, d, s), [], 30).where(F.col("date_actual") >= F.date_sub(F.lit(day).cast("date"), 30))


@query(M.ORACLE_SQL["agency_metrics"])
def incremental_agency_equals_full(spark: SparkSession, sf: str) -> DataFrame:
    return refreshed(spark, sf, lambda f, d, s: marts.agg_agency(f, d, AS_OF, s), ["agency_key"], 7)


@query(M.ORACLE_SQL["location_metrics"])
def incremental_location_equals_full(spark: SparkSession, sf: str) -> DataFrame:
    return refreshed(spark, sf, lambda f, d, s: marts.agg_location(f, d, since=s), ["location_key"], 7)


@query(M.ORACLE_SQL["type_metrics"])
def incremental_type_equals_full(spark: SparkSession, sf: str) -> DataFrame:
    out = refreshed(spark, sf, lambda f, d, s: marts.agg_type(f, d, s), ["complaint_type_key"], 1)
    return out.withColumn("avg_response_time_hours", F.round("avg_response_time_hours", 6))


# ---- windows by days: in SQL over a table that has every day for every key ----
def sql_dense(by: str, value: str = "total_complaints") -> str:
    """Every day from the first to the last for each key, 0 where there is no request."""
    return f"""{FACT}, days AS (SELECT date_key, date_actual FROM hol WHERE date_actual BETWEEN (SELECT min(date_actual) FROM v) AND (SELECT max(date_actual) FROM v)),
    n AS (SELECT date_key, {by}, count(*) AS n FROM v GROUP BY ALL), keys AS (SELECT DISTINCT {by} FROM v),
    dense AS (SELECT dk.date_key, date_actual, {by}, coalesce(n, 0) AS {value}, n IS NOT NULL AS there FROM (SELECT * FROM days, keys) dk LEFT JOIN n USING (date_key, {by})),
    w AS (SELECT *, avg({value}) OVER (PARTITION BY {by} ORDER BY date_key ROWS 6 PRECEDING) AS a7, avg({value}) OVER (PARTITION BY {by} ORDER BY date_key ROWS 29 PRECEDING) AS a30,
      stddev_samp({value}) OVER (PARTITION BY {by} ORDER BY date_key ROWS 29 PRECEDING) AS s30,
      lag({value}) OVER k AS d1, lag({value}, 7) OVER k AS d7, lag({value}, 30) OVER k AS d30, lag({value}, 365) OVER k AS d365 FROM dense WINDOW k AS (PARTITION BY {by} ORDER BY date_key))"""


@query(
    f"""{sql_dense("agency_key")} SELECT date_key, agency_key, total_complaints, round(a7, 2) AS complaints_7day_avg, {M.sql_pct("total_complaints", "a7", "1")} AS workload_index,
    {M.sql_trend("total_complaints", "d7", 1.1, 0.9, "UP", "DOWN")} AS trend_direction FROM w WHERE there"""
)
def agency_by_days(spark: SparkSession, sf: str) -> DataFrame:
    facts, dims = star(spark, sf)
    out = marts.agg_agency(facts, dims, AS_OF, first=marts.first_day(facts, dims))
    return out.select("date_key", "agency_key", "total_complaints", "complaints_7day_avg", "workload_index", "trend_direction")


@query(
    f"""{sql_dense("location_key")} SELECT date_key, location_key, total_complaints, round(a7, 2) AS complaints_7day_avg, {M.sql_change("total_complaints", "d7")} AS complaints_vs_prev_week_pct,
      {M.sql_change("total_complaints", "d1")} AS complaints_vs_prev_day_pct,
    {M.sql_trend("total_complaints", "d7", 1.2, 0.8, "INCREASING", "DECREASING")} AS trend_direction FROM w WHERE there"""
)
def location_by_days(spark: SparkSession, sf: str) -> DataFrame:
    facts, dims = star(spark, sf)
    out = marts.agg_location(facts, dims, first=marts.first_day(facts, dims))
    return out.select("date_key", "location_key", "total_complaints", "complaints_7day_avg", "complaints_vs_prev_week_pct", "complaints_vs_prev_day_pct", "trend_direction")


@query(
    f"""{sql_dense("location_key", "y")} SELECT date_actual AS ds, location_key, y, round(a7, 2) AS rolling_7day_avg, round(a30, 2) AS rolling_30day_avg,
      round(s30, 2) AS rolling_30day_std, d1 AS lag_1day, d7 AS lag_7day, d30 AS lag_30day, d365 AS lag_365day,
    {M.sql_change("y", "d7")} AS week_over_week_change_pct, CASE WHEN s30 > 0 THEN round((y - a30) / s30, 3) END AS z_score_30day FROM w WHERE there"""
)
def features_by_days(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast features of each location, on its sparse days, with frames by days."""
    facts, dims = star(spark, sf)
    out = features.forecast_features(facts, dims, "1995-01-01", ("location_key",), first=marts.first_day(facts, dims))
    return out.select("ds", "location_key", "y", "rolling_7day_avg", "rolling_30day_avg", "rolling_30day_std", "lag_1day", "lag_7day", "lag_30day", "lag_365day", "week_over_week_change_pct", "z_score_30day")


# ---- streams of files whose columns change ----
@query(
    """WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    SELECT user_id, event_id, ts::DATE AS day, CASE WHEN event_id % 4 <> 1 THEN event_type END AS event_type, value, event_id % 4 = 3 AS has_rescued FROM e WHERE r = 1"""
)
def stream_of_changing_files(spark: SparkSession, sf: str) -> DataFrame:
    """The latest event of each user from a stream of files, a file a batch and out of order: some lack a column, some write a number as text, some bring a column more.

    The stream is started, stopped after two of four files and started again; the table is that of all rows at once.
    """
    root, events = work_dir(spark), L.load(spark, sf, "events").drop("props")
    parts = [events.where(F.col("event_id") % 4 == k) for k in range(4)]
    parts[1] = parts[1].drop("event_type")
    parts[2] = parts[2].withColumn("value", F.col("value").cast("string"))
    parts[3] = parts[3].withColumn("extra", F.lit("more"))
    for half in ((3, 0), (2, 1)):
        for k in half:
            parts[k].coalesce(1).write.parquet(f"{root}/in/{k}")
        evolving.evolving_upsert(spark, f"{root}/in", events.schema, f"{root}/table", f"{root}/checkpoint", ["user_id"], "ts", "event_id", max_files=1).awaitTermination()
    out = V.current(spark, f"{root}/table")
    return out.select("user_id", "event_id", F.to_date("ts").alias("day"), "event_type", "value", F.col("_rescued_data").isNotNull().alias("has_rescued"))
