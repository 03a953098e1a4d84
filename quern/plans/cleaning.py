"""Queries of landing, cleaning and the keyed tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import lookups
from quern.functions.shared import stored, work_dir
from quern.operators import marts
from quern.operators import silver as S
from quern.operators import upsert as U
from quern.operators import versions as V
from quern.plans import marts as M
from quern.plans.views import AS_OF, FACT, MIN_YEAR, REQUESTS, half_up, raw, requests, star
from quern.sources import landing as L
from quern.streaming import requests as stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    def register(f: Callable) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = half_up(sql)
        return f

    return register


@query(f"{REQUESTS} SELECT unique_key, created_date::DATE AS created_day FROM req WHERE created_date >= DATE '1997-12-01' AND created_date < DATE '1998-01-01'")
def period_slice(spark: SparkSession, sf: str) -> DataFrame:
    """December, whose end is in the next year."""
    return L.period_slice(requests(spark, sf), "created_date", "1997-12-01", "month").select("unique_key", F.to_date("created_date").alias("created_day"))


@query(f"{REQUESTS} SELECT count(*) AS n, max(created_date::DATE) AS last_day FROM req WHERE created_date::DATE <= DATE '2001-07-20' - 2")
def settled(spark: SparkSession, sf: str) -> DataFrame:
    return L.settled(requests(spark, sf), "created_date", "2001-07-20").agg(F.count(F.lit(1)).alias("n"), F.max(F.to_date("created_date")).alias("last_day"))


MANIFEST = f"{REQUESTS}, mf AS (SELECT date_trunc('month', created_date)::DATE AS period_start, count(*) AS record_count FROM req GROUP BY 1)"


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return L.manifest(requests(spark, sf), "created_date", "month")


@query(f"{MANIFEST} SELECT period_start, record_count, 12::INT AS column_count, 'month' AS grain, 'parquet' AS format, 'snappy' AS compression, 'landing' AS layer FROM mf")
def landing_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest(spark, sf)


@query(f"{MANIFEST} SELECT period_start, record_count, CASE WHEN record_count < 180 OR record_count > 195 THEN 'warning' ELSE 'passed' END AS status FROM mf")
def count_validation(spark: SparkSession, sf: str) -> DataFrame:
    return L.validate_counts(manifest(spark, sf), 180, 195).select("period_start", "record_count", "status")


@query(f"{MANIFEST} SELECT count(*) AS periods, sum(record_count)::BIGINT AS records, count(*) FILTER (record_count BETWEEN 180 AND 195) AS passed, count(*) FILTER (record_count NOT BETWEEN 180 AND 195) AS warning, 0::BIGINT AS skipped, 0::BIGINT AS failed FROM mf")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return L.run_summary(L.validate_counts(manifest(spark, sf), 180, 195))


ALL_MONTHS = "SELECT d::DATE AS start, (d + INTERVAL 1 MONTH)::DATE AS \"end\" FROM generate_series(TIMESTAMP '1994-10-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH) t(d)"


@query(f"{MANIFEST}, p AS ({ALL_MONTHS}) SELECT start, \"end\" FROM p ANTI JOIN mf ON start = period_start")
def landing_missing_periods(spark: SparkSession, sf: str) -> DataFrame:
    return L.missing_periods(L.periods(spark, "1994-10-01", "2001-12-01"), manifest(spark, sf))


@query(
    f"""{MANIFEST}, p AS ({ALL_MONTHS}), r AS (SELECT *, CASE WHEN "end" > DATE '{AS_OF}' + 1 THEN 'end is in the future' WHEN start < DATE '1995-01-01' THEN 'start is before the first data' END AS reason FROM p)
    SELECT start, "end", reason, reason IS NULL AS ok, coalesce(record_count, 0) AS records FROM r LEFT JOIN mf ON start = period_start"""
)
def periods(spark: SparkSession, sf: str) -> DataFrame:
    checked = L.validate_periods(L.periods(spark, "1994-10-01", "2001-12-01"), AS_OF, "1995-01-01")
    counts = manifest(spark, sf).select(F.col("period_start").alias("start"), "record_count")
    return checked.join(counts, "start", "left").select("start", "end", "reason", "ok", F.coalesce("record_count", F.lit(0)).alias("records"))


@query()
def staging_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The limit is the feature: a look at some rows."""
    return L.staging_sample(requests(spark, sf))


@query(f"{MANIFEST} SELECT year(period_start)::INT AS year, month(period_start)::INT AS month, record_count AS n FROM mf")
def landing_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Land by month, land again what is missing (nothing), read, count."""
    root, rows = work_dir(spark), requests(spark, sf)
    months = L.periods(spark, "1995-01-01", "2001-12-01")
    L.land_if_absent(rows, root, "created_date", months, manifest(spark, sf).limit(0), "month")
    L.land_if_absent(rows, root, "created_date", months, manifest(spark, sf), "month")
    read = spark.read.parquet(root)
    return read.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(F.count(F.lit(1)).alias("n"))


# ---- raw text ----
RAW = f"""{REQUESTS}, raw AS (SELECT unique_key AS k, strftime(created_date, '%Y-%m-%dT%H:%M:%S.%g') AS created_date, CASE WHEN unique_key % 17 = 0 THEN '' WHEN unique_key % 17 = 1 THEN 'not a date' ELSE strftime(closed_date,
  '%Y-%m-%dT%H:%M:%S.%g') END AS closed_date, agency, ' ' || lower(agency) AS agency_name,
    CASE WHEN unique_key % 19 = 0 THEN '' ELSE complaint_type || ' ' END AS complaint_type, CASE WHEN unique_key % 4 > 0 THEN descriptor END AS descriptor,
      CASE WHEN unique_key % 3 > 0 THEN 'Street' END AS location_type,
    CASE unique_key % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '123' WHEN 3 THEN '11201-12' ELSE (10000 + unique_key % 1700)::VARCHAR END AS incident_zip,
    CASE unique_key % 6 WHEN 0 THEN NULL WHEN 1 THEN 'W 5 ST INTERSECTION' WHEN 2 THEN '10 BLOCK' WHEN 3 THEN '' ELSE (unique_key % 90) || ' main st' END AS incident_address,
    CASE unique_key % 7 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' Astoria ' WHEN 3 THEN 'chelsea' ELSE city END AS city, CASE unique_key % 11 WHEN 0 THEN NULL WHEN 1 THEN 'Open' WHEN 2 THEN 'Closed - Duplicate' ELSE status END AS status,
    CASE unique_key % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' done ' || descriptor END AS resolution_description, strftime(resolution_action_updated_date,
      '%Y-%m-%dT%H:%M:%S.%g') AS resolution_action_updated_date, CASE WHEN unique_key % 2 > 0 THEN '' ELSE borough END AS community_board,
    CASE unique_key % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Unspecified' WHEN 3 THEN ' bronx ' WHEN 4 THEN 'Queens' WHEN 5 THEN 'MANHATTAN' ELSE borough END AS borough,
    CASE unique_key % 8 WHEN 0 THEN '' WHEN 1 THEN 'NaN' WHEN 2 THEN '0' WHEN 3 THEN 'bad' ELSE (40.3::DOUBLE + (unique_key % 700) / 1000)::VARCHAR END AS latitude,
      CASE WHEN unique_key % 9 > 0 THEN ((-74.4)::DOUBLE + (unique_key % 800) / 1000)::VARCHAR END AS longitude
  FROM req)"""


def sql_dates() -> str:
    return ", ".join(f"try_strptime({c}, '%Y-%m-%dT%H:%M:%S.%g') AS {c}" for c in S.DATES)


def sql_list(names) -> str:
    return ", ".join(f"'{n}'" for n in names)


def sql_ranges(ranges: str) -> str:
    parts = [p.partition("-") for p in ranges.split()]
    return " OR ".join(f"z BETWEEN {a} AND {b or a}" for a, _, b in parts)


ZIP_CASE = "CASE " + " ".join(f"WHEN {sql_ranges(r)} THEN '{area}'" for area, r in lookups.ZIP_RANGES.items()) + " END"
PLACE_CASE = "CASE " + " ".join(f"WHEN upper(trim(city)) IN ({sql_list(' '.join(n.split()) for n in lookups.PLACES[a].split(','))}) THEN '{a}'" for a in lookups.AREAS) + " END"
CITY_CASE = "CASE area " + " ".join(f"WHEN '{a}' THEN '{c}'" for a, c in lookups.CITY_OF_AREA.items()) + " ELSE 'UNKNOWN' END"
tidy = lambda c: f"upper(trim({c}))"

STEPS = f"""{RAW},
    d AS (SELECT * REPLACE ({sql_dates()}), CASE WHEN regexp_full_match(incident_zip, '[0-9]+') THEN incident_zip::INT END AS z FROM raw),
    a AS (SELECT *, CASE WHEN borough <> 'Unspecified' AND {tidy("borough")} IN ({sql_list(lookups.AREAS)}) THEN {tidy("borough")} ELSE coalesce({ZIP_CASE}, {PLACE_CASE}, 'UNSPECIFIED') END AS area,
      coalesce(closed_date < created_date, FALSE) AS has_invalid_closed_date, coalesce(year(closed_date) < {MIN_YEAR}, FALSE) AS has_historical_closed_date,
        coalesce(closed_date > DATE '{AS_OF}' + 30, FALSE) AS has_future_closed_date,
      coalesce(upper(status) LIKE 'CLOSED%' AND closed_date IS NULL AND resolution_action_updated_date BETWEEN created_date AND DATE '{AS_OF}', FALSE) AS inferred FROM d),
    s AS (SELECT k, created_date, CASE WHEN inferred THEN resolution_action_updated_date ELSE closed_date END AS closed_date, closed_date AS closed_date_original,
      CASE WHEN closed_date IS NOT NULL THEN 'ORIGINAL' WHEN inferred THEN 'INFERRED_FROM_RESOLUTION' ELSE 'MISSING' END AS closed_date_source,
      resolution_action_updated_date AS acted, area AS borough, CASE WHEN coalesce(city, '') = '' THEN {CITY_CASE} ELSE {tidy("city")} END AS city, {", ".join(f"coalesce(nullif({tidy(c)}, ''), '{v}') AS {c}" for c, v in S.DEFAULTS.items())},
        {tidy("agency_name")} AS agency_name,
      nullif({tidy("incident_address")}, '') AS incident_address, CASE WHEN coalesce(incident_address, '') = '' THEN 'NOT_PROVIDED' WHEN contains(incident_address,
        'INTERSECTION') THEN 'INTERSECTION' WHEN contains(incident_address, 'BLOCK') THEN 'BLOCK' ELSE 'ADDRESS' END AS address_type,
      CASE WHEN coalesce(resolution_description, '') <> '' THEN {tidy("resolution_description")} WHEN coalesce(status, '') NOT IN ({sql_list(S.UNRESOLVED)}) THEN 'NO_RESOLUTION_INFO' END AS resolution_description,
        CASE WHEN regexp_full_match(incident_zip, '[0-9]{{5}}') THEN incident_zip END AS incident_zip,
      nullif(community_board, '') AS community_board, CASE WHEN try_cast(latitude AS DOUBLE) BETWEEN 40.477399::DOUBLE AND 40.917577::DOUBLE THEN try_cast(latitude AS DOUBLE) END AS latitude,
        CASE WHEN try_cast(longitude AS DOUBLE) BETWEEN (-74.259090)::DOUBLE AND (-73.700009)::DOUBLE THEN try_cast(longitude AS DOUBLE) END AS longitude,
      has_invalid_closed_date, has_historical_closed_date, has_future_closed_date FROM a),
    f AS (SELECT *, latitude IS NOT NULL AND longitude IS NOT NULL AS has_valid_location, coalesce(resolution_description <> 'NO_RESOLUTION_INFO', FALSE) AS has_resolution,
      closed_date IS NOT NULL AS is_closed, incident_zip IS NOT NULL AS has_valid_zip,
      status LIKE 'CLOSED%' AND closed_date IS NULL AS has_closed_status_without_date, status IN ({sql_list(S.OPEN_STATES)}) AND closed_date IS NOT NULL AS open_status_with_closed_date,
        greatest(created_date, coalesce(closed_date, created_date), coalesce(acted, created_date)) AS updated_date FROM s)"""
stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
sql_stamp = lambda c: f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return S.silver(raw(spark, sf), AS_OF, MIN_YEAR)


STAMPS = ["created_date", "closed_date", "closed_date_original", "updated_date"]
FULL = """k, closed_date_source, borough, city, complaint_type, descriptor, location_type, status, agency_name, incident_address, address_type, resolution_description,
  incident_zip, community_board, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
    has_invalid_closed_date, has_historical_closed_date, has_future_closed_date, has_valid_location, has_resolution, is_closed, has_valid_zip, has_closed_status_without_date, open_status_with_closed_date"""


@query(f"{STEPS} SELECT {FULL}, {', '.join(sql_stamp(c) for c in STAMPS)}, year(created_date)::INT AS created_year, month(created_date)::INT AS created_month, day(created_date)::INT AS created_day FROM f")
def silver_full(spark: SparkSession, sf: str) -> DataFrame:
    names = [c.strip().split(" AS ")[-1] for c in FULL.replace("(latitude, 6)", "").replace("(longitude, 6)", "").split(",")]
    out = cleaned(spark, sf).withColumns({"k": F.col("unique_key").cast("long"), "latitude": F.round("latitude", 6), "longitude": F.round("longitude", 6)})
    return out.select(*names, *map(stamp, STAMPS), "created_year", "created_month", "created_day")


@query(f"{STEPS} SELECT k, borough FROM f")
def area_recovery(spark: SparkSession, sf: str) -> DataFrame:
    return S.recover_area(raw(spark, sf)).select(F.col("unique_key").cast("long").alias("k"), "borough")


@query(f"{STEPS} SELECT k, city FROM f")
def city_fill(spark: SparkSession, sf: str) -> DataFrame:
    return S.fill_city(S.recover_area(raw(spark, sf))).select(F.col("unique_key").cast("long").alias("k"), "city")


@query(f"{STEPS} SELECT closed_date_source, count(*) AS n, count(closed_date) AS closed FROM f GROUP BY 1")
def close_date_inference(spark: SparkSession, sf: str) -> DataFrame:
    return S.infer_closed(S.parse_dates(raw(spark, sf)), AS_OF).groupBy("closed_date_source").agg(F.count(F.lit(1)).alias("n"), F.count("closed_date").alias("closed"))


FLAGS = ["has_invalid_closed_date", "has_historical_closed_date", "has_future_closed_date", "has_valid_location", "has_resolution", "is_closed", "has_valid_zip", "has_closed_status_without_date", "open_status_with_closed_date"]


@query(f"{STEPS} SELECT {', '.join(f'count(*) FILTER ({f}) AS {f}' for f in FLAGS)} FROM f")
def quality_flags(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf).agg(*[F.count_if(f).alias(f) for f in FLAGS])


@query(f"{STEPS} SELECT count(*) AS n, count(created_date) AS created, count(closed_date_original) AS closed, count(acted) AS acted FROM f")
def safe_parse(spark: SparkSession, sf: str) -> DataFrame:
    return S.parse_dates(raw(spark, sf)).agg(F.count(F.lit(1)).alias("n"), F.count("created_date").alias("created"), F.count("closed_date").alias("closed"), F.count("resolution_action_updated_date").alias("acted"))


@query(f"{STEPS} SELECT complaint_type, status, count(*) AS n FROM f GROUP BY ALL")
def string_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return S.categories(raw(spark, sf)).groupBy("complaint_type", "status").agg(F.count(F.lit(1)).alias("n"))


@query(f"{STEPS} SELECT address_type, count(*) AS n FROM f GROUP BY ALL")
def address_type(spark: SparkSession, sf: str) -> DataFrame:
    return S.classify_address(raw(spark, sf)).groupBy("address_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"{STEPS} SELECT k, incident_zip FROM f WHERE incident_zip IS NOT NULL")
def zip_validation(spark: SparkSession, sf: str) -> DataFrame:
    return S.check_zip(raw(spark, sf)).where("incident_zip is not null").select(F.col("unique_key").cast("long").alias("k"), "incident_zip")


@query(f"{STEPS} SELECT count(latitude) AS n_latitude, count(longitude) AS n_longitude, count(*) FILTER (has_valid_location) AS n_both FROM f")
def coordinate_bounds(spark: SparkSession, sf: str) -> DataFrame:
    out = S.check_coordinates(S.numbers(raw(spark, sf)))
    return out.agg(F.count("latitude").alias("n_latitude"), F.count("longitude").alias("n_longitude"), F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias("n_both"))


# ---- keyed tables ----
LATEST = """WITH l AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, l_extendedprice FROM lineitem),
    best AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC, l_quantity DESC) AS r FROM l)"""


def versions(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with many versions of a key; the order is by date, then price and quantity."""
    rows = L.load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice")
    return rows.withColumn("seq", F.struct("l_shipdate", "l_extendedprice", "l_quantity"))


@query(f"{LATEST} SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS day, l_quantity, l_extendedprice FROM best WHERE r = 1")
def scd1_latest(spark: SparkSession, sf: str) -> DataFrame:
    return U.scd1_latest(versions(spark, sf), ["l_orderkey", "l_linenumber"], "seq").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("day"), "l_quantity", "l_extendedprice")


KEYS = ["l_orderkey", "l_linenumber"]


@query(f"{LATEST} SELECT l_orderkey, l_linenumber, l_shipdate::DATE AS day, l_quantity, l_extendedprice FROM best WHERE r = 1")
def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Three batches by a hash, out of order, the last one twice: the table is that of all rows at once."""
    path, rows, order = work_dir(spark), versions(spark, sf).drop("seq"), ["l_shipdate", "l_extendedprice", "l_quantity"]
    part = lambda k: rows.where(F.pmod(F.xxhash64("l_shipdate", "l_quantity"), F.lit(3)) == k)
    for batch, k in [*enumerate((2, 0, 1)), (2, 1)]:
        V.merge(spark, path, part(k), KEYS, order, batch_id=batch)
    return V.current(spark, path).select(*KEYS, F.to_date("l_shipdate").alias("day"), "l_quantity", "l_extendedprice")


@query(
    f"""{LATEST}, old AS (SELECT l_orderkey, l_linenumber, first(l_shipdate ORDER BY l_shipdate, l_extendedprice, l_quantity) AS d, first(l_quantity ORDER BY l_shipdate,
      l_extendedprice, l_quantity) AS q, first(l_extendedprice ORDER BY l_shipdate, l_extendedprice, l_quantity) AS p FROM l WHERE l_shipdate < DATE '1997-01-01' GROUP BY 1,
      2),
    new AS (SELECT l_orderkey, l_linenumber, l_shipdate AS d, l_quantity AS q, l_extendedprice AS p FROM best WHERE r = 1 AND l_shipdate >= DATE '1993-01-01')
    SELECT coalesce(old.l_orderkey, new.l_orderkey) AS l_orderkey, coalesce(old.l_linenumber, new.l_linenumber) AS l_linenumber, CASE WHEN old.l_orderkey IS NULL THEN 'insert' WHEN new.l_orderkey IS NULL THEN 'delete' ELSE 'update' END AS change
    FROM old FULL JOIN new USING (l_orderkey, l_linenumber) WHERE old.l_orderkey IS NULL OR new.l_orderkey IS NULL OR (old.d, old.q, old.p) <> (new.d, new.q, new.p)"""
)
def change_diff(spark: SparkSession, sf: str) -> DataFrame:
    """From the first versions before 1997 to the last ones since 1993."""
    rows = versions(spark, sf)
    first = rows.where("l_shipdate < '1997-01-01'").groupBy(*KEYS).agg(F.min("seq").alias("s"))
    last = rows.where("l_shipdate >= '1993-01-01'").groupBy(*KEYS).agg(F.max("seq").alias("s"))
    return U.change_diff(*[df.select(*KEYS, "s.*") for df in (first, last)], KEYS)


@query(f"WITH d AS ({M.ORACLE_SQL['daily_summary']}) SELECT * FROM d WHERE date_actual >= (SELECT max(date_actual) FROM d) - 14")
def incremental_equals_full(spark: SparkSession, sf: str) -> DataFrame:
    """The last days of the daily summary with all its columns, from an older summary and the look-back alone."""
    facts, dims = star(spark, sf)
    last = facts.agg(F.max("created_date_key")).first()[0]
    day = f"{last // 10000}-{last // 100 % 100:02d}-{last % 100:02d}"
    mart = stored(marts.agg_daily(facts.where(F.col("created_date_key") < last), dims), "older-mart")
    return marts.incremental(lambda since: marts.agg_daily(facts, dims, since), mart, [], day, 14)


@query(f"WITH d AS ({M.ORACLE_SQL['monthly_summary']}) SELECT * FROM d WHERE month_start_date >= (SELECT max(month_start_date) FROM d) - INTERVAL 2 MONTH")
def incremental_months_equal_full(spark: SparkSession, sf: str) -> DataFrame:
    """The last three months of the monthly summary with all its columns, built from those and the twelve before."""
    facts, dims = star(spark, sf)
    last = facts.agg(F.max("created_date_key")).first()[0]
    return marts.incremental_months(lambda f: marts.agg_monthly(f, dims), facts, last // 100, 2)


@query("SELECT event_id, ts::DATE AS day FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts::DATE <= (SELECT min(ts)::DATE + ((max(ts)::DATE - min(ts)::DATE) // 2)::INT FROM events))")
def watermark_pull(spark: SparkSession, sf: str) -> DataFrame:
    """Events newer than the newest one of a table that holds the first half of the days."""
    events = L.load(spark, sf, "events").withColumn("day", F.to_date("ts"))
    middle = events.agg(F.expr("date_add(min(day), cast(datediff(max(day), min(day)) div 2 as int))")).first()[0]
    return U.newer(events, events.where(F.col("day") <= F.lit(middle)), "ts").select("event_id", "day")


# ---- streams ----
@query("SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream, counted by day and type."""
    schema = L.load(spark, sf, "events").schema
    source = stream.bronze_stream(spark, f"{sf}/events.parquet*", schema)
    root = work_dir(spark)
    counts = stream.daily_counts(source, "ts", "event_type", "40 days")
    counts.writeStream.outputMode("complete").foreachBatch(lambda df, k: df.write.mode("overwrite").parquet(f"{root}/counts")).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/counts")


@query("SELECT user_id, max(ts)::DATE AS last_day, count(DISTINCT user_id) AS n FROM events GROUP BY 1")
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The latest event of each user, by a stream into a keyed table."""
    schema = L.load(spark, sf, "events").schema
    root = work_dir(spark)
    source = stream.bronze_stream(spark, f"{sf}/events.parquet*", schema)
    stream.upsert_stream(source, f"{root}/table", f"{root}/checkpoint", ["user_id"], "ts", "event_id").awaitTermination()
    return V.current(spark, f"{root}/table").select("user_id", F.to_date("ts").alias("last_day"), F.lit(1).cast("long").alias("n"))
