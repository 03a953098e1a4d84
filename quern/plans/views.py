"""Request-shaped views of the given tables, in DataFrame code and in SQL, for the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.shared import shared_dir, stored
from quern.operators.dims import dim_agency, dim_date, dim_location, dim_type
from quern.operators.fact import Dims, fact
from quern.operators.silver import DATE_FORMAT, date_flags, partition_columns
from quern.sources.landing import load

AS_OF, MIN_YEAR, START, END = "2001-12-31", 1995, "1995-01-01", "2001-12-31"
TYPES = {"1-URGENT": "Noise - Residential", "2-HIGH": "Illegal Parking", "3-MEDIUM": "Heat/Hot Water", "4-NOT SPECIFIED": "Street Condition", "5-LOW": "Taxi Complaint"}
STATES = {"F": "CLOSED", "O": "OPEN", "P": "PENDING"}


def mapped(column: str, names: dict[str, str]):
    return F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col(column)], F.col(column))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as clean requests: one row for each order."""
    lines = load(spark, sf, "lineitem").join(load(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type"), "l_partkey")
    per = lines.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"), F.min("p_type").alias("descriptor"))
    customer, nation, region = load(spark, sf, "customer"), load(spark, sf, "nation"), load(spark, sf, "region")
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    joined = load(spark, sf, "orders").join(people, F.col("o_custkey") == F.col("c_custkey")).join(per, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    k = F.col("o_orderkey")
    at = lambda seconds: F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    created = F.col("o_orderdate") + at(k * 7919 % 86400)
    closed = F.when(k % 10 < 7, created + at(k * 31 % 1200 * 3600)).when(k % 10 > 7, F.col("last_ship"))
    return joined.select(
        k.alias("unique_key"), created.alias("created_date"), closed.alias("closed_date"), mapped("o_orderstatus", STATES).alias("status"), F.col("c_mktsegment").alias("agency"), F.col("r_name").alias("borough"),
        (F.col("n_nationkey") + 10000).cast("string").alias("incident_zip"), F.col("n_name").alias("city"), mapped("o_orderpriority", TYPES).alias("complaint_type"), "descriptor", F.col("first_ship").alias("resolution_action_updated_date"), (k % 3 == 0).alias("has_resolution"),
    )


def contract(spark: SparkSession, sf: str) -> DataFrame:
    """The view with what the cleaning adds."""
    flagged = partition_columns(date_flags(requests(spark, sf), AS_OF, MIN_YEAR))
    closed = F.col("closed_date").isNotNull()
    return flagged.withColumns({"is_closed": closed, "has_closed_status_without_date": (F.col("status") == "CLOSED") & ~closed, "open_status_with_closed_date": F.col("status").isin("OPEN", "PENDING") & closed})


#: What was stored for a session, a shared folder and the given tables as they were.
STARS: dict[tuple, tuple[DataFrame, Dims]] = {}


def star(spark: SparkSession, sf: str) -> tuple[DataFrame, Dims]:
    """(facts, dimensions). Requests, facts and the dimensions made from requests are stored once a session, as long as the given tables are the same:
    all summaries read the same facts, and the planner knows the dimensions' size."""
    key = (spark._jsparkSession.hashCode(), shared_dir(spark), sf, *[changed(spark, f"{sf}/{t}.parquet") for t in ("orders", "lineitem", "customer", "part")])
    if key not in STARS or not changed(spark, STARS[key][0].inputFiles()[0]):
        rows = stored(contract(spark, sf), "requests")
        made = {"agencies": dim_agency(rows), "locations": dim_location(rows), "types": dim_type(rows)}
        dims = Dims(dim_date(spark, START, END, AS_OF), *[stored(d, name) for name, d in made.items()])
        STARS[key] = stored(fact(rows, dims), "facts"), dims
    return STARS[key]


def changed(spark: SparkSession, path: str) -> int:
    """When a file or folder was changed last; 0 if there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(place).getModificationTime() if fs.exists(place) else 0


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Requests as raw text, with blanks, odd spellings and malformed values."""
    k = F.col("unique_key")
    stamp = lambda c: F.date_format(c, DATE_FORMAT)
    area = F.when(k % 10 == 0, F.lit(None)).when(k % 10 == 1, "").when(k % 10 == 2, "Unspecified").when(k % 10 == 3, " bronx ").when(k % 10 == 4, "Queens").when(k % 10 == 5, "MANHATTAN").otherwise(F.col("borough"))
    zips = F.when(k % 13 == 0, F.lit(None)).when(k % 13 == 1, "").when(k % 13 == 2, "123").when(k % 13 == 3, "11201-12").otherwise((F.lit(10000) + k % 1700).cast("string"))
    city = F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, "").when(k % 7 == 2, " Astoria ").when(k % 7 == 3, "chelsea").otherwise(F.col("city"))
    status = F.when(k % 11 == 0, F.lit(None)).when(k % 11 == 1, "Open").when(k % 11 == 2, "Closed - Duplicate").otherwise(F.col("status"))
    closed = F.when(k % 17 == 0, "").when(k % 17 == 1, "not a date").otherwise(stamp(F.col("closed_date")))
    text = F.when(k % 5 == 0, F.lit(None)).when(k % 5 == 1, "").otherwise(F.concat(F.lit(" done "), F.col("descriptor")))
    address = F.when(k % 6 == 0, F.lit(None)).when(k % 6 == 1, "W 5 ST INTERSECTION").when(k % 6 == 2, "10 BLOCK").when(k % 6 == 3, "").otherwise(F.concat((k % 90).cast("string"), F.lit(" main st")))
    lat = F.when(k % 8 == 0, "").when(k % 8 == 1, "NaN").when(k % 8 == 2, "0").when(k % 8 == 3, "bad").otherwise((F.lit(40.3) + (k % 700) / 1000.0).cast("string"))
    lon = F.when(k % 9 == 0, F.lit(None)).otherwise((F.lit(-74.4) + (k % 800) / 1000.0).cast("string"))
    return requests(spark, sf).select(
        k.cast("string").alias("unique_key"), stamp(F.col("created_date")).alias("created_date"), closed.alias("closed_date"), "agency", F.concat(F.lit(" "), F.lower("agency")).alias("agency_name"), F.when(k % 19 == 0, "").otherwise(F.concat(F.col("complaint_type"), F.lit(" "))).alias("complaint_type"),
        F.when(k % 4 > 0, F.col("descriptor")).alias("descriptor"), F.when(k % 3 > 0, "Street").alias("location_type"), zips.alias("incident_zip"), address.alias("incident_address"), city.alias("city"), F.lit("raw").alias("address_type"), status.alias("status"),
        text.alias("resolution_description"), stamp(F.col("resolution_action_updated_date")).alias("resolution_action_updated_date"), F.when(k % 2 > 0, "").otherwise(F.col("borough")).alias("community_board"),
        area.alias("borough"), lat.alias("latitude"), lon.alias("longitude"), F.lit("x").alias("due_date"),
    )


def half_up(sql: str) -> str:
    """Make SQL's round() of doubles go by their decimal digits, as Spark's does."""
    out, at = "", 0
    while (k := sql.find("round(", at)) >= 0:
        depth, end = 1, k + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner, _, digits = half_up(sql[k + 6 : end - 1]).rpartition(",")
        out += f"{sql[at:k]}round(({inner})::DECIMAL(38, 9),{digits})::DOUBLE"
        at = end
    return out + sql[at:]


def quoted(names: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in names.items()) + f" ELSE {column} END"


# ---- the same in SQL ----
REQUESTS = f"""
WITH li AS (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, min(p_type) AS ptype FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
req AS (
  SELECT o_orderkey AS unique_key, o_orderdate + to_seconds(o_orderkey * 7919 % 86400) AS created_date,
    CASE WHEN o_orderkey % 10 < 7 THEN o_orderdate + to_seconds(o_orderkey * 7919 % 86400) + to_hours(o_orderkey * 31 % 1200) WHEN o_orderkey % 10 > 7 THEN last_ship END AS closed_date,
    {quoted(STATES, "o_orderstatus")} AS status, c_mktsegment AS agency, r_name AS borough, (10000 + n_nationkey)::VARCHAR AS incident_zip, n_name AS city,
    {quoted(TYPES, "o_orderpriority")} AS complaint_type, ptype AS descriptor, first_ship AS resolution_action_updated_date, o_orderkey % 3 = 0 AS has_resolution
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN li ON l_orderkey = o_orderkey)"""

CAL = f"""
cal AS (
  SELECT d::DATE AS date_actual, (year(d) * 10000 + month(d) * 100 + day(d))::INT AS date_key, year(d)::INT AS year, month(d)::INT AS month, day(d)::INT AS dom,
    (dayofweek(d) + 1)::INT AS dow, quarter(d)::INT AS quarter
  FROM generate_series(TIMESTAMP '{START}', TIMESTAMP '{END}', INTERVAL 1 DAY) t(d)),
hol AS (
  SELECT *, CASE WHEN month = 1 AND dom = 1 THEN 'New Year''s Day' WHEN month = 6 AND dom = 19 THEN 'Juneteenth' WHEN month = 7 AND dom = 4 THEN 'Independence Day' WHEN month = 11 AND dom = 11 THEN 'Veterans Day'
    WHEN month = 12 AND dom = 25 THEN 'Christmas Day' WHEN dow = 2 AND month = 1 AND dom >= 15 AND dom <= 21 THEN 'Martin Luther King Jr. Day' WHEN dow = 2 AND month = 2 AND dom >= 15 AND dom <= 21 THEN 'Presidents'' Day'
    WHEN dow = 2 AND month = 5 AND dom >= 25 THEN 'Memorial Day' WHEN dow = 2 AND month = 9 AND dom <= 7 THEN 'Labor Day' WHEN dow = 2 AND month = 10 AND dom >= 8 AND dom <= 14 THEN 'Columbus Day'
    WHEN dow = 5 AND month = 11 AND dom >= 22 AND dom <= 28 THEN 'Thanksgiving' END AS holiday_name, dow IN (1, 7) AS is_weekend
  FROM cal)"""

KINDS = {"Noise - Residential": "Noise", "Illegal Parking": "Street & Infrastructure", "Heat/Hot Water": "Building & Housing", "Street Condition": "Street & Infrastructure", "Taxi Complaint": "Transportation"}

FACT = f"""{REQUESTS}, {CAL},
flg AS (
  SELECT *, closed_date IS NOT NULL AS is_closed, coalesce(closed_date < created_date, FALSE) AS has_invalid_closed_date, coalesce(year(closed_date) < {MIN_YEAR}, FALSE) AS has_historical_closed_date,
    coalesce(closed_date > DATE '{AS_OF}' + 30, FALSE) AS has_future_closed_date FROM req),
ag AS (SELECT row_number() OVER (ORDER BY a) AS agency_id, a AS agency_code FROM (SELECT DISTINCT upper(trim(agency)) AS a FROM req)),
loc AS (SELECT row_number() OVER (ORDER BY b, z) AS location_id, b, z FROM (SELECT DISTINCT upper(borough) AS b, incident_zip AS z FROM req)),
fct AS (
  SELECT unique_key, agency_id AS agency_key, location_id AS location_key, sha256(concat_ws('|', upper(complaint_type), upper(coalesce(descriptor, 'NO DESCRIPTOR')))) AS complaint_type_key,
    (year(created_date) * 10000 + month(created_date) * 100 + day(created_date))::INT AS created_date_key, (year(closed_date) * 10000 + month(closed_date) * 100 + day(closed_date))::INT AS closed_date_key,
    upper(borough) AS borough, upper(city) AS city, upper(agency) AS agency_code, upper(complaint_type) AS complaint_type, upper(coalesce(descriptor, 'NO DESCRIPTOR')) AS descriptor,
    year(created_date)::INT AS created_year, month(created_date)::INT AS created_month, hour(created_date)::INT AS created_hour, hour(created_date) BETWEEN 9 AND 17 AND dayofweek(created_date) BETWEEN 1 AND 5 AS is_business_hours,
    coalesce(is_weekend, FALSE) AS is_created_on_weekend, holiday_name IS NOT NULL AS is_created_on_holiday, coalesce(NOT is_weekend AND holiday_name IS NULL, TRUE) AS is_created_on_business_day,
    (year + (month >= 7)::INT)::INT AS created_fiscal_year,
    CASE WHEN closed_date >= created_date AND NOT (has_invalid_closed_date OR has_historical_closed_date OR has_future_closed_date) THEN ((epoch(closed_date) - epoch(created_date))::BIGINT * 100 + 1800) // 3600 / 100::DOUBLE END AS response_time_hours,
    CASE WHEN closed_date >= created_date AND NOT (has_invalid_closed_date OR has_historical_closed_date OR has_future_closed_date) THEN ((epoch(closed_date) - epoch(created_date))::BIGINT * 100 + 43200) // 86400 / 100::DOUBLE END AS response_time_days,
    CASE WHEN NOT is_closed THEN 'OPEN' WHEN has_invalid_closed_date OR has_historical_closed_date OR has_future_closed_date THEN 'INVALID_DATE' WHEN closed_date::DATE = created_date::DATE THEN 'SAME_DAY'
      WHEN closed_date::DATE - created_date::DATE <= 7 THEN 'WITHIN_WEEK' WHEN closed_date::DATE - created_date::DATE <= 30 THEN 'WITHIN_MONTH' ELSE 'OVER_MONTH' END AS response_sla_category,
    status, is_closed, has_resolution, has_invalid_closed_date, has_historical_closed_date, has_future_closed_date, status = 'CLOSED' AND NOT is_closed AS has_closed_status_without_date,
      status IN ('OPEN', 'PENDING') AND is_closed AS open_status_with_closed_date,
    {quoted(KINDS, "complaint_type")} AS complaint_category, date_actual, year, month, dow, dom, is_weekend, holiday_name
  FROM flg JOIN ag ON ag.agency_code = upper(trim(agency)) JOIN loc ON loc.b = upper(borough) AND loc.z = incident_zip LEFT JOIN hol ON date_actual = created_date::DATE),
v AS (
  SELECT *, created_date_key AS date_key, CASE WHEN response_sla_category <> 'INVALID_DATE' THEN response_sla_category END AS sla, response_time_hours AS vh, response_time_days AS vd
  FROM fct WHERE date_actual IS NOT NULL)"""
