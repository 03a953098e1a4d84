"""The fact table: one row for each request."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators import dims as D


@dataclass
class Dims:
    """The four dimensions; each is small against the facts, and is left to the planner's size check for broadcast."""

    date: DataFrame
    agency: DataFrame
    location: DataFrame
    kind: DataFrame


def flagged() -> Column:
    return F.col("has_invalid_closed_date") | F.col("has_historical_closed_date") | F.col("has_future_closed_date")


def seconds_between(a: str, b: str) -> Column:
    return F.unix_timestamp(F.col(b).cast("timestamp")) - F.unix_timestamp(F.col(a).cast("timestamp"))


def response_time(unit_seconds: int) -> Column:
    """From creation to closing, rounded half up in whole numbers; only of closed requests with sound dates."""
    sound = F.col("is_closed") & ~flagged() & (F.col("closed_date") >= F.col("created_date"))
    hundredths = F.floor((seconds_between("created_date", "closed_date") * 100 + unit_seconds // 2) / unit_seconds)
    return F.when(sound, hundredths / 100.0)


def sla_category() -> Column:
    days = F.datediff("closed_date", "created_date")
    ladder = F.when(~F.col("is_closed"), "OPEN").when(F.col("closed_date").isNull(), "NO_DATE").when(flagged(), "INVALID_DATE").when(F.col("closed_date") < F.col("created_date"), "NEGATIVE_TIME")
    return ladder.when(days == 0, "SAME_DAY").when(days <= 7, "WITHIN_WEEK").when(days <= 30, "WITHIN_MONTH").otherwise("OVER_MONTH")


def business_hours() -> Column:
    c = F.col("created_date")
    return F.coalesce(F.hour(c).between(9, 17) & F.dayofweek(c).between(2, 6), F.lit(False))


KEPT = """status is_closed has_resolution resolution_description resolution_action_updated_date latitude longitude location_type has_valid_location
    incident_zip incident_address community_board bbl x_coordinate_state_plane y_coordinate_state_plane closed_date_source has_invalid_closed_date
    has_historical_closed_date has_future_closed_date closed_date_original has_valid_zip has_closed_status_without_date open_status_with_closed_date
    open_data_channel_type _source_file _ingested_at _unified_processed_timestamp""".split()


def fact(silver: DataFrame, dims: Dims) -> DataFrame:
    """Facts with surrogate keys, attributes of the day, response times and the SLA class."""
    area, zip_code = D.location_parts()
    name = lambda c, default: F.upper(F.coalesce(c, F.lit(default)))
    base = silver.withColumns({"__agency": F.upper(F.trim("agency")), "__area": area, "__zip": zip_code, "complaint_type_key": D.type_key(), "created_date_key": D.date_key(F.col("created_date")), "closed_date_key": D.date_key(F.col("closed_date"))})
    agency = dims.agency.select(F.col("agency_key").alias("__agency"), F.col("agency_id").alias("agency_key"))
    location = dims.location.select(F.col("borough").alias("__area"), F.col("zip_code").alias("__zip"), F.col("location_id").alias("location_key"))
    kind = dims.kind.select("complaint_type_key", F.lit(True).alias("__known"))
    day = dims.date.select(F.col("date_key").alias("created_date_key"), "fiscal_year", "is_weekend", "is_holiday", "is_business_day")
    joined = base.join(agency, "__agency", "left").join(location, ["__area", "__zip"], "left").join(kind, "complaint_type_key", "left").join(day, "created_date_key", "left")
    created = F.col("created_date")
    return joined.select(
        "unique_key", "agency_key", "location_key", F.when(F.col("__known"), F.col("complaint_type_key")).alias("complaint_type_key"), "created_date_key", "closed_date_key",
        name("borough", "UNSPECIFIED").alias("borough"), name("city", "UNKNOWN").alias("city"), name("agency", "UNKNOWN").alias("agency_code"), name("complaint_type", "UNKNOWN").alias("complaint_type"), name("descriptor", "NO DESCRIPTOR").alias("descriptor"),
        F.year(created).alias("created_year"), F.month(created).alias("created_month"), F.hour(created).alias("created_hour"), business_hours().alias("is_business_hours"),
        F.coalesce("is_weekend", F.lit(False)).alias("is_created_on_weekend"), F.coalesce("is_holiday", F.lit(False)).alias("is_created_on_holiday"), F.coalesce("is_business_day", F.lit(True)).alias("is_created_on_business_day"), F.col("fiscal_year").alias("created_fiscal_year"),
        response_time(3600).alias("response_time_hours"), response_time(86400).alias("response_time_days"), sla_category().alias("response_sla_category"),
        *[c for c in KEPT if c in silver.columns],
    )


def valid_measures(facts: DataFrame, null_open: bool = False) -> DataFrame:
    """Add the response times and SLA class that count: of sound closed requests only."""
    bad = ["INVALID_DATE", "NEGATIVE_TIME", "NO_DATE", *(["OPEN"] if null_open else [])]
    valid = lambda c: F.when(F.col("is_closed") & ~flagged() & (F.col(c) >= 0), F.col(c))
    return facts.withColumns({"valid_hours": valid("response_time_hours"), "valid_days": valid("response_time_days"), "valid_sla": F.when(~F.col("response_sla_category").isin(bad), F.col("response_sla_category"))})
