"""Cleaning of raw requests: each rule is a function from DataFrame to DataFrame; ``silver`` is their chain.

Batch and stream run the same functions. Lookups are joined by broadcast: their size is that of the fixed tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import lookups

# Columns that are mostly empty, defaults, states and the bounds of the coordinates.
SPARSE = "_rescued_data taxi_company_borough road_ramp bridge_highway_direction bridge_highway_name bridge_highway_segment taxi_pick_up_location vehicle_type due_date facility_type _file_modification_time _file_size".split()
DATES = ["created_date", "closed_date", "resolution_action_updated_date"]
DATE_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS"
DEFAULTS = {"complaint_type": "UNKNOWN", "descriptor": "NO_DESCRIPTION", "location_type": "NOT_PROVIDED", "status": "UNKNOWN"}
PLAIN = ["agency_name", "incident_address", "street_name", "cross_street_1", "cross_street_2", "intersection_street_1", "intersection_street_2", "landmark"]
NUMBERS = ["latitude", "longitude", "x_coordinate_state_plane", "y_coordinate_state_plane"]
UNRESOLVED = ["OPEN", "ASSIGNED", "PENDING", "IN PROGRESS", "STARTED"]
OPEN_STATES = ["OPEN", "IN PROGRESS", "PENDING", "ASSIGNED"]
BOUNDS = {"latitude": (40.477399, 40.917577), "longitude": (-74.259090, -73.700009)}


def blank(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def tidy(c: str) -> Column:
    return F.upper(F.trim(F.col(c)))


def present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def drop_sparse(df: DataFrame, names: list[str] = SPARSE) -> DataFrame:
    return df.drop(*names)


def parse_dates(df: DataFrame, names: list[str] = DATES, pattern: str = DATE_FORMAT) -> DataFrame:
    """Text to timestamp; empty and unparsable text gives null."""
    return df.withColumns({n: F.when(~blank(n), F.try_to_timestamp(F.col(n), F.lit(pattern))) for n in present(df, names)})


def date_flags(df: DataFrame, as_of: str, min_year: int = 2010) -> DataFrame:
    """Flags of the closing date as it came: before creation, before ``min_year``, over 30 days after ``as_of``."""
    closed, created = F.col("closed_date"), F.col("created_date")
    late = closed.cast("timestamp") > F.date_add(F.lit(as_of).cast("date"), 30).cast("timestamp")
    false = F.lit(False)
    return df.withColumns(
        {"has_invalid_closed_date": F.coalesce(closed < created, false), "has_historical_closed_date": F.coalesce(F.year(closed) < min_year, false), "has_future_closed_date": F.coalesce(late, false)}
    )


def recover_area(df: DataFrame, zips: DataFrame | None = None, places: DataFrame | None = None) -> DataFrame:
    """The area as given if it is one of the known; else by ZIP code, else by place name, else UNSPECIFIED."""
    spark = df.sparkSession
    zips, places = zips or lookups.zip_areas(spark), places or lookups.place_areas(spark)
    joined = df.join(F.broadcast(zips), F.col("incident_zip") == F.col("zip"), "left").join(F.broadcast(places), tidy("city") == F.col("place"), "left")
    known = F.when((F.col("borough") != "Unspecified") & tidy("borough").isin(lookups.AREAS), tidy("borough"))
    return joined.withColumn("borough", F.coalesce(known, "zip_area", "place_area", F.lit("UNSPECIFIED"))).drop("zip", "zip_area", "place", "place_area")


def fill_city(df: DataFrame, names: dict[str, str] = lookups.CITY_OF_AREA) -> DataFrame:
    by_area = F.coalesce(F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("borough")], F.lit("UNKNOWN"))
    return df.withColumn("city", F.when(blank("city"), by_area).otherwise(tidy("city")))


def infer_closed(df: DataFrame, as_of: str) -> DataFrame:
    """A closed request without a date takes that of its last action, if it lies between creation and ``as_of``."""
    action = F.col("resolution_action_updated_date")
    fits = F.upper("status").startswith("CLOSED") & F.col("closed_date").isNull() & (action >= F.col("created_date")) & (action.cast("timestamp") <= F.lit(as_of).cast("date").cast("timestamp"))
    return df.withColumn("closed_date_original", F.col("closed_date")).withColumns(
        {
            "closed_date": F.when(fits, action).otherwise(F.col("closed_date")),
            "closed_date_source": F.when(F.col("closed_date").isNotNull(), "ORIGINAL").when(fits, "INFERRED_FROM_RESOLUTION").otherwise("MISSING"),
        }
    )


def sequence_column(df: DataFrame) -> DataFrame:
    created = F.col("created_date")
    return df.withColumn("updated_date", F.greatest(created, F.coalesce("closed_date", created), F.coalesce("resolution_action_updated_date", created)))


def numbers(df: DataFrame, names: list[str] = NUMBERS) -> DataFrame:
    """Text to double, null where it is none; the nested location is read and dropped."""
    return df.withColumns({n: F.when(~blank(n), F.col(n).try_cast("double")) if dict(df.dtypes)[n] == "string" else F.col(n).cast("double") for n in present(df, names)}).drop("location")


def partition_columns(df: DataFrame) -> DataFrame:
    c = F.col("created_date")
    return df.withColumns({"created_year": F.coalesce(F.year(c), F.lit(1900)), "created_month": F.coalesce(F.month(c), F.lit(1)), "created_day": F.coalesce(F.dayofmonth(c), F.lit(1))})


def resolution_text(df: DataFrame) -> DataFrame:
    """Runs before the status is upper-cased, so states in other case count as resolved."""
    c = "resolution_description"
    return df.withColumn(c, F.when(~blank(c), tidy(c)).when(~F.coalesce(F.col("status").isin(UNRESOLVED), F.lit(False)), "NO_RESOLUTION_INFO"))


def categories(df: DataFrame, defaults: dict[str, str] = DEFAULTS) -> DataFrame:
    return df.withColumns({n: F.when(blank(n), default).otherwise(tidy(n)) for n, default in defaults.items() if n in df.columns})


def classify_address(df: DataFrame) -> DataFrame:
    c = F.col("incident_address")
    return df.withColumn("address_type", F.when(blank("incident_address"), "NOT_PROVIDED").when(c.contains("INTERSECTION"), "INTERSECTION").when(c.contains("BLOCK"), "BLOCK").otherwise("ADDRESS"))


def plain_strings(df: DataFrame, names: list[str] = PLAIN) -> DataFrame:
    return df.withColumns({n: F.when(~blank(n), tidy(n)) for n in present(df, names)})


def check_coordinates(df: DataFrame, bounds: dict[str, tuple[float, float]] = BOUNDS) -> DataFrame:
    return df.withColumns({n: F.when(~F.isnan(n) & (F.col(n) != 0) & F.col(n).between(lo, hi), F.col(n)) for n, (lo, hi) in bounds.items()})


def check_zip(df: DataFrame) -> DataFrame:
    return df.withColumn("incident_zip", F.when(F.col("incident_zip").rlike("^[0-9]{5}$"), F.col("incident_zip")))


def empty_to_null(df: DataFrame, names: tuple[str, ...] = ("community_board",)) -> DataFrame:
    return df.withColumns({n: F.nullif(F.col(n), F.lit("")) for n in present(df, list(names))})


def quality_flags(df: DataFrame) -> DataFrame:
    closed = F.col("closed_date").isNotNull()
    text = F.col("resolution_description")
    return df.withColumns(
        {
            "has_valid_location": F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
            "has_resolution": F.coalesce(text != "NO_RESOLUTION_INFO", F.lit(False)),
            "is_closed": closed,
            "has_valid_zip": F.col("incident_zip").isNotNull(),
            "has_closed_status_without_date": F.coalesce(F.col("status").startswith("CLOSED") & ~closed, F.lit(False)),
            "open_status_with_closed_date": F.coalesce(F.col("status").isin(OPEN_STATES) & closed, F.lit(False)),
        }
    )


def silver(df: DataFrame, as_of: str, min_year: int = 2010, stamp: Column | None = None) -> DataFrame:
    """The whole cleaning; the order of its steps matters."""
    out = parse_dates(drop_sparse(df))
    out = date_flags(out, as_of, min_year)
    out = sequence_column(infer_closed(fill_city(recover_area(out)), as_of))
    out = resolution_text(partition_columns(numbers(out)))
    out = empty_to_null(check_zip(check_coordinates(plain_strings(classify_address(categories(out))))))
    return quality_flags(out).withColumn("_unified_processed_timestamp", F.current_timestamp() if stamp is None else stamp)
