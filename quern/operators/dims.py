"""The star schema's dimensions and keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import lookups
from quern.functions.metrics import any_like
from quern.functions.shared import stored


def date_key(c: Column) -> Column:
    """yyyyMMdd as an integer."""
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def location_parts(area: str = "borough", zip_code: str = "incident_zip") -> tuple[Column, Column]:
    """Area and ZIP code as keys, for the dimension and the fact alike."""
    part = lambda c, default: F.upper(F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit(default)))
    return part(area, "UNSPECIFIED"), part(zip_code, "NO_ZIP")


def type_parts() -> tuple[Column, Column]:
    return F.upper(F.coalesce("complaint_type", F.lit("UNSPECIFIED"))), F.upper(F.coalesce("descriptor", F.lit("NO DESCRIPTOR")))


def type_key() -> Column:
    return F.sha2(F.concat_ws("|", *type_parts()), 256)


def surrogate_key(distinct: DataFrame, columns: list[str], name: str, existing: DataFrame | None = None) -> DataFrame:
    """Number distinct members from 1 in the order of ``columns``; members of ``existing`` keep their numbers.

    The numbers of ranges are counted range by range, so no task sorts all members. The members are stored with
    their ranges, so that a lost executor cannot deal them anew.
    """
    if existing is not None:
        known = distinct.join(existing.select(*columns, name), columns)
        new = surrogate_key(distinct.join(existing, columns, "left_anti"), columns, name)
        last = existing.agg(F.coalesce(F.max(name), F.lit(0)).alias("__last"))
        # a scalar aggregate: one row
        return known.unionByName(new.join(F.broadcast(last)).withColumn(name, F.col(name) + F.col("__last")).drop("__last"))
    ranged = distinct.repartitionByRange(*columns).withColumn("__range", F.spark_partition_id())
    ranged = stored(ranged, "members")
    counts = ranged.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    inside = F.row_number().over(Window.partitionBy("__range").orderBy(*columns))
    return ranged.withColumn("__inside", inside).join(F.broadcast(before), "__range").withColumn(name, (F.col("__before") + F.col("__inside")).cast("long")).drop("__range", "__inside", "__before")


def holiday(d: Column) -> Column:
    """The name of the public holiday; those by weekday fall into a week of the month."""
    month, day, weekday = F.month(d), F.dayofmonth(d), F.dayofweek(d)
    fixed = {(1, 1): "New Year's Day", (6, 19): "Juneteenth", (7, 4): "Independence Day", (11, 11): "Veterans Day", (12, 25): "Christmas Day"}
    floating = [(1, 2, 15, "Martin Luther King Jr. Day"), (2, 2, 15, "Presidents' Day"), (5, 2, 25, "Memorial Day"), (9, 2, 1, "Labor Day"), (10, 2, 8, "Columbus Day"), (11, 5, 22, "Thanksgiving")]
    named = [F.when((month == m) & (day == k), name) for (m, k), name in fixed.items()]
    named += [F.when((month == m) & (weekday == w) & day.between(first, first + 6), name) for m, w, first, name in floating]
    return F.coalesce(*named)


def season(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, ["Winter", "Spring", "Summer", "Fall"])), (F.floor(month % 12 / 3) + 1).cast("int"))


def relative(d: Column, as_of: str) -> Column:
    ago = F.datediff(F.lit(as_of).cast("date"), d)
    steps = F.when(ago == 0, "Today").when(ago == 1, "Yesterday").when(ago == -1, "Tomorrow").when(ago < 0, "Future")
    return steps.when(ago <= 7, "Last 7 Days").when(ago <= 30, "Last 30 Days").when(ago <= 90, "Last 90 Days").otherwise("Past")


def dim_date(spark: SparkSession, start: str, end: str, as_of: str) -> DataFrame:
    """One row for each day from ``start`` to ``end``."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("date_actual"))
    d = F.col("date_actual")
    year, month, quarter = F.year(d), F.month(d), F.quarter(d)
    fiscal, fiscal_quarter = year + F.when(month >= 7, 1).otherwise(0), (quarter + 1) % 4 + 1
    weekend, free = F.dayofweek(d).isin(1, 7), holiday(d)
    return days.select(
        date_key(d).alias("date_key"), "date_actual", year.alias("year"), quarter.alias("quarter"), F.format_string("Q%d-%d", quarter, year).alias("quarter_name"), month.alias("month"),
        F.date_format(d, "MMMM").alias("month_name"), F.date_format(d, "MMM").alias("month_short"), F.date_format(d, "yyyy-MM").alias("year_month"), F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"), F.dayofweek(d).alias("day_of_week_num"), F.date_format(d, "EEEE").alias("day_name"), F.date_format(d, "EEE").alias("day_short"), F.dayofyear(d).alias("day_of_year"),
        weekend.alias("is_weekend"), fiscal.alias("fiscal_year"), fiscal_quarter.alias("fiscal_quarter"), free.alias("holiday_name"), (~weekend).alias("is_weekday"),
        F.format_string("FY%d", fiscal).alias("fiscal_year_name"), F.format_string("FY%d-Q%d", fiscal, fiscal_quarter).alias("fiscal_period"), free.isNotNull().alias("is_holiday"),
        (~weekend & free.isNull()).alias("is_business_day"), relative(d, as_of).alias("relative_date"), season(month).alias("season"),
    )


def dim_agency(df: DataFrame, names: dict[str, str] = lookups.AGENCY_NAMES, groups: dict[str, str] = lookups.AGENCY_GROUPS, existing: DataFrame | None = None) -> DataFrame:
    """Agencies, normalised before they are made distinct, so that two spellings are one member."""
    distinct = df.where(F.col("agency").isNotNull()).select(F.upper(F.trim("agency")).alias("agency_key")).distinct()
    named = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])[F.col("agency_key")]
    grouped = F.create_map(*[F.lit(x) for group, codes in groups.items() for code in codes.split() for x in (code, group)])[F.col("agency_key")]
    return surrogate_key(distinct, ["agency_key"], "agency_id", existing).select("agency_id", "agency_key", F.coalesce(named, "agency_key").alias("agency_name"), F.coalesce(grouped, F.lit("Other")).alias("agency_category"))


def dim_location(df: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    area, zip_code = location_parts()
    distinct = df.select(area.alias("borough"), zip_code.alias("zip_code")).distinct()
    b, z = F.col("borough"), F.col("zip_code")
    key = F.concat_ws("|", b, z)
    regions = {"Manhattan": "^10[012]", "Bronx": "^104", "Staten Island": "^103", "Brooklyn": "^112", "Queens": "^11[13456]"}
    region = F.coalesce(*[F.when(z.rlike(p), name) for name, p in regions.items()], F.when(z == "NO_ZIP", "Unknown"), F.lit("Other"))
    group = F.when(b.isin("MANHATTAN", "BROOKLYN"), "Core Boroughs").when(b.isin("QUEENS", "BRONX", "STATEN ISLAND"), "Outer Boroughs").when(b == "UNSPECIFIED", "Unspecified").otherwise("Other")
    has, specified = z != "NO_ZIP", b != "UNSPECIFIED"
    quality = F.element_at(F.array(F.lit("Incomplete"), F.lit("Partial"), F.lit("Complete")), has.cast("int") + specified.cast("int") + 1)
    return surrogate_key(distinct, ["borough", "zip_code"], "location_id", existing).select(
        "location_id", "borough", "zip_code", key.alias("location_key"), F.md5(key).alias("location_hash"), group.alias("borough_category"), region.alias("zip_region"), has.alias("has_zip"), specified.alias("is_specified"), quality.alias("data_quality")
    )


def classify(c: Column, rules: list = lookups.TYPE_RULES, default: str = "Other") -> Column:
    """The first rule that fits an upper-cased text."""
    named = []
    for name, parts, whole, unless in rules:
        tests = [any_like(c, parts)] if parts else []
        tests += [c.isin(whole)] if whole else []
        tests += [c.contains(a) & ~c.contains(b) for a, b in unless.items()]
        named.append(F.when(reduce(lambda a, b: a | b, tests), name))
    return F.coalesce(*named, F.lit(default))


def dim_type(df: DataFrame, rules: list = lookups.TYPE_RULES) -> DataFrame:
    """Types with their category; the rules run on the distinct values only."""
    kind, descriptor = type_parts()
    distinct = df.select(kind.alias("complaint_type"), descriptor.alias("descriptor")).distinct().withColumn("complaint_type_key", F.sha2(F.concat_ws("|", "complaint_type", "descriptor"), 256))
    c = F.col("complaint_type")
    return distinct.select(
        "complaint_type_key", "complaint_type", "descriptor", classify(c, rules).alias("complaint_category"), any_like(c, lookups.MALICIOUS).alias("is_malicious_data"), (any_like(c, lookups.TESTS[0]) | c.isin(lookups.TESTS[1])).alias("is_test_data")
    )
