"""Dimensions on rows that hit their names, groups, regions and flags; and what cleaning drops."""

import pytest
from pyspark.sql import functions as F

from quern.functions import lookups
from quern.operators import dims, silver


@pytest.mark.parametrize(
    "code, name, group",
    [
        ("NYPD", "New York Police Department", "Public Safety"), ("DSNY", "Department of Sanitation", "City Services"), ("DEP", "Department of Environmental Protection", "Environment & Utilities"),
        ("DFTA", "Department for the Aging", "Social Services"), ("DOE", "Department of Education", "Education"), ("DOHMH", "Department of Health and Mental Hygiene", "Health"), ("TLC", "Taxi and Limousine Commission", "Regulatory & Licensing"),
        ("3-1-1", "311 Customer Service Center", "Administration & Technology"), ("HPD", "Housing Preservation and Development", "Housing"), ("OTHER", "Other Agencies", "Other"), ("XYZ", "XYZ", "Other"),
    ],
)
def test_agency(spark, code, name, group):
    r = dims.dim_agency(spark.createDataFrame([(f" {code.lower()} ",), (code,)], "agency string")).collect()
    assert [(x.agency_key, x.agency_name, x.agency_category) for x in r] == [(code, name, group)]


@pytest.mark.parametrize(
    "area, code, want",
    [
        ("MANHATTAN", "10001", ("Core Boroughs", "Manhattan", True, True, "Complete")), ("BROOKLYN", "11201", ("Core Boroughs", "Brooklyn", True, True, "Complete")), ("BRONX", "10451", ("Outer Boroughs", "Bronx", True, True, "Complete")),
        ("QUEENS", "11385", ("Outer Boroughs", "Queens", True, True, "Complete")), ("STATEN ISLAND", "10301", ("Outer Boroughs", "Staten Island", True, True, "Complete")), ("QUEENS", None, ("Outer Boroughs", "Unknown", False, True, "Partial")),
        (None, "11201", ("Unspecified", "Brooklyn", True, False, "Partial")), (None, None, ("Unspecified", "Unknown", False, False, "Incomplete")), ("ELSEWHERE", "99999", ("Other", "Other", True, True, "Complete")),
    ],
)
def test_location(spark, area, code, want):
    r = dims.dim_location(spark.createDataFrame([(area, code)], "borough string, incident_zip string")).first()
    assert (r.borough_category, r.zip_region, r.has_zip, r.is_specified, r.data_quality) == want
    assert r.location_key == f"{area or 'UNSPECIFIED'}|{code or 'NO_ZIP'}"


@pytest.mark.parametrize("kind, category, malicious, test", [("X WINDOWS\\WIN.INI", "Data Quality Issue", True, False), ("NSLOOKUP Y", "Data Quality Issue", True, False), ("ECHO A", "Data Quality Issue", False, False), ("ZTESTINT", "Internal/Test Data", False, True), ("ATF", "Internal/Test Data", False, False), ("NOISE", "Noise", False, False)])
def test_type_flags(spark, kind, category, malicious, test):
    r = dims.dim_type(spark.createDataFrame([(kind, "D")], "complaint_type string, descriptor string")).first()
    assert (r.complaint_category, r.is_malicious_data, r.is_test_data) == (category, malicious, test)


def test_every_rule_is_met_by_its_own_values(spark):
    """Each whole value and substring of a rule gets its category, or that of an earlier rule that fits it as well."""
    order = {name: i for i, (name, *_) in enumerate(lookups.TYPE_RULES)}
    cases = [(v.replace("%", " "), name) for name, parts, whole, _ in lookups.TYPE_RULES for v in [*parts, *whole]]
    got = spark.createDataFrame(cases, "c string, name string").select("c", "name", dims.classify(F.col("c")).alias("k")).collect()
    assert len(got) > 200 and all(order[r.k] <= order[r.name] for r in got)
    assert sum(r.k == r.name for r in got) > 0.7 * len(got)


def test_zip_codes(spark):
    rows = {r.zip: r.zip_area for r in lookups.zip_areas(spark).collect()}
    assert len([z for z, a in rows.items() if a == "QUEENS"]) == 64 and rows["11004"] == "QUEENS" and "11241" not in rows and rows["11256"] == "BROOKLYN" and rows["10282"] == "MANHATTAN"


def test_the_location_struct_is_dropped(spark):
    """Its coordinates are read nowhere else: the plain columns win, and the struct goes."""
    from tests.test_rules import frame

    df = frame(spark, {"latitude": "40.7", "longitude": "-74.0"}).withColumn("location", F.struct(F.lit("1").alias("latitude"), F.lit("2").alias("longitude"), F.lit("{}").alias("human_address")))
    out = silver.silver(df, "2024-06-01")
    assert "location" not in out.columns and (out.first().latitude, out.first().longitude) == (40.7, -74.0)


def test_provenance_by_value(spark, tmp_path):
    import os

    from quern.sources.landing import with_provenance

    spark.range(3).coalesce(1).write.parquet(str(tmp_path / "t"))
    file = next(f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet"))
    rows = with_provenance(spark.read.parquet(str(tmp_path / "t"))).collect()
    status = os.stat(tmp_path / "t" / file)
    assert len(rows) == 3
    for r in rows:
        assert r._source_file.endswith(file) and r._file_size == status.st_size and r._ingested_at is not None
        assert abs(r._file_modification_time.timestamp() - status.st_mtime) < 86_400


def test_actual_and_forecast_are_matched_by_date(spark):
    """Days that only one side has do not count."""
    from quern.operators import forecast

    actual = spark.createDataFrame([("2024-01-01", 10), ("2024-01-02", 20), ("2024-01-03", 30)], "ds string, y int")
    told = spark.createDataFrame([("2024-01-02", 22.0), ("2024-01-03", 27.0), ("2024-01-04", 1.0)], "ds string, yhat double")
    r = forecast.accuracy(actual.join(told, "ds")).first()
    assert (r.n, r.mae, r.smape, r.mdape) == (2, 2.5, round((2 * 200 / 42 + 3 * 200 / 57) / 2, 4), 10.0)


def test_queries_read_stored_dimensions(spark, sf):
    """No query makes a dimension anew from the requests, and joins with one are broadcast."""
    from quern.plans import quality
    from quern.plans.views import star

    _, d = star(spark, sf)
    assert [name for name in ("agency", "location", "kind") if any("quern-requests" in f for f in getattr(d, name).inputFiles())] == []
    plan = quality.category_sla(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "sha2" not in plan


def test_type_keys_are_made_of_distinct_types(spark):
    rows = spark.createDataFrame([("a", "x"), ("A", "x"), (None, None), ("b|c", "d"), ("b|c", "d")], "complaint_type string, descriptor string")
    got = {(r.complaint_type, r.descriptor): r.complaint_type_key for r in dims.dim_type(rows).collect()}
    assert set(got) == {("A", "X"), ("UNSPECIFIED", "NO DESCRIPTOR"), ("B|C", "D")}
    assert set(got.values()) == {r[0] for r in rows.select(dims.type_key()).collect()}
    lines = dims.dim_type(rows)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    made = next(i for i, line in enumerate(lines) if "Aggregate" in line)
    assert "sha2" in "".join(lines[: made + 1]) and "sha2" not in "".join(lines[made + 1 :])
