"""The rules on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from quern.operators import checks, dims, impact, marts, silver, upsert, versions
from quern.operators.fact import Dims, fact, sla_category
from quern.sources import landing
from quern.streaming import requests as stream

BASE = dict(unique_key="1", created_date="2024-01-01T10:00:00.000", closed_date=None, agency="DOT", complaint_type="Noise", descriptor=None, status="OPEN", borough=None, incident_zip=None, city=None, incident_address=None, resolution_description=None, resolution_action_updated_date=None, latitude=None, longitude=None)


def frame(spark, *rows):
    schema = ", ".join(f"{c} string" for c in BASE)
    return spark.createDataFrame([tuple((BASE | r | {"unique_key": r.get("unique_key", str(i))}).values()) for i, r in enumerate(rows)], schema)


def column(df, name):
    return [r[name] for r in df.orderBy(F.col("unique_key").cast("int")).collect()]


def test_dates(spark):
    df = silver.parse_dates(frame(spark, *[{"created_date": c} for c in ("2024-01-01T00:00:00.000", "", None, "bad")]))
    assert [x is not None for x in column(df, "created_date")] == [True, False, False, False]


def test_address_and_zip_and_bounds(spark):
    df = frame(spark, *[{"incident_address": a} for a in ("W 5 ST INTERSECTION", "10 BLOCK", "1 main st", "intersection", "")])
    assert column(silver.classify_address(df), "address_type") == ["INTERSECTION", "BLOCK", "ADDRESS", "ADDRESS", "NOT_PROVIDED"]
    assert column(silver.check_zip(frame(spark, *[{"incident_zip": z} for z in ("10001", "1000", "10001-1234", "")])), "incident_zip") == ["10001", None, None, None]
    lat = silver.check_coordinates(silver.numbers(frame(spark, *[{"latitude": x} for x in ("40.477399", "40.477398", "0", "NaN", None, "x")])))
    assert column(lat, "latitude") == [40.477399, None, None, None, None, None]


def test_area_recovery(spark):
    zips = ["10282", "10283", "11241", "11385", "10314", "10315"]
    assert column(silver.recover_area(frame(spark, *[{"incident_zip": z} for z in zips])), "borough") == ["MANHATTAN", "UNSPECIFIED", "UNSPECIFIED", "QUEENS", "STATEN ISLAND", "UNSPECIFIED"]
    rows = [{"borough": "bronx "}, {"borough": "Unspecified", "incident_zip": "11201"}, {"city": "Dumbo"}, {"borough": "X"}, {"city": " chelsea "}, {"city": "nowhere"}]
    assert column(silver.recover_area(frame(spark, *rows)), "borough") == ["BRONX", "BROOKLYN", "BROOKLYN", "UNSPECIFIED", "MANHATTAN", "UNSPECIFIED"]
    filled = silver.fill_city(frame(spark, {"borough": "MANHATTAN"}, {"borough": "UNSPECIFIED"}, {"borough": "QUEENS", "city": "Astoria"}))
    assert column(filled, "city") == ["NEW YORK", "UNKNOWN", "ASTORIA"]


def test_closing(spark):
    act = {"resolution_action_updated_date": "2024-01-05T00:00:00.000"}
    rows = [{"status": "Closed - Duplicate"} | act, {"status": "Open"} | act, {"status": "CLOSED", "resolution_action_updated_date": "2023-01-05T00:00:00.000"}, {"closed_date": "2024-02-01T00:00:00.000"}]
    df = silver.silver(frame(spark, *rows), "2024-06-01")
    assert column(df, "closed_date_source") == ["INFERRED_FROM_RESOLUTION", "MISSING", "MISSING", "ORIGINAL"]
    assert column(df, "has_closed_status_without_date") == [False, False, True, False]
    flags = silver.date_flags(silver.parse_dates(frame(spark, {"closed_date": "2023-12-01T00:00:00.000"}, {"closed_date": "2009-05-01T00:00:00.000"}, {"closed_date": "2024-07-02T00:00:00.000"}, {"created_date": None, "closed_date": "2024-01-01T00:00:00.000"})), "2024-06-01")
    assert column(flags, "has_invalid_closed_date") == [True, True, False, False] and column(flags, "has_historical_closed_date") == [False, True, False, False] and column(flags, "has_future_closed_date") == [False, False, True, False]


def test_resolution_text_sees_the_raw_status(spark):
    assert column(silver.silver(frame(spark, {"status": "Open"}, {"status": "OPEN"}), "2024-06-01"), "resolution_description") == ["NO_RESOLUTION_INFO", None]


@pytest.mark.parametrize("day, name", [("2024-01-15", "Martin Luther King Jr. Day"), ("2024-11-28", "Thanksgiving"), ("2024-07-04", "Independence Day"), ("2024-06-30", None)])
def test_calendar(spark, day, name):
    row = dims.dim_date(spark, day, day, "2024-12-31").first()
    assert row.holiday_name == name
    assert (row.fiscal_year, row.fiscal_quarter) == {"2024-01-15": (2024, 3), "2024-11-28": (2025, 2), "2024-07-04": (2025, 1), "2024-06-30": (2024, 4)}[day]


def test_classifier(spark):
    cases = {"SELECT X FROM Y": "Data Quality Issue", "NOISE - PARK": "Noise", "HEAT": "Building & Housing", "ANIMAL IN VEHICLE": "Transportation", "ANIMAL": "Parks & Environment", "ZZZ": "Other", "SCRIE": "Tax & Property"}
    df = spark.createDataFrame([(c,) for c in cases], "c string")
    assert {r.c: r.k for r in df.select("c", dims.classify(F.col("c")).alias("k")).collect()} == cases


def test_sla(spark):
    closed = ["2024-01-01 23:59:00", "2024-01-02 00:01:00", "2024-01-08 10:00:00", "2024-01-09 10:00:00", "2024-02-01 10:00:00", None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(closed)], "i int, c string").select("i", F.lit("2024-01-01 10:00:00").cast("timestamp").alias("created_date"), F.col("c").cast("timestamp").alias("closed_date"))
    df = df.withColumns({f: F.lit(False) for f in ("has_invalid_closed_date", "has_historical_closed_date", "has_future_closed_date")} | {"is_closed": F.col("closed_date").isNotNull()})
    assert [r.s for r in df.select("i", sla_category().alias("s")).orderBy("i").collect()] == ["SAME_DAY", "WITHIN_WEEK", "WITHIN_WEEK", "WITHIN_MONTH", "OVER_MONTH", "OPEN"]


def test_surrogate_keys_stay(spark):
    old = dims.dim_agency(spark.createDataFrame([("DOT",), (" dot",), ("NYPD",)], "agency string"))
    assert {(r.agency_key, r.agency_id) for r in old.collect()} == {("DOT", 1), ("NYPD", 2)}
    new = dims.dim_agency(spark.createDataFrame([("ACS",), ("DOT",), ("NYPD",)], "agency string"), existing=old)
    assert {(r.agency_key, r.agency_id) for r in new.collect()} == {("DOT", 1), ("NYPD", 2), ("ACS", 3)}


def test_facts_are_not_multiplied_by_spellings(spark):
    df = silver.silver(frame(spark, {"agency": "DOT"}, {"agency": " dot "}), "2024-06-01")
    d = Dims(dims.dim_date(spark, "2024-01-01", "2024-01-31", "2024-06-01"), dims.dim_agency(df), dims.dim_location(df), dims.dim_type(df))
    assert fact(df, d).count() == 2


def test_december_to_january(spark):
    months = spark.createDataFrame([(2023, 12, 202312, 5), (2024, 1, 202401, 7)], "year int, month int, month_key int, n int")
    link = lambda compat: {r.month_key: r.p for r in marts.shifted(months, 1, {"n": "p"}, compat).collect()}
    assert link(False) == {202312: None, 202401: 5} and link(True) == {202312: None, 202401: None}


def test_latest_row_wins(spark):
    rows = [(1, 2, "b"), (1, 1, "a"), (2, 5, "x"), (2, 5, "y"), (3, 1, None)]
    df = spark.createDataFrame(rows, "k int, seq int, v string")
    got = {r.k: r.v for r in upsert.scd1_latest(df, ["k"], "seq", "v").collect()}
    assert got == {1: "b", 2: "y", 3: None}
    assert {r.k: r.v for r in upsert.scd1_latest(df.orderBy("v"), ["k"], "seq").collect()} == {r.k: r.v for r in upsert.scd1_latest(df.orderBy(F.desc("v")), ["k"], "seq").collect()}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k int, seq int, v string")
    two = spark.createDataFrame([(1, 2, "c"), (2, 0, "late")], "k int, seq int, v string")
    versions.upsert(spark, path, one, ["k"], "seq", batch_id=0)
    for _ in range(2):
        versions.upsert(spark, path, two, ["k"], "seq", batch_id=1)
    assert {r.k: r.v for r in versions.current(spark, path).collect()} == {1: "c", 2: "b"} and versions.numbers(spark, path) == [1, 2]


def test_partitions(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "cast(id % 3 as int) as y")
    upsert.write_partitioned(df, str(tmp_path / "a"), ["y"])
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "a")).where("y = 1").collect()) == list(range(1, 100, 3))


def test_schema_evolution(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([("1", "x", "new")], "a string, b string, c string")
    row = landing.conform(df, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("d", T.StringType())])).first()
    assert row.a == 1 and row.b is None and row.d is None and row._rescued_data == '{"c":"new","b":"x"}'


def test_stream_equals_batch(spark, tmp_path):
    df = frame(spark, {"unique_key": "1"}, {"unique_key": "2", "status": "CLOSED", "closed_date": "2024-01-03T00:00:00.000"}, {"unique_key": "1", "resolution_action_updated_date": "2024-01-09T00:00:00.000"})
    for i, part in enumerate(df.randomSplit([0.5, 0.5], 1)):
        part.write.parquet(str(tmp_path / "in" / str(i)))
    source = stream.bronze_stream(spark, str(tmp_path / "in"), df.schema, 1)
    for _ in range(2):
        stream.silver_stream(source, str(tmp_path / "out"), str(tmp_path / "check"), "2024-06-01").awaitTermination()
    stream.append_stream(source, str(tmp_path / "raw"), str(tmp_path / "check2")).awaitTermination()
    drop = ["_unified_processed_timestamp", "_ingested_at", "_source_file"]
    got = versions.current(spark, str(tmp_path / "out")).drop(*drop)
    want = upsert.scd1_latest(silver.silver(df, "2024-06-01").drop(*drop), ["unique_key"], "updated_date")
    assert sorted(map(repr, got.select(*sorted(got.columns)).collect())) == sorted(map(repr, want.select(*sorted(got.columns)).collect()))
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 3


@pytest.mark.parametrize("lookback", [0, 14, 200])
def test_incremental_equals_full(spark, sf, lookback):
    """All columns, on days so sparse that a frame of 30 rows spans months."""
    from quern.plans.views import star

    facts, d = star(spark, sf)
    last = facts.agg(F.max("created_date_key")).first()[0]
    day = f"{last // 10000}-{last // 100 % 100:02d}-{last % 100:02d}"
    mart = marts.agg_daily(facts.where(F.col("created_date_key") < last), d)
    part = marts.incremental(lambda since: marts.agg_daily(facts, d, since), mart, [], day, lookback)
    keys = [r.date_key for r in part.select("date_key").collect()]
    full = marts.agg_daily(facts, d).where(F.col("date_key") >= min(keys))
    assert last in keys and sorted(map(repr, full.collect())) == sorted(map(repr, part.collect()))


def test_crash_between_versions(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, 1, "a")], "k int, seq int, v string")
    two = spark.createDataFrame([(1, 2, "b"), (2, 1, "c")], "k int, seq int, v string")
    versions.upsert(spark, path, one, ["k"], "seq", batch_id=0)
    written, real = [], versions.write_partitioned

    def crash(df, path, *rest, **named):
        real(df, path, *rest, **named)
        written.append(path)
        raise OSError("the machine is gone")

    monkeypatch.setattr(versions, "write_partitioned", crash)
    with pytest.raises(OSError):
        versions.upsert(spark, path, two, ["k"], "seq", batch_id=1)
    monkeypatch.undo()
    assert written and [tuple(r) for r in versions.current(spark, path).collect()] == [(1, 1, "a")]
    versions.upsert(spark, path, two, ["k"], "seq", batch_id=1)
    assert sorted(tuple(r) for r in versions.current(spark, path).collect()) == [(1, 2, "b"), (2, 1, "c")]
    for k in range(2, 5):
        versions.upsert(spark, path, one, ["k"], batch_id=k)
    assert {r.k: r.v for r in versions.current(spark, path).collect()} == {1: "a", 2: "c"} and versions.numbers(spark, path) == [1, 2, 3, 4, 5]


def test_score_of_zero_and_one(spark):
    df = spark.createDataFrame([(0, 4), (1, 4), (2, 4)], "cars long, noise long")
    score = F.when(F.col("cars") != 1, impact.ratio("noise", "cars", 2, 1.0))
    assert [r.s for r in df.select("cars", score.alias("s")).orderBy("cars").collect()] == [None, None, 2.0]


def test_drift_and_null_keys(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(1, 2.0)], "a long, c double")
    assert {(r.column_name, r.drift) for r in checks.schema_drift(a, b).collect()} == {("a", "retyped"), ("b", "removed"), ("c", "added")}
    keys = spark.createDataFrame([(None, 1), (1, None), (1, 1)], "a int, b int")
    assert [r.null_key for r in checks.null_keys(keys, "a", "b").collect()] == ["a", "b"]


def test_landing_formats_and_counts(spark, tmp_path):
    df = spark.range(40).selectExpr("cast(id as string) as unique_key", "timestamp'2024-12-30 12:00:00' + make_interval(0, 0, 0, cast(id % 4 as int)) as created_date")
    for fmt in ("parquet", "json"):
        root = str(tmp_path / fmt)
        for _ in range(2):
            landing.land(df, root, "created_date", "day", fmt)
        read = spark.read.format(fmt).load(root)
        assert read.count() == 40 and (tmp_path / fmt / "year=2024" / "month=12" / "day=31").is_dir() and {"year", "month", "day"} <= set(read.columns)
        there = {(str(r.period_start), r.record_count) for r in landing.landed(spark, root, fmt).where("files > 0 and bytes > 0 and ingested_at is not null").collect()}
        assert there == {(str(r.period_start), r.record_count) for r in landing.manifest(df, "created_date").collect()}
    assert any(p.name.endswith(".json.gz") for p in (tmp_path / "json").rglob("*"))
    counts = landing.manifest(df, "created_date").orderBy("period_start")
    assert [r.record_count for r in counts.collect()] == [10, 10, 10, 10]
    assert {r.status for r in landing.validate_counts(counts).collect()} == {"warning"} and {r.status for r in landing.validate_counts(counts, 1, 10).collect()} == {"passed"}
    assert landing.period_slice(df, "created_date", "2024-12-01", "month").count() == 20
