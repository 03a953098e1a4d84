"""Rules in one scan, sketches that merge, and streams of files whose columns change."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators import checks, sketches, versions
from quern.streaming import evolving


def scans(df, column):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("FileScan" in line and column in line for line in plan.splitlines())


def test_rules_share_a_scan(spark, sf):
    from quern.plans.quality import SUITE
    from quern.plans.views import star

    facts, dims = star(spark, sf)
    rules = [c for c in SUITE if isinstance(c, checks.Rule) and c.table == "fact"]
    assert len(rules) >= 9
    fused = checks.run_checks({"fact": facts}, rules)
    assert scans(fused, "response_time_hours") == 1
    apart = {r.name: r.rows({"fact": facts}).count() for r in rules}
    assert {r.check_name: r.violations for r in fused.collect()} == apart and max(apart.values()) > 0
    empty = checks.run_checks({"fact": facts.limit(0)}, rules).collect()
    assert len(empty) == len(rules) and all(r.violations == 0 and r.status == "pass" for r in empty)


def test_null_is_no_violation(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "a int")
    rules = [checks.Rule("low", "warn", "t", lambda: checks.outside("a", 5)), checks.Rule("there", "error", "t", lambda: checks.nulls("a"))]
    assert {(r.check_name, r.violations, r.status) for r in checks.run_checks({"t": df}, rules).collect()} == {("low", 1, "warn"), ("there", 1, "error")}


def test_sketches_merge_without_the_facts(spark, sf, tmp_path):
    from quern.plans.views import star

    facts, dims = star(spark, sf)
    path = str(tmp_path / "sketches")
    days = sketches.day_sketches(facts, dims, ["agency_code", "borough"], ["complaint_type_key"])
    versions.overwrite(spark, path, days.withColumn("mart_month", F.floor(F.col("date_key") / 100).cast("int")), ["mart_month"])
    mart = versions.current(spark, path)
    whole = sketches.rolled_up(mart, [F.lit(1).alias("all")])
    assert all(path in f for f in whole.inputFiles())
    r, exact = whole.first(), facts.where("is_closed and response_time_hours >= 0").agg(F.percentile("response_time_hours", F.lit(0.5)), F.percentile("response_time_hours", F.lit(0.9))).first()
    assert r.total_complaints == facts.count() and r.valid_response_count > 500
    assert abs(r.q50 - exact[0]) < 0.05 * exact[0] and abs(r.q90 - exact[1]) < 0.05 * exact[1]
    kinds = facts.select("complaint_type_key").distinct().count()
    assert abs(r.distinct_complaint_type_key - kinds) <= 0.05 * kinds
    halves = [sketches.rolled_up(mart.where(F.col("mart_month") % 2 == k), ["borough"]).agg(F.sum("total_complaints")).first()[0] for k in (0, 1)]
    assert sum(halves) == r.total_complaints


def test_a_group_without_times(spark):
    df = spark.createDataFrame([(20240101, None), (20240102, 3.0), (20240102, 5.0)], "date_key int, valid_hours double")
    mart = df.groupBy("date_key").agg(*[F.count("valid_hours").alias(c) for c in sketches.COUNTS], F.kll_sketch_agg_double("valid_hours", F.lit(sketches.QUANTILES)).alias("hours"))
    got = {r.date_key: (r.q50, r.valid_response_count) for r in sketches.rolled_up(mart, ["date_key"]).collect()}
    assert got == {20240101: (None, 0), 20240102: (3.0, 2)}
    assert sketches.rolled_up(mart, [sketches.quarter()]).first().quarter_key == 20241


SCHEMA = T.StructType([T.StructField("k", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("v", T.StringType()), T.StructField("n", T.LongType())])


def put(spark, folder, name, rows, schema):
    """One file, with a name that tells the order in which files are taken."""
    import os
    import shutil
    import time

    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}-tmp/{name}")
    part = next(f for f in os.listdir(f"{folder}-tmp/{name}") if f.endswith(".parquet"))
    os.makedirs(folder, exist_ok=True)
    shutil.move(f"{folder}-tmp/{name}/{part}", f"{folder}/{name}.parquet")
    stamp = time.time() + len(os.listdir(folder)) - 1_000
    os.utime(f"{folder}/{name}.parquet", (stamp, stamp))


def batch(spark, folder, rows):
    """What the table should be: the latest row of each key of all files."""
    import os

    return {r.k: (r.seq, r.v, r.n, r._rescued_data) for r in rows(evolving.read_files(spark, sorted(f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")), SCHEMA))}


def latest(df):
    from quern.operators.upsert import scd1_latest

    return scd1_latest(df.select("k", "seq", "v", "n", "_rescued_data"), ["k"], "seq").collect()


def test_stream_of_changing_files_equals_batch(spark, tmp_path, monkeypatch):
    """Files one by one, out of order, with columns that come, go and change type; a crash between merge and checkpoint, and restarts."""
    folder, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    run = lambda: evolving.evolving_upsert(spark, folder, SCHEMA, out, check, ["k"], "seq", max_files=1).awaitTermination()
    now = lambda: {r.k: (r.seq, r.v, r.n, r._rescued_data) for r in versions.current(spark, out).collect()}
    put(spark, folder, "a", [(1, 5, "a5", 1), (2, 1, "a1", 2)], "k long, seq long, v string, n long")
    put(spark, folder, "b", [(1, 3, "late"), (3, 1, "b1")], "k long, seq long, v string")  # an older file, without n, out of order
    run()
    assert now() == batch(spark, folder, latest) and now()[1][:3] == (5, "a5", 1) and now()[3][2] is None
    put(spark, folder, "c", [(2, 2, "c2", "many", True)], "k long, seq long, v string, n string, flag boolean")  # n is a text now, and a new column
    put(spark, folder, "d", [(4, 1, "d1", "7")], "k long, seq long, v string, n string")
    real, made = evolving.merge, []

    def crash(*args, **named):
        made.append(real(*args, **named))
        if len(made) == 1:
            raise OSError("the machine is gone")
        return made[-1]

    monkeypatch.setattr(evolving, "merge", crash)
    with pytest.raises(Exception, match="gone"):
        run()
    monkeypatch.undo()
    merged = versions.numbers(spark, out)
    run()
    assert now() == batch(spark, folder, latest) and len(versions.numbers(spark, out)) == len(merged) + 1  # the crashed batch was not merged twice
    assert now()[2][:3] == (2, "c2", None) and json.loads(now()[2][3]) == {"flag": True, "n": "many"} and now()[4][:3] == (1, "d1", 7)
    run()
    assert len(versions.numbers(spark, out)) == len(merged) + 1
    put(spark, folder, "e", [], "k long, seq long")
    put(spark, folder, "f", [(1, 9)], "k long, seq long")
    run()
    assert now() == batch(spark, folder, latest) and now()[1][:3] == (9, None, None)
    assert versions.current(spark, out).where("k = 1").first()._source_file.endswith("f.parquet")


def test_merge_schemas(spark, tmp_path):
    from quern.sources import landing

    root = str(tmp_path)
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(f"{root}/t.parquet/one")
    spark.createDataFrame([(2, 5)], "k int, w int").write.parquet(f"{root}/t.parquet/two")
    df = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(f"{root}/t.parquet")
    assert {(r.k, r.v, r.w) for r in df.collect()} == {(1, "a", None), (2, None, 5)}
    for name, schema, row in (("x=1", "k int, v string", (1, "a")), ("x=2", "k int, w int", (2, 5))):
        spark.createDataFrame([row], schema).write.parquet(f"{root}/u.parquet/{name}")
    merged = landing.load(spark, root, "u", merge_schemas=True)
    assert {"v", "w"} <= set(merged.columns) and {(r.k, r.v, r.w) for r in merged.collect()} == {(1, "a", None), (2, None, 5)}
