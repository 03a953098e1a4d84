"""Keyed tables of versions: what a merge writes and carries, two writers, crashes, the change feed, clustering and removal."""

import os

import pytest
from pyspark.sql import functions as F

from quern.operators import clustering, upsert, versions

SCHEMA = "k long, y int, seq int, v string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(tuple(r) for r in df.select("k", "y", "seq", "v").collect())


@pytest.fixture
def path(spark, tmp_path):
    where = str(tmp_path / "t")
    versions.merge(spark, where, table(spark, [(k, k % 5, 1, "a") for k in range(50)]), ["k"], "seq", partition=["y"], batch_id=0)
    return where


def test_only_folders_with_changed_keys_are_written(spark, path):
    v = versions.merge(spark, path, table(spark, [(7, 2, 2, "b"), (8, 3, 0, "late"), (100, 4, 1, "new"), (9, 4, 1, "a")]), ["k"], "seq")
    last = versions.history(spark, path).orderBy(F.desc("version")).first()
    assert (last.folders_written, last.folders_carried) == (2, 4)  # y=2 anew; new key in a folder of its own; y=0, 1, 3, 4 as they were
    want = {k: (k, k % 5, 1, "a") for k in range(50)} | {7: (7, 2, 2, "b"), 100: (100, 4, 1, "new")}
    assert rows(versions.current(spark, path)) == sorted(want.values()) and v.number == 2
    assert rows(versions.at(spark, path, 1)) == [(k, k % 5, 1, "a") for k in range(50)]


def test_a_key_moves_and_goes(spark, path):
    versions.merge(spark, path, table(spark, [(5, 1, 2, "moved"), (6, 1, 3, "gone")]), ["k"], "seq", deletes=F.col("v") == "gone")
    assert {r[0]: r for r in rows(versions.current(spark, path))}[5] == (5, 1, 2, "moved") and versions.current(spark, path).count() == 49
    feed = {r.k: (r.change, r.v) for r in versions.changes(spark, path, 1).collect()}
    assert feed == {5: ("update", "moved"), 6: ("delete", "a")}


def test_feed_replays(spark, path):
    import random

    rng = random.Random(1)
    for n in range(5):
        batch = {k: (k, rng.randrange(5), rng.randrange(4), rng.choice("abcd")) for k in rng.sample(range(70), 12)}
        versions.merge(spark, path, table(spark, list(batch.values())), ["k"], "seq" if n % 2 else None, deletes=F.col("v") == "d")
        versions.merge(spark, path, table(spark, [(k, 0, -1, "old") for k in batch]).where("k < 0"), ["k"], "seq")
    last = versions.numbers(spark, path)[-1]
    first = versions.at(spark, path, 1)
    for upto in (1, 4, last):
        feed = versions.changes(spark, path, 1, upto)
        assert rows(versions.replayed(first, feed, ["k"])) == rows(versions.at(spark, path, upto))
    since = versions.replayed(versions.at(spark, path, 4), versions.changes(spark, path, 4), ["k"])
    assert rows(since) == rows(versions.current(spark, path))
    assert {(r.k, r.change) for r in upsert.change_diff(first, versions.current(spark, path), ["k"]).collect()} >= {(r.k, r.change) for r in versions.changes(spark, path, 1).collect() if r.change == "delete" and r.k < 50 and r.k not in {x[0] for x in rows(versions.current(spark, path))}}


def test_a_version_without_feed(spark, path):
    versions.overwrite(spark, path, table(spark, [(1, 1, 1, "z")]), ["y"])
    assert rows(versions.current(spark, path)) == [(1, 1, 1, "z")] and versions.version(spark, path).batch == 0
    with pytest.raises(ValueError):
        versions.changes(spark, path, 0)
    with pytest.raises(ValueError):
        versions.at(spark, path, 9)


def test_two_writers(spark, path, monkeypatch):
    """The second to commit finds the first's version, and merges upon it; no update is lost."""
    real, meanwhile = versions.commit, []

    def late(s, where, made):
        if not meanwhile:
            meanwhile.append(made.number)
            monkeypatch.setattr(versions, "commit", real)
            versions.merge(spark, path, table(spark, [(1, 1, 5, "other")]), ["k"], "seq")
        return real(s, where, made)

    monkeypatch.setattr(versions, "commit", late)
    done = versions.merge(spark, path, table(spark, [(1, 1, 4, "mine"), (2, 2, 4, "mine")]), ["k"], "seq", batch_id=1)
    got = {r[0]: r[3] for r in rows(versions.current(spark, path))}
    assert meanwhile == [2] and done.number == 3 and (got[1], got[2]) == ("other", "mine")
    assert len(os.listdir(f"{path}/data")) == 3 and len(os.listdir(f"{path}/feed")) == 3  # what the clash had written is gone
    monkeypatch.setattr(versions, "numbers", lambda *_: [1])
    with pytest.raises(versions.Conflict):
        versions.merge(spark, path, table(spark, [(1, 1, 9, "x")]), ["k"], "seq", attempts=2)


def test_a_batch_counts_once_whatever_comes_between(spark, path):
    one = table(spark, [(1, 1, 7, "b")])
    versions.merge(spark, path, one, ["k"], "seq", batch_id=3)
    versions.merge(spark, path, table(spark, [(1, 1, 8, "hand")]), ["k"], "seq")
    versions.merge(spark, path, table(spark, [(1, 1, 9, "again")]), ["k"], "seq", batch_id=3)
    assert versions.numbers(spark, path) == [1, 2, 3] and dict((r[0], r[3]) for r in rows(versions.current(spark, path)))[1] == "hand"


def test_crash_and_vacuum(spark, path, monkeypatch):
    def crash(*_):
        raise OSError("the machine is gone")

    monkeypatch.setattr(versions, "commit", crash)
    with pytest.raises(OSError):
        versions.merge(spark, path, table(spark, [(1, 1, 5, "lost")]), ["k"], "seq")
    monkeypatch.undo()
    before = rows(versions.current(spark, path))
    assert before == [(k, k % 5, 1, "a") for k in range(50)] and len(os.listdir(f"{path}/data")) == 2
    assert versions.vacuum(spark, path) == []  # the crashed write might still be running
    removed = versions.vacuum(spark, path, older_hours=0)
    assert sorted(r.partition("/")[0] for r in removed) == ["data", "feed"] and rows(versions.current(spark, path)) == before
    for n in range(4):
        versions.merge(spark, path, table(spark, [(n, n, 9, f"v{n}")]), ["k"], "seq")
    versions.vacuum(spark, path, keep=2, older_hours=0)
    assert versions.numbers(spark, path) == [4, 5]
    assert {r[3] for r in rows(versions.current(spark, path))} == {"a", "v0", "v1", "v2", "v3"} and versions.at(spark, path, 4).count() == 50


def test_new_columns_and_odd_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.merge(spark, path, spark.createDataFrame([(1, "a"), (None, "n")], "k int, `b c` string"), ["k"])
    versions.merge(spark, path, spark.createDataFrame([(1, 2.5), (None, 1.0), (3, None)], "k int, d double"), ["k"])
    got = {r.k: (r["b c"], r.d) for r in versions.current(spark, path).collect()}
    assert got == {1: (None, 2.5), None: (None, 1.0), 3: (None, None)}
    versions.merge(spark, path, spark.createDataFrame([], "k int, d double"), ["k"])
    assert versions.current(spark, path).count() == 3 and versions.changes(spark, path, 2).count() == 0
    assert versions.current(spark, str(tmp_path / "none")) is None
    odd = str(tmp_path / "odd")
    versions.merge(spark, odd, spark.createDataFrame([(1, "a/b =%"), (2, None)], "k int, p string"), ["k"], partition=["p"])
    versions.merge(spark, odd, spark.createDataFrame([(1, "a/b =%"), (2, "c")], "k int, p string"), ["k"])
    assert {r.k: r.p for r in versions.current(spark, odd).collect()} == {1: "a/b =%", 2: "c"}


def test_clustering(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20_000).selectExpr("id as k", "cast(id % 2 as int) as y", "concat('A', lpad(cast(hash(id) % 40 + 40 as string), 2, '0')) as agency", "cast(pmod(hash(id, 1), 12) as int) as month")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    versions.merge(spark, path, df, ["k"], partition=["y"], salt=16)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    filters = [{"agency": f"A{a}", "month": m} for a in (10, 35, 60) for m in (0, 5, 11)]
    before = versions.current(spark, path)
    v = clustering.cluster(spark, path, ["agency", "month"], where=lambda p: p["y"] == "1", rows_per_file=625)
    after = versions.current(spark, path)
    assert v.kind == "cluster" and sorted(map(tuple, after.collect())) == sorted(map(tuple, before.collect()))
    odd = lambda d: clustering.opened(d.where("y = 1"), filters)
    (all_before, *opened_before), (all_after, *opened_after) = odd(before), odd(after)
    assert all_before >= 5 and all(n == all_before for n in opened_before) and all_after == 16 and max(opened_after) <= 4
    assert clustering.opened(after.where("y = 0"), filters) == clustering.opened(before.where("y = 0"), filters)
    assert versions.changes(spark, path, 1).count() == 0
    one = spark.createDataFrame([(None, 1), ("é", 1)] + [("x", 1)] * 400, "agency string, month int").withColumn("k", F.monotonically_increasing_id())
    heavy = str(tmp_path / "heavy")
    versions.merge(spark, heavy, one, ["k"])
    clustering.cluster(spark, heavy, ["agency", "month"], rows_per_file=50)
    assert versions.current(spark, heavy).count() == 402 and clustering.file_ranges(versions.current(spark, heavy), ["agency"]).agg(F.max("rows")).first()[0] < 150


def test_pruning_when_it_runs(spark, sf):
    """The join's filter on the dates reaches the scan of the facts, which opens the folders of two years of seven."""
    from quern.plans import keyed
    from quern.plans.views import star

    facts, dims = star(spark, sf)
    df = keyed.holidays(versions.current(spark, keyed.fact_table(spark, facts)), dims)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "dynamicpruning" in line.lower()]
    assert scans
    read = {r.created_year for r in df.select("created_year").distinct().collect()}
    assert read and read < {r.created_year for r in facts.select("created_year").distinct().collect()}

    def files(node):
        found = [node.metrics().get("numFiles").get().value()] if node.nodeName().startswith("Scan parquet") and "dynamicpruning" in node.toString().lower() else []
        inner = [node.executedPlan()] if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec" else [node.plan()] if "QueryStageExec" in node.getClass().getSimpleName() else []
        below = node.children()
        for child in [*inner, *[below.apply(i) for i in range(below.size())]]:
            found += files(child)
        return found

    assert files(df._jdf.queryExecution().executedPlan()) == [2]


def test_a_refresh_reads_and_writes_little(spark, sf, tmp_path):
    """Months before the look-back are carried, vanished rows go, and facts before it are not asked for."""
    from quern.operators import marts
    from quern.plans.views import star

    facts, dims = star(spark, sf)
    path = str(tmp_path / "mart")
    marts.put_down(spark, path, marts.agg_location(facts, dims))
    months = len(versions.version(spark, path).folders)
    last = facts.agg(F.max("created_date_key")).first()[0]
    day = f"{last // 10000}-{last // 100 % 100:02d}-{last % 100:02d}"
    fewer = facts.where(F.col("created_date_key") != last)
    asked = []

    def build(since):
        asked.append(since.day)
        return marts.agg_location(fewer, dims, since=since)

    marts.refresh(spark, path, build, ["location_key"], day, 20, 7)
    v = versions.version(spark, path)
    assert len(v.added) <= 2 and len(v.folders) >= months - 1 and asked[0] > last - 10_000
    got, want = versions.current(spark, path).drop("mart_month"), marts.agg_location(fewer, dims)
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    marts.refresh(spark, path, lambda since: marts.agg_location(fewer, dims, since=since), ["location_key"], day, 20, 7)
    assert versions.version(spark, path).added == []  # nothing changed, nothing is written
    with pytest.raises(ValueError):
        marts.refresh(spark, str(tmp_path / "none"), build, ["location_key"], day, 20)


def test_rolling_by_days(spark):
    from quern.functions.metrics import Rolling

    df = spark.createDataFrame([("a", 20240227, 4), ("a", 20240301, 2), ("a", 20240308, 6), ("b", 20240301, 5)], "g string, date_key int, n long")
    roll = Rolling("g", first=19_780)  # 27 February 2024
    got = {(r.g, r.date_key): (r.m, r.d, r.w, r.s and round(r.s, 9)) for r in df.withColumns({"m": roll.mean(F.col("n"), 7), "d": roll.lag(F.col("n")), "w": roll.lag(F.col("n"), 7), "s": roll.deviation(F.col("n"), 3)}).collect()}
    assert got == {("a", 20240227): (4.0, None, None, None), ("a", 20240301): (1.5, 0, None, round((4 / 3) ** 0.5, 9)), ("a", 20240308): (6 / 7, 0, 2, round(12**0.5, 9)), ("b", 20240301): (1.25, 0, None, round((25 / 3) ** 0.5, 9))}


def test_the_share_of_files_that_a_filter_opens(spark, sf):
    from quern.plans import keyed

    got = {r.layout: r for r in keyed.clustered_file_share(spark, sf).collect()}
    assert got["by curve"].files >= 32 and got["by curve"].share < 0.25 and got["by curve"].share < 0.5 * got["by hash"].share


def test_the_star_is_stored_once(spark, sf):
    from quern.plans.views import star

    a, b = star(spark, sf), star(spark, sf)
    assert a[0] is b[0] and a[1] is b[1]


def test_a_large_partition_is_split_between_tasks(spark, tmp_path):
    """A file of one partition holds no more rows when the table is larger, whatever the salt."""
    largest = []
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    for n in (40_000, 320_000):
        path = str(tmp_path / str(n))
        versions.overwrite(spark, path, spark.range(0, n, 1, n // 5_000).selectExpr("id as k", "cast(id % 2 as int) as y", "sha2(string(id), 256) as v"), ["y"])
        got = versions.current(spark, path)
        assert got.count() == n == got.distinct().count()
        largest.append(clustering.file_ranges(got, ["k"]).agg(F.max("rows")).first()[0])
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert largest[1] <= 1.5 * largest[0]


def test_clustered_files_hold_so_many_rows_at_most(spark, tmp_path, monkeypatch):
    from quern.plans import keyed

    monkeypatch.setattr(keyed, "FILE_ROWS", 100)
    path = str(tmp_path / "t")
    versions.overwrite(spark, path, spark.range(20_000).selectExpr("id as k", "concat('A', id % 5) as agency_code", "cast(id % 12 as int) as created_month"))
    keyed.clustered(spark, path, 20_000)
    rows = clustering.file_ranges(versions.current(spark, path), ["k"]).agg(F.count(F.lit(1)), F.max("rows"), F.sum("rows")).first()
    assert rows[0] > 150 and rows[1] < 200 and rows[2] == 20_000


def test_a_merge_shuffles_no_more_than_it_needs(spark, tmp_path, monkeypatch):
    """No digest where the sequence holds the whole row, none before the join with the table, and nothing for a batch that was merged before."""
    rng = spark.range(3_000).selectExpr("id % 700 as k", "cast(id % 7 as int) as a", "if(id % 5 = 0, null, id % 11) as b")
    last = upsert.scd1_latest(rng, ["k"], ["a", "b"])
    assert "sha2" not in last._jdf.queryExecution().toString()
    struct = upsert.scd1_latest(rng.withColumn("s", F.struct("a", "b")), ["k"], "s").drop("s")
    want = sorted(map(repr, struct.collect()))
    assert sorted(map(repr, last.collect())) == want and len(want) == 700
    path, wide = str(tmp_path / "t"), rng.withColumn("c", F.lit("x"))
    for n, part in enumerate((rng.a > 3, rng.a < 2, rng.a.between(2, 3))):
        versions.merge(spark, path, rng.where(part), ["k"], ["a", "b"], batch_id=n)
    assert sorted(map(repr, versions.current(spark, path).collect())) == want
    there, new = wide.withColumn("__folder", F.lit("f")), wide.withColumn("__delete", F.lit(False))
    plan = versions._changes(there, new, ["k"], ["k", "a", "b", "c"], "a", None)._jdf.queryExecution().optimizedPlan().toString()
    assert "sha2" in plan and "sha2" not in plan[plan.index("Join LeftOuter") :]
    monkeypatch.setattr(versions, "stored", None)
    assert versions.merge(spark, path, rng, ["k"], ["a", "b"], batch_id=1).number == 3
