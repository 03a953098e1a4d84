"""Forecast values: against known series, numpy's least squares, and the sums themselves."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.operators import forecast as P

DAY0 = dt.date(2020, 1, 1)


def waves(days, yearly=2, weekly=3):
    out = [np.ones_like(days), days / 365.25]
    for length, n in ((365.25, yearly), (7.0, weekly)):
        out += [f(2 * np.pi * k * days / length) for k in range(1, n + 1) for f in (np.sin, np.cos)]
    return np.stack(out, axis=1)


@pytest.fixture(scope="module")
def known(spark):
    """Three years whose log is a trend, a year's and a week's wave, holidays at a third more, and little noise."""
    rng = np.random.default_rng(5)
    n = 1_095
    d = np.arange(n) + float((DAY0 - dt.date(1970, 1, 1)).days)
    holiday = (np.arange(n) % 30 == 7).astype(float)
    log = 6 + 0.1 * (np.arange(n) / 365.25) + 0.2 * np.sin(2 * np.pi * d / 365.25) + 0.1 * np.cos(2 * np.pi * d / 7) + 0.3 * holiday + rng.normal(0, 0.02, n)
    rows = [(DAY0 + dt.timedelta(days=i), float(np.expm1(log[i])), float(holiday[i]), 0.0, 0.0) for i in range(n)]
    return spark.createDataFrame(rows, "ds date, y double, is_holiday double, rolling_7day_avg double, lag_7day double")


def test_regression_on_a_known_series(spark, known):
    split = P.time_split(known, 90)
    train, test = split.where("not is_test").drop("is_test"), split.where("is_test").drop("is_test")
    model = P.fit_regression(train, penalty=1e-6)
    out = P.predict_regression(model, test)
    got = P.accuracy(out).first()
    assert got.n == 90 and got.smape < 3 and got.readiness == "excellent" and 85 <= got.coverage <= 100
    spread = out.agg(F.avg(F.log1p("yhat_upper") - F.log1p("yhat"))).first()[0]
    assert abs(spread - 1.96 * 0.02) < 0.004
    gap = P.generalisation(P.predict_regression(model, train), out).first()
    assert gap.verdict == "none" and gap.gap == pytest.approx(abs(gap.test_smape - gap.train_smape), abs=1e-3)
    impact = {r.regressor: r for r in P.regressor_impact(model, spark, "2022-12-01").collect()}
    grid = [DAY0 + dt.timedelta(days=1_065 + k) for k in range(31)]
    d = np.array([(x - dt.date(1970, 1, 1)).days for x in grid], dtype=float)
    base = np.exp(6 + 0.1 * (np.arange(1_065, 1_096) / 365.25) + 0.2 * np.sin(2 * np.pi * d / 365.25) + 0.1 * np.cos(2 * np.pi * d / 7))
    assert impact["is_holiday"].rank == 1 and impact["is_holiday"].impact == pytest.approx(np.mean(base) * (np.exp(0.3) - 1), rel=0.05)
    assert abs(impact["lag_7day"].impact) < 1


def test_series_by_sums_equal_least_squares(spark):
    rng = np.random.default_rng(7)
    rows, sizes = [], {"a": 400, "b": 37, "c": 900, "short": 3, "one": 1}
    for key, n in sizes.items():
        y = np.maximum(0, 80 + 30 * np.sin(np.arange(n) / 58) + 8 * np.cos(2 * np.pi * np.arange(n) / 7) + rng.normal(0, 5, n)).round()
        rows += [(key, DAY0 + dt.timedelta(days=i), int(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(rows + [("a", DAY0, None)], "k string, ds date, y long").where("y is not null")
    found = {}
    for r in P.grouped_forecast(df, "k", 10, 1.0).collect():
        found.setdefault(r.k, []).append((r.ds, r.yhat, r.yhat_lower, r.yhat_upper))
    assert set(found) == set(sizes)
    for key in sizes:
        mine = sorted((ds, v) for k, ds, v in rows if k == key)
        last = mine[-1][0]
        d, y = np.array([(ds - last).days for ds, _ in mine], dtype=float), np.log1p([v for _, v in mine])
        x = waves(d)
        w = np.linalg.solve(x.T @ x + np.diag([0.0] + [1.0] * (x.shape[1] - 1)), x.T @ y)
        spread, p = np.sqrt(np.mean((y - x @ w) ** 2)), waves(np.arange(1, 11, dtype=float)) @ w
        got = sorted(found[key])
        assert [g[0] for g in got] == [last + dt.timedelta(days=k) for k in range(1, 11)]
        for (_, yhat, low, high), v in zip(got, p):
            assert yhat == pytest.approx(np.expm1(v), rel=1e-6, abs=1e-6)
            assert high == pytest.approx(np.expm1(v + 1.96 * spread), rel=1e-4, abs=1e-4) and low == pytest.approx(np.expm1(v - 1.96 * spread), rel=1e-4, abs=1e-4)


def test_no_series_reaches_python(spark):
    """One row a series is handed to Python; the days are summed in the JVM, before the shuffle."""
    df = spark.range(1_000).selectExpr("cast(id % 4 as string) as k", "date_add(date'2020-01-01', cast(id div 4 as int)) as ds", "id as y")
    plan = P.grouped_forecast(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroupsInPandas" not in plan and "ArrowEvalPython" in plan and plan.count("partial_sum") >= 1
    assert P.grouped_forecast(df.where("k = '9'").unionByName(df.where("k = '1'")), "k").select("k").distinct().count() == 1


def test_odd_series(spark):
    df = spark.createDataFrame([("a", DAY0, 5), ("b", DAY0, None), (None, DAY0, 2)], "k string, ds date, y long")
    eq = P.solved(P.normal_equations(df, ["k"], P.series_terms("ds"), F.log1p("y"))).collect()
    assert sorted((r.k or "", r.n) for r in eq) == [("", 1), ("a", 1)] and all(r.spread >= 0 for r in eq)
    assert P.solved(P.normal_equations(df.limit(0), ["k"], P.series_terms("ds"), F.log1p("y"))).count() == 0
