"""Forecasts of daily series, and how good they are."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.metrics import ratio

REGRESSORS = ["is_holiday", "rolling_7day_avg", "lag_7day"]


def time_split(df: DataFrame, test_rows: int = 90) -> DataFrame:
    """Add is_test: the last ``test_rows`` rows by date."""
    return df.withColumn("is_test", F.row_number().over(Window.orderBy(F.desc("ds"))) <= test_rows)


def fill_medians(df: DataFrame, names: list[str] = REGRESSORS) -> DataFrame:
    middle = df.agg(*[F.percentile(n, F.lit(0.5)).alias(f"__{n}") for n in names])  # one row
    filled = df.join(F.broadcast(middle))
    return filled.withColumns({n: F.coalesce(F.col(n).cast("double"), f"__{n}") for n in names}).drop(*[f"__{n}" for n in names])


def train_clean(df: DataFrame, min_y: float = 500, max_z: float = 3.0) -> DataFrame:
    """Rows of ``min_y`` and more whose distance from the mean of such rows is within ``max_z`` deviations."""
    some = df.where(F.col("y") >= min_y)
    stats = some.agg(F.avg("y").alias("__m"), F.stddev_samp("y").alias("__s"))  # one row
    return some.join(F.broadcast(stats)).where(F.abs((F.col("y") - F.col("__m")) / F.col("__s")) <= max_z).drop("__m", "__s")


def test_clean(df: DataFrame, drop_days: int = 3, min_z: float = -3.0) -> DataFrame:
    """Without the last days, whose counts are not complete, and without rows far below the mean of all."""
    stats = df.agg(F.avg("y").alias("__m"), F.stddev_samp("y").alias("__s"), F.max("ds").alias("__last"))
    far = (F.col("y") - F.col("__m")) / F.col("__s") >= min_z
    return df.join(F.broadcast(stats)).where((F.col("ds") <= F.date_sub("__last", drop_days)) & far).drop("__m", "__s", "__last")


def naive(df: DataFrame, period: int = 7, *by: str) -> DataFrame:
    """Add yhat: the value ``period`` rows before."""
    return df.withColumn("yhat", F.lag("y", period).over(Window.partitionBy(*by).orderBy("ds")).cast("double"))


def seasonal_terms(ds: str = "ds", yearly: int = 6, weekly: int = 3) -> dict[str, Column]:
    """A trend and sine and cosine waves of the year and the week."""
    day = F.datediff(F.col(ds), F.lit("1970-01-01").cast("date")).cast("double")
    out = {"trend": day / 365.25}
    for name, length, n in (("year", 365.25, yearly), ("week", 7.0, weekly)):
        for k in range(1, n + 1):
            out |= {f"{name}_sin{k}": F.sin(day * (2 * math.pi * k / length)), f"{name}_cos{k}": F.cos(day * (2 * math.pi * k / length))}
    return out


def fit_regression(train: DataFrame, regressors: list[str] = REGRESSORS, penalty: float = 1e-3) -> PipelineModel:
    """Ridge regression of log y on the seasonal terms and the regressors; effects multiply."""
    terms = seasonal_terms()
    rows = train.withColumns(terms).withColumn("__log", F.log1p("y"))
    return Pipeline(stages=[VectorAssembler(inputCols=[*terms, *regressors], outputCol="__x"), LinearRegression(featuresCol="__x", labelCol="__log", predictionCol="__p", regParam=penalty)]).fit(rows)


def predict_regression(model: PipelineModel, df: DataFrame, z: float = 1.96) -> DataFrame:
    """Add yhat and its interval, from the spread of the training residuals."""
    spread = model.stages[-1].summary.rootMeanSquaredError
    scored = model.transform(df.withColumns(seasonal_terms()))
    at = lambda shift: F.greatest(F.expm1(F.col("__p") + shift), F.lit(0.0))
    return scored.withColumns({"yhat": at(0.0), "yhat_lower": at(-z * spread), "yhat_upper": at(z * spread)}).select(*df.columns, "yhat", "yhat_lower", "yhat_upper")


def series_terms(ds: str = "ds", yearly: int = 2, weekly: int = 3) -> list[Column]:
    """One, a trend and waves of the year and the week."""
    return [F.lit(1.0), *seasonal_terms(ds, yearly, weekly).values()]


def normal_equations(df: DataFrame, by: list[str], terms: list[Column], y: Column) -> DataFrame:
    """(by, n, xx, xy, yy): for each series the sums of products of the terms (upper triangle, row by row), of terms and y, and of y's squares.

    Plain sums: combined before the shuffle, one row a series after it, however long the series are.
    """
    named = df.select(*by, *[t.cast("double").alias(f"x{i}") for i, t in enumerate(terms)], y.cast("double").alias("y"))
    p, x = len(terms), [F.col(f"x{i}") for i in range(len(terms))]
    xx = [F.sum(x[i] * x[j]) for i in range(p) for j in range(i, p)]
    return named.where("y is not null").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.array(*xx).alias("xx"), F.array(*[F.sum(c * F.col("y")) for c in x]).alias("xy"), F.sum(F.col("y") * F.col("y")).alias("yy"))


def solved(equations: DataFrame, penalty: float = 1.0) -> DataFrame:
    """Add ``weights`` (ridge; the first term is not penalised) and ``spread``, the deviation of the residuals, which the sums give as well.

    One small system a row, many at once; nothing of the series themselves is read again.
    """

    def solve(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for n, xx, xy, yy in batches:
            rows = len(n)
            if not rows:
                continue
            b = np.stack(xy.to_list())
            p = b.shape[1]
            a = np.zeros((rows, p, p))
            i, j = np.triu_indices(p)
            a[:, i, j] = a[:, j, i] = np.stack(xx.to_list())
            ridge = a + penalty * np.diag([0.0] + [1.0] * (p - 1))
            w = np.stack([np.linalg.lstsq(r, v, rcond=1e-13)[0] for r, v in zip(ridge, b)])
            squares = yy.to_numpy() - 2 * (w * b).sum(axis=1) + np.einsum("ri,rij,rj->r", w, a, w)
            yield pd.DataFrame({"weights": list(w), "spread": np.sqrt(np.maximum(squares, 0) / n.to_numpy())})

    fit = F.pandas_udf(solve, "weights array<double>, spread double")
    return equations.withColumn("__w", fit("n", "xx", "xy", "yy")).select(*equations.columns, "__w.weights", "__w.spread")


def predicted(df: DataFrame, terms: list[Column], z: float = 1.96) -> DataFrame:
    """Add yhat and its interval to rows with ``weights`` and ``spread``; sums of products, on the log scale and back."""
    p = F.aggregate(F.zip_with(F.array(*terms), "weights", lambda x, w: x * w), F.lit(0.0), lambda acc, v: acc + v)
    at = lambda shift: F.expm1(F.col("__p") + shift)
    return df.withColumn("__p", p).withColumns({"yhat": at(F.lit(0.0)), "yhat_lower": at(-z * F.col("spread")), "yhat_upper": at(z * F.col("spread"))}).drop("__p")


def grouped_forecast(df: DataFrame, key: str, horizon: int = 14, penalty: float = 1.0) -> DataFrame:
    """(key, ds, yhat, yhat_lower, yhat_upper): ``horizon`` days ahead for each series, by regression of log y, from sums alone.

    The days are counted from the last one of all series; each series goes on from its own last day.
    """
    last = df.agg(F.max("ds")).first()[0]
    shifted = df.withColumn("__ds", F.date_add(F.lit("1970-01-01").cast("date"), F.datediff("ds", F.lit(last))))
    models = solved(normal_equations(shifted, [key], series_terms("__ds"), F.log1p("y")), penalty)
    ends = df.groupBy(key).agg(F.max("ds").alias("__last"))
    ahead = models.select(key, "weights", "spread").join(ends, key).withColumn("ds", F.explode(F.sequence(F.date_add("__last", 1), F.date_add("__last", horizon))))
    ahead = ahead.withColumn("__ds", F.date_add(F.lit("1970-01-01").cast("date"), F.datediff("ds", F.lit(last))))
    return predicted(ahead, series_terms("__ds")).select(key, "ds", "yhat", "yhat_lower", "yhat_upper")


def trend_forecast(df: DataFrame, key: str, horizon: int = 14, z: float = 1.96) -> DataFrame:
    """(key, ds, yhat, yhat_lower, yhat_upper): the straight line through log y of each series, ``horizon`` days on."""
    last = df.agg(F.max("ds")).first()[0]
    day = lambda ds: F.datediff(ds, F.lit(last)).cast("double")
    models = solved(normal_equations(df, [key], [F.lit(1.0), day("ds")], F.log1p("y")), 0.0)
    ahead = models.withColumn("ds", F.explode(F.sequence(F.date_add(F.lit(last), 1), F.date_add(F.lit(last), horizon))))
    return predicted(ahead, [F.lit(1.0), day("ds")], z).select(key, "ds", "yhat", "yhat_lower", "yhat_upper")


def errors(df: DataFrame) -> DataFrame:
    """Add the residual, the absolute and the percentage error."""
    off = F.col("y") - F.col("yhat")
    return df.withColumns({"residual": off, "abs_error": F.abs(off), "pct_error": F.try_divide(F.abs(off) * 100.0, F.abs(F.col("y")).cast("double"))})


def accuracy(df: DataFrame) -> DataFrame:
    """One row: n, mae, smape, mdape, rmse, and the interval's coverage if there is one; and a label of readiness."""
    smape = F.try_divide(F.col("abs_error") * 200.0, F.abs("y") + F.abs("yhat"))
    inside = [F.round(F.avg(F.col("y").between(F.col("yhat_lower"), F.col("yhat_upper")).cast("double")) * 100, 2).alias("coverage")] if "yhat_lower" in df.columns else []
    out = errors(df).where(F.col("yhat").isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("abs_error"), 4).alias("mae"), F.round(F.avg(smape), 4).alias("smape"), F.round(F.percentile("pct_error", F.lit(0.5)), 4).alias("mdape"), F.round(F.sqrt(F.avg(F.col("residual") * F.col("residual"))), 4).alias("rmse"), *inside
    )
    s = F.col("smape")
    return out.withColumn("readiness", F.when(s < 10, "excellent").when(s < 15, "good").when(s < 20, "acceptable").otherwise("needs improvement"))


def error_buckets(df: DataFrame) -> DataFrame:
    p = F.col("pct_error")
    bucket = F.when(p < 10, "<10%").when(p < 20, "10-20%").when(p < 50, "20-50%").otherwise(">=50%")
    rows = errors(df).where(p.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("bucket", "n", ratio("n", F.sum("n").over(Window.partitionBy())).alias("pct"))


def regressor_impact(model: PipelineModel, spark, start: str, days: int = 31, regressors: list[str] = REGRESSORS) -> DataFrame:
    """Mean prediction over a grid of days with one regressor at 1 instead of 0, the others 0; ranked by size."""
    grid = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.date_add(F.lit(start).cast("date"), days - 1))).alias("ds"))
    cases = grid.select("ds", F.explode(F.array(F.lit("none"), *map(F.lit, regressors))).alias("regressor")).withColumns({r: (F.col("regressor") == r).cast("double") for r in regressors})
    means = predict_regression(model, cases).groupBy("regressor").agg(F.avg("yhat").alias("m"))
    none = means.where("regressor = 'none'").select(F.col("m").alias("m0"))  # one row
    out = means.where("regressor <> 'none'").join(F.broadcast(none)).select("regressor", F.round(F.col("m") - F.col("m0"), 4).alias("impact"))
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.abs("impact").desc(), "regressor")))


def generalisation(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: the gap between the two splits' smape, and what it says."""
    a, b = accuracy(train).select(F.col("smape").alias("train_smape")), accuracy(test).select(F.col("smape").alias("test_smape"))
    gap = F.round(F.abs(F.col("test_smape") - F.col("train_smape")), 4)
    return a.join(F.broadcast(b)).withColumn("gap", gap).withColumn("verdict", F.when(gap < 2, "none").when(gap < 5, "slight").otherwise("overfit"))


def residual_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    """(bin, n): residuals in equal bins from the smallest to the largest, which is in the last."""
    rows = errors(df).where(F.col("residual").isNotNull()).select("residual")
    span = rows.agg(F.min("residual").alias("lo"), F.max("residual").alias("hi"))  # one row
    placed = F.least(F.lit(bins), F.floor(F.try_divide((F.col("residual") - F.col("lo")) * bins, F.col("hi") - F.col("lo"))) + 1)
    return rows.join(F.broadcast(span)).groupBy(F.coalesce(placed, F.lit(1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
