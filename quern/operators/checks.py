"""Data-quality checks: each gives the rows that violate it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.where(nulls(*columns))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(values))


def relationships(df: DataFrame, column: str, to: DataFrame, to_column: str, where: Column | None = None) -> DataFrame:
    """Rows whose key has no member; null keys are no violation."""
    rows = df.where(F.col(column).isNotNull() if where is None else F.col(column).isNotNull() & where)
    return rows.join(to.select(F.col(to_column).alias(column)), column, "left_anti")


def accepted_range(df: DataFrame, column: str, low: float | None = None, high: float | None = None) -> DataFrame:
    return df.where(outside(column, low, high))


def expression(df: DataFrame, truth: Column) -> DataFrame:
    return df.where(~truth)


def closed_before_created(df: DataFrame) -> DataFrame:
    return df.where(F.col("closed_date_key") < F.col("created_date_key"))


def inconsistent_hours(df: DataFrame, days: float = 1.0) -> DataFrame:
    return df.where(F.abs(F.col("response_time_hours") / 24 - F.col("response_time_days")) > days)


def mismatched(df: DataFrame, column: str, key: str, dim: DataFrame, dim_key: str, dim_column: str) -> DataFrame:
    """Rows whose copied attribute differs from the dimension's."""
    return df.join(dim.select(F.col(dim_key).alias(key), F.col(dim_column).alias("__own")), key).where(F.col(column) != F.col("__own")).drop("__own")


def closed_without_time(df: DataFrame, exempt_flagged: bool = False) -> DataFrame:
    return df.where(untimed(exempt_flagged))


def outside_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    return df.where(out_of_bounds(bounds))


def share_over(df: DataFrame, condition: Column, limit: float) -> DataFrame:
    """One row if the condition's share of all rows is over ``limit`` percent."""
    one = df.agg(F.count_if(condition).alias("n"), F.count(F.lit(1)).alias("total"))
    return one.withColumn("share", F.round(F.try_divide(F.col("n") * F.lit(100.0), F.col("total")), 2)).where(F.col("share") > limit)


def null_keys(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with a null key, and the name of the first such."""
    return df.withColumn("null_key", F.coalesce(*[F.when(F.col(c).isNull(), c) for c in columns])).where("null_key is not null")


def missing_members(df: DataFrame, column: str, expected: list[str]) -> DataFrame:
    want = df.sparkSession.createDataFrame([(e,) for e in expected], f"{column} string")
    return want.join(df.select(column).distinct(), column, "left_anti")


def too_long(df: DataFrame, days: float = 730) -> DataFrame:
    return df.where(F.col("response_time_days") > days)


def date_gaps(df: DataFrame, column: str) -> DataFrame:
    """Days between the first and the last that are missing."""
    span = df.agg(F.min(column).alias("a"), F.max(column).alias("b")).where("a is not null").select(F.explode(F.sequence("a", "b")).alias(column))
    return span.join(df.select(column), column, "left_anti")


def freshness(df: DataFrame, column: str, as_of: str, warn_hours: float = 25, error_hours: float = 30) -> DataFrame:
    age = (F.unix_timestamp(F.lit(as_of).cast("timestamp")) - F.unix_timestamp(F.col("last").cast("timestamp"))) / 3600.0
    last = df.agg(F.max(column).alias("last"))
    return last.select("last", F.round(age, 2).alias("age_hours"), F.when(age > error_hours, "error").when(age > warn_hours, "warn").otherwise("pass").alias("status"))


@dataclass
class Check:
    """A check that joins or groups: it gives the violating rows of some tables."""

    name: str
    severity: str
    rows: Callable[[dict[str, DataFrame]], DataFrame]


@dataclass
class Rule:
    """A check that a row of one table passes or not by itself: ``violated`` makes the condition (null: passed)."""

    name: str
    severity: str
    table: str
    violated: Callable[[], Column]

    def rows(self, tables: dict[str, DataFrame]) -> DataFrame:
        return tables[self.table].where(self.violated())


def counted(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(check_name, severity, violations) of all rules of a table, in one scan of it."""
    counts = df.agg(*[F.count_if(F.coalesce(r.violated(), F.lit(False))).alias(f"r{i}") for i, r in enumerate(rules)])
    told = [F.struct(F.lit(r.name).alias("check_name"), F.lit(r.severity).alias("severity"), F.col(f"r{i}").alias("violations")) for i, r in enumerate(rules)]
    return counts.select(F.explode(F.array(*told)).alias("c")).select("c.*")


def run_checks(tables: dict[str, DataFrame], checks: list[Check | Rule]) -> DataFrame:
    """(check_name, severity, violations, status) of a suite; only counts leave each check.

    The rules of a table are one aggregate over one scan of it, reading the columns that they name; checks that join or
    group are apart.
    """
    by_table: dict[str, list[Rule]] = {}
    for c in checks:
        if isinstance(c, Rule):
            by_table.setdefault(c.table, []).append(c)
    parts = [counted(tables[t], rules) for t, rules in by_table.items()]
    parts += [c.rows(tables).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "violations") for c in checks if isinstance(c, Check)]
    return reduce(DataFrame.unionByName, parts).withColumn("status", F.when(F.col("violations") == 0, "pass").otherwise(F.col("severity")))


def nulls(*columns: str) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def outside(column: str, low: float | None = None, high: float | None = None) -> Column:
    below = F.lit(False) if low is None else F.col(column) < low
    return below | (F.lit(False) if high is None else F.col(column) > high)


def untimed(exempt_flagged: bool = False) -> Column:
    """Closed without a response time; with ``exempt_flagged``, though no date is marked as wrong."""
    missing = F.col("is_closed") & F.col("response_time_hours").isNull()
    marked = F.col("has_invalid_closed_date") | F.col("has_historical_closed_date") | F.col("has_future_closed_date")
    return missing & ~marked if exempt_flagged else missing


def out_of_bounds(bounds: dict[str, tuple[float, float]]) -> Column:
    return F.col("has_valid_location") & reduce(lambda a, b: a | b, [~F.col(c).between(lo, hi) for c, (lo, hi) in bounds.items()])


def profile(df: DataFrame) -> DataFrame:
    """(column_name, rows, nulls, null_pct) of each column, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = one.select("__rows", F.explode(F.map_from_arrays(F.array(*map(F.lit, df.columns)), F.array(*[F.col(c) for c in df.columns]))).alias("column_name", "nulls"))
    return long.select("column_name", F.col("__rows").alias("rows"), "nulls", F.round(F.try_divide(F.col("nulls") * F.lit(100.0), F.col("__rows")), 2).alias("null_pct"))


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """(column_name, drift, old_type, new_type): added, removed and retyped columns."""
    spark = old.sparkSession
    a, b = (spark.createDataFrame(df.dtypes, f"column_name string, {t} string") for df, t in ((old, "old_type"), (new, "new_type")))
    kind = F.when(F.col("old_type").isNull(), "added").when(F.col("new_type").isNull(), "removed").when(F.col("old_type") != F.col("new_type"), "retyped")
    return a.join(b, "column_name", "full_outer").withColumn("drift", kind).where("drift is not null").select("column_name", "drift", "old_type", "new_type")
