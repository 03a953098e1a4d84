"""Columns that many summaries share."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

#: percentile_approx with this accuracy is exact for groups of up to as many rows.
ACCURACY = 1_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, digits: int = 2) -> Column:
    """Round, from nine digits on, so that the order in which doubles were added does not show."""
    return F.round(F.round(col(c), 9), digits)


def ratio(a: Column | str, b: Column | str, digits: int = 2, times: float = 100.0) -> Column:
    """a * times / b as a rounded double; null where b is 0 or null."""
    return rounded(F.try_divide(col(a).cast("double") * F.lit(times), col(b).cast("double")), digits)


def change(now: Column | str, before: Column | str) -> Column:
    """Change in percent; null without a value before."""
    return ratio(col(now).cast("double") - col(before).cast("double"), before)


def trend(now: Column | str, before: Column | str, up: float, down: float, names: tuple[str, str]) -> Column:
    now, before = col(now).cast("double"), col(before).cast("double")
    return F.when(before.isNull(), "NO_DATA").when(now > before * up, names[0]).when(now < before * down, names[1]).otherwise("STABLE")


def median(c: Column | str) -> Column:
    """The lower median."""
    return F.percentile_approx(col(c), 0.5, ACCURACY)


def trailing(order: str, rows: int, *by: str) -> Window:
    """The last ``rows`` rows up to this one."""
    return Window.partitionBy(*by).orderBy(order).rowsBetween(1 - rows, 0)


def day_number(key: str = "date_key") -> Column:
    """Days since 1970 of a yyyyMMdd key."""
    return F.unix_date(F.to_date(F.col(key).cast("string"), "yyyyMMdd"))


class Rolling:
    """Means, lags and deviations of a measure over the rows of a key before a row: by rows, or by days.

    By days, frames are ranges of day numbers, and a day without a row counts 0 from the day ``first`` on (a day
    number; before it there is nothing): the same as rows over a table that has every day for every key, which is not built.
    """

    def __init__(self, *by: str, first: int | None = None, order: str = "date_key") -> None:
        self.by, self.first, self.order = by, first, order
        self.day = day_number(order)

    def _range(self, start: int, end: int) -> WindowSpec:
        return Window.partitionBy(*self.by).orderBy(self.day).rangeBetween(start, end)

    def mean(self, c: Column, n: int) -> Column:
        if self.first is None:
            return F.avg(c).over(trailing(self.order, n, *self.by))
        return F.sum(c).over(self._range(1 - n, 0)) / self._days(n).cast("double")

    def lag(self, c: Column, n: int = 1) -> Column:
        if self.first is None:
            return F.lag(c, n).over(Window.partitionBy(*self.by).orderBy(self.order))
        return F.coalesce(F.sum(c).over(self._range(-n, -n)), F.when(self.day - n >= self.first, 0))

    def deviation(self, c: Column, n: int) -> Column:
        if self.first is None:
            return F.stddev_samp(c).over(trailing(self.order, n, *self.by))
        frame, days = self._range(1 - n, 0), self._days(n)
        spread = F.sum(c * c).over(frame).cast("double") - F.pow(F.sum(c).over(frame).cast("double"), 2) / days
        return F.when(days > 1, F.sqrt(F.greatest(spread, F.lit(0.0)) / (days - 1)))

    def _days(self, n: int) -> Column:
        return F.least(F.lit(n), self.day - self.first + 1)


def top_n(counts: DataFrame, by: list[str], name: str, count: str, n: int, prefix: str, suffix: str = "") -> DataFrame:
    """One row for each ``by``: the n largest of (name, count) as columns; ties go to the smaller name.

    The rank is limited before the shuffle; only ``n`` rows of each group reach the pivot.
    """
    ranked = counts.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(count), name))).where(F.col("__rank") <= n)
    aggs = []
    for i in range(1, n + 1):
        here = F.col("__rank") == i
        aggs += [F.max(F.when(here, F.col(name))).alias(f"{prefix}_{i}{suffix}"), F.max(F.when(here, F.col(count))).alias(f"{prefix}_{i}_count")]
    return ranked.groupBy(*by).agg(*aggs)


def any_like(c: Column, patterns: list[str]) -> Column:
    """Whether one of the substrings occurs (with % inside as in LIKE)."""
    tests = [c.like(f"%{p}%") if "%" in p else c.contains(p) for p in patterns]
    return reduce(lambda a, b: a | b, tests)
