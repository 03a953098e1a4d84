"""Files of a keyed table laid out along a Morton curve, so that a filter on any of its columns opens few of them."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.operators.versions import Version, rewrite

#: Values that a partition folder's name gives, by column.
Values = dict[str, str]


def number(df: DataFrame, column: str) -> Column:
    """A column's order as a double: of texts, by their first six bytes."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        return F.conv(F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0"), 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def cuts(df: DataFrame, columns: list[str], bits: int) -> list[list[float]]:
    """Up to 2^bits - 1 quantiles of each column, in one pass."""
    shares = F.array(*[F.lit(i / (1 << bits)) for i in range(1, 1 << bits)])
    row = df.agg(*[F.array_distinct(F.percentile_approx(number(df, c), shares, 10_000)).alias(f"c{i}") for i, c in enumerate(columns)]).first()
    return [sorted(values or []) for values in row]


def morton(df: DataFrame, columns: list[str], bits: int = 6) -> Column:
    """The place of a row on the curve through the columns' quantiles: the bits of their places, by turns. Nulls come first."""
    key = F.lit(0).cast("long")
    for i, (c, limits) in enumerate(zip(columns, cuts(df, columns, bits))):
        x = number(df, c)
        place = F.when(x.isNull(), 0).otherwise(F.size(F.filter(F.array(*map(F.lit, limits)), lambda cut: cut < x))) if limits else F.lit(0)
        spread = [F.shiftleft(F.shiftright(place, b).bitwiseAND(F.lit(1)).cast("long"), b * len(columns) + i) for b in range(bits)]
        key = reduce(lambda a, b: a.bitwiseOR(b), spread, key)
    return key


def values(folder: str) -> Values:
    return dict(map(unquote, part.split("=", 1)) for part in folder.split("/")[1:])


def cluster(spark: SparkSession, path: str, columns: list[str], where: Callable[[Values], bool] = lambda _: True, rows_per_file: int = 1_000_000, bits: int = 6) -> Version:
    """Rewrite the partitions that ``where`` chooses (all, by default) in files of about ``rows_per_file`` along the curve, and swap them in.

    Rows of one place on the curve, however many, are split by a hash. The swap is a version of its own: readers of the
    one before keep its files, and a merge that came first raises ``Conflict`` and leaves the table as it was.
    """

    def arranged(df: DataFrame) -> DataFrame:
        partition = df.columns if not df.columns else [c for c in seen if c in df.columns]
        files = max(1, -(-df.count() // rows_per_file))
        placed = df.withColumns({"__z": morton(df, columns, bits), "__salt": F.xxhash64(*df.columns)})
        return placed.repartitionByRange(files, *partition, "__z", "__salt").sortWithinPartitions(*partition, "__z", *columns).drop("__z", "__salt")

    seen: list[str] = []

    def chosen(folder: str) -> bool:
        found = values(folder)
        seen[:] = list(found)
        return where(found)

    return rewrite(spark, path, "cluster", chosen, arranged, lambda df, out: (df.write.partitionBy(*seen) if seen else df.write).parquet(out))


def file_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """(file, rows, least and greatest value of each column) of the files that a table reads."""
    each = [x for c in columns for x in (F.min(c).alias(f"least_{c}"), F.max(c).alias(f"most_{c}"))]
    return df.select(*columns, F.col("_metadata.file_path").alias("file")).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *each)


def opened(df: DataFrame, filters: list[dict[str, object]]) -> list[int]:
    """[all files, then those that each filter (a value for each column) has to open], by the files' ranges."""
    columns = list(dict.fromkeys(c for f in filters for c in f))
    covers = [reduce(lambda a, b: a & b, [(F.col(f"least_{c}") <= F.lit(v)) & (F.col(f"most_{c}") >= F.lit(v)) for c, v in f.items()]) for f in filters]
    return list(file_ranges(df, columns).agg(F.count(F.lit(1)), *[F.count_if(c) for c in covers]).first())
