"""Latest row for each key, merges, differences and partitioned writes (see ``versions`` for keyed tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_hash(df: DataFrame, columns: list[str] | None = None) -> Column:
    """A digest of a row's values; null differs from empty."""
    return F.sha2(F.to_json(F.struct(*[F.col(c) for c in columns or sorted(df.columns)])), 256)


def ordering(sequence: str | list[str] | None, tie: str | None = None) -> list[str]:
    """The columns that tell which of two rows is the later one."""
    return [*([sequence] if isinstance(sequence, str) else sequence or []), *([tie] if tie else [])]


def scd1_latest(df: DataFrame, keys: list[str], sequence: str | list[str] | None, tie: str | None = None) -> DataFrame:
    """One row for each key: the one of the largest sequence value (a column or several); ties by ``tie``, then by a hash of the row (which alone decides without a sequence).

    An aggregation, combined before the shuffle; null values of the latest row do overwrite. Where the sequence holds all other columns, rows that tie are
    equal, and the sequence alone is shuffled; else of the hash the first half.
    """
    by = ordering(sequence, tie)
    rest = [c for c in df.columns if c not in keys]
    if by and set(rest) <= set(by):
        latest = F.max(F.struct(*dict.fromkeys(by)))
    else:
        latest = F.max_by(F.struct(*rest), F.struct(*by, F.unhex(F.substring(row_hash(df), 1, 32))))
    best = df.groupBy(*keys).agg(latest.alias("__row"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def merged(target: DataFrame, updates: DataFrame, keys: list[str], sequence: str | list[str] | None = None, tie: str | None = None) -> DataFrame:
    """``target`` with ``updates`` put in by key; with a sequence column, older updates are ignored, else updates win."""
    if sequence:
        return scd1_latest(target.unionByName(updates, allowMissingColumns=True), keys, sequence, tie)
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates, allowMissingColumns=True)


def watermark(target: DataFrame, column: str, first: str = "1900-01-01") -> Column:
    """The largest value in the target, as a literal."""
    return F.lit(target.agg(F.max(column)).first()[0] or first).cast(target.schema[column].dataType)


def newer(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    return source.where(F.col(column) > watermark(target, column))


def write_partitioned(df: DataFrame, path: str, columns: list[str], mode: str = "error", salt: int = 8) -> None:
    """Write by partition columns; rows are dealt by them and a salt, so one large partition is several tasks and files.

    What is still more than ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` for one task is split further, so a task's share does not grow with the table.
    """
    if columns:
        dealt = df.withColumn("__salt", F.pmod(F.xxhash64(*df.columns), F.lit(salt))).hint("rebalance", *map(F.col, [*columns, "__salt"])).drop("__salt")
        dealt.write.mode(mode).partitionBy(*columns).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def change_diff(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, change): insert, update or delete; equal rows are left out."""
    values = sorted(c for c in new.columns if c not in keys)
    a, b = (df.select(*keys, row_hash(df, values).alias(h)) for df, h in ((old, "__old"), (new, "__new")))
    joined = a.join(b, keys, "full_outer")
    kind = F.when(F.col("__old").isNull(), "insert").when(F.col("__new").isNull(), "delete").when(F.col("__old") != F.col("__new"), "update")
    return joined.withColumn("change", kind).where("change is not null").select(*keys, "change")
