"""Reading tables, and landing raw records by period with a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def load(spark: SparkSession, folder: str, name: str, merge_schemas: bool = False) -> DataFrame:
    """A table's files; with ``merge_schemas``, columns that only some files have are null in the rows of the others."""
    return spark.read.option("mergeSchema", merge_schemas).parquet(f"{folder}/{name}.parquet")


def with_provenance(df: DataFrame) -> DataFrame:
    """Add when and from which file each row came; for frames read from files, batch or stream."""
    return df.select(
        "*", F.current_timestamp().alias("_ingested_at"), F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_modification_time").alias("_file_modification_time"), F.col("_metadata.file_size").alias("_file_size")
    )


def conform(df: DataFrame, schema: T.StructType, rescue: str = "_rescued_data") -> DataFrame:
    """The schema's columns (missing ones null, those of another type cast where possible), and the rest as JSON in ``rescue``."""
    have = {f.name: f.dataType for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        if f.name not in have:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).try_cast(f.dataType).alias(f.name)

    known = set(schema.names)
    # what doesn't fit its column's type is rescued with the columns that the schema lacks
    lost = [F.when(F.col(f.name).try_cast(f.dataType).isNull(), F.col(f.name)).alias(f.name) for f in schema.fields if f.name in have and have[f.name] != f.dataType]
    rest = [F.col(n) for n in have if n not in known and n != rescue] + lost
    packed = F.nullif(F.to_json(F.struct(*rest)), F.lit("{}")) if rest else F.lit(None).cast("string")
    return df.select(*map(column, schema.fields), packed.alias(rescue))


def period_start(ts: Column, grain: str) -> Column:
    return F.trunc(ts, "month") if grain == "month" else F.to_date(ts)


def period_slice(df: DataFrame, ts: str, start: str, grain: str = "day") -> DataFrame:
    """Rows from ``start`` on, to before the next day or month."""
    first = F.lit(start).cast("date")
    end = F.add_months(first, 1) if grain == "month" else F.date_add(first, 1)
    return df.where((F.col(ts) >= first) & (F.col(ts) < end))


def periods(spark: SparkSession, start: str, end: str, grain: str = "month") -> DataFrame:
    """(start, end) of each day or month; ends are not included."""
    step = F.expr(f"interval 1 {grain}")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), step)).alias("start"))
    return days.withColumn("end", F.add_months("start", 1) if grain == "month" else F.date_add("start", 1))


def settled(df: DataFrame, ts: str, as_of: str, delay_days: int = 2) -> DataFrame:
    """Rows old enough to be complete at the source."""
    return df.where(F.to_date(ts) <= F.date_sub(F.lit(as_of).cast("date"), delay_days))


def validate_periods(df: DataFrame, as_of: str, first: str = "2010-01-01", max_days: int = 32) -> DataFrame:
    """Add ok and reason to rows of (start, end)."""
    reason = (
        F.when(F.col("start") >= F.col("end"), "start is not before end")
        .when(F.col("end") > F.date_add(F.lit(as_of).cast("date"), 1), "end is in the future")
        .when(F.col("start") < F.lit(first).cast("date"), "start is before the first data")
        .when(F.datediff("end", "start") > max_days, "range is too long")
    )
    return df.withColumn("reason", reason).withColumn("ok", F.col("reason").isNull())


def land(df: DataFrame, root: str, ts: str, grain: str = "day", fmt: str = "parquet") -> None:
    """Write by year and month (and day), as Snappy Parquet or gzip JSON; landing a period again replaces it."""
    d = F.to_date(ts)
    parts = {"year": F.date_format(d, "yyyy"), "month": F.date_format(d, "MM")} | ({"day": F.date_format(d, "dd")} if grain == "day" else {})
    dealt = df.withColumns(parts).withColumn("__salt", F.pmod(F.xxhash64(F.col(ts).cast("string")), F.lit(4))).repartition(*parts, "__salt").drop("__salt")
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    writer.option("compression", "snappy").parquet(root) if fmt == "parquet" else writer.option("compression", "gzip").json(root)


def manifest(df: DataFrame, ts: str, grain: str = "day", fmt: str = "parquet", layer: str = "landing") -> DataFrame:
    """(period_start, record_count, column_count, grain, format, compression, layer): one row for each period."""
    facts = {"column_count": F.lit(len(df.columns)), "grain": F.lit(grain), "format": F.lit(fmt), "compression": F.lit("snappy" if fmt == "parquet" else "gzip"), "layer": F.lit(layer)}
    return df.where(F.col(ts).isNotNull()).groupBy(period_start(F.col(ts), grain).alias("period_start")).agg(F.count(F.lit(1)).alias("record_count")).withColumns(facts)


def landed(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """(period_start, record_count, files, bytes, ingested_at) of what ``land`` has written, read from the files themselves."""
    df = spark.read.format(fmt).load(root)
    day = F.col("day") if "day" in df.columns else F.lit(1)
    rows = df.select(F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), day.cast("int")).alias("period_start"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("at"))
    files = rows.groupBy("period_start", "path").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"), F.max("at").alias("at"))
    return files.groupBy("period_start").agg(F.sum("n").alias("record_count"), F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.max("at").alias("ingested_at"))


def missing_periods(wanted: DataFrame, landed: DataFrame) -> DataFrame:
    """Periods (start, end) without a row in the manifest."""
    return wanted.join(landed.select(F.col("period_start").alias("start")), "start", "left_anti")


def land_if_absent(df: DataFrame, root: str, ts: str, wanted: DataFrame, landed: DataFrame, grain: str = "day", fmt: str = "parquet") -> DataFrame:
    """Land the wanted periods that the manifest lacks; (period_start, record_count, file_existed) of all wanted."""
    new = missing_periods(wanted, landed)
    rows = df.withColumn("start", period_start(F.col(ts), grain)).join(F.broadcast(new.select("start")), "start", "left_semi").drop("start")
    land(rows, root, ts, grain, fmt)
    counts = manifest(rows, ts, grain, fmt).select("period_start", "record_count")
    old = landed.join(wanted.select(F.col("start").alias("period_start")), "period_start", "left_semi").select("period_start", "record_count", F.lit(True).alias("file_existed"))
    return old.unionByName(counts.withColumn("file_existed", F.lit(False)))


def validate_counts(manifest: DataFrame, low: int = 50_000, high: int = 350_000) -> DataFrame:
    """Add a status: skipped where the file was there before, warning where the count is 0 or out of range, failed without one."""
    n = F.col("record_count")
    existed = F.col("file_existed") if "file_existed" in manifest.columns else F.lit(False)
    return manifest.withColumn("status", F.when(existed, "skipped").when(n.isNull(), "failed").when((n == 0) | (n < low) | (n > high), "warning").otherwise("passed"))


def run_summary(validated: DataFrame) -> DataFrame:
    """One row: periods by status, and rows."""
    by = {s: F.count_if(F.col("status") == s).alias(s) for s in ("passed", "warning", "skipped", "failed")}
    return validated.agg(F.count(F.lit(1)).alias("periods"), F.coalesce(F.sum("record_count"), F.lit(0)).alias("records"), *by.values())


def staging_sample(df: DataFrame, n: int = 1000, key: str = "unique_key", columns: tuple[str, ...] = ("unique_key", "created_date", "complaint_type", "status")) -> DataFrame:
    """A sample of ``n`` rows with a key, for looking at; which rows is not specified."""
    return df.where(F.col(key).isNotNull()).select(*columns).limit(n)
