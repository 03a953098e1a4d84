"""Files to an append-only raw table, and on to a keyed clean one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quern.operators.silver import silver
from quern.operators.versions import merge
from quern.sources.landing import with_provenance


def bronze_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int = 100) -> DataFrame:
    """New Parquet files under ``path``, at most ``max_files`` a batch, with where each row came from."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
    return with_provenance(reader.parquet(path))


def append_stream(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, appended; a rerun goes on where the checkpoint ends."""
    return stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def upsert_stream(stream: DataFrame, out: str, checkpoint: str, keys: list[str], sequence: str, tie: str | None = None, clean: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Clean each batch and merge it into the keyed table; rows out of order lose to later ones, a replayed batch changes nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        merge(batch.sparkSession, out, clean(batch) if clean else batch, keys, sequence, tie, batch_id=batch_id)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def silver_stream(stream: DataFrame, out: str, checkpoint: str, as_of: str, min_year: int = 2010) -> StreamingQuery:
    return upsert_stream(stream, out, checkpoint, ["unique_key"], "updated_date", "_ingested_at", lambda df: silver(df, as_of, min_year))


def daily_counts(stream: DataFrame, ts: str, by: str, late: str = "2 days") -> DataFrame:
    """Rows of each day and ``by``; a day is final once the watermark has passed it."""
    timed = stream.withColumn("__ts", F.col(ts).cast("timestamp")).withWatermark("__ts", late)
    return timed.groupBy(F.window("__ts", "1 day"), by).agg(F.count(F.lit(1)).alias("n")).select(F.to_date("window.start").alias("day"), by, "n")
