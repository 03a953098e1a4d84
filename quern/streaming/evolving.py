"""Streams of files whose columns change: every file is read by its own schema, and what does not fit is rescued."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quern.operators.versions import merge
from quern.sources.landing import conform, with_provenance


def arriving_files(spark: SparkSession, path: str, max_files: int = 100, suffix: str = "*.parquet") -> DataFrame:
    """New files under ``path`` as a stream of (path, modificationTime, length), ``max_files`` a batch; their contents are not read."""
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", suffix).option("recursiveFileLookup", True).option("maxFilesPerTrigger", max_files)
    return reader.load(path).select("path", "modificationTime", "length")


def read_files(spark: SparkSession, files: list[str], schema: T.StructType, rescue: str = "_rescued_data") -> DataFrame:
    """Rows of Parquet files in the columns of ``schema``: a column that a file lacks is null, one that ``schema`` lacks, or a value that doesn't fit its type, is in ``rescue``.

    Files are grouped by the schema that they have, so that a column may be a number in some and a text in others.
    """
    if not files:
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(rescue, T.StringType())]))
    alike: dict[str, list[str]] = {}
    for file in files:
        alike.setdefault(spark.read.parquet(file).schema.json(), []).append(file)
    return reduce(DataFrame.unionByName, [fitted_rows(spark.read.schema(T.StructType.fromJson(json.loads(kind))).parquet(*some), schema, rescue) for kind, some in alike.items()])


def fitted_rows(df: DataFrame, schema: T.StructType, rescue: str) -> DataFrame:
    """The schema's columns, what is rescued, and where each row came from."""
    told = with_provenance(df)
    own = [c for c in told.columns if c not in df.columns]
    fitted = conform(told, T.StructType([*schema.fields, *[told.schema[c] for c in own]]), rescue)
    return fitted.select(*schema.names, rescue, *own)


def evolving_upsert(
    spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str, keys: list[str], sequence: str, tie: str | None = None,
    clean: Callable[[DataFrame], DataFrame] | None = None, max_files: int = 100, partition: list[str] | None = None,
) -> StreamingQuery:
    """New files into the keyed table at ``out``, all that are there now; a rerun goes on where the checkpoint ends.

    A batch is the rows of at most ``max_files`` files, so its list of files is bounded. It is merged with its number: one that was
    merged, but not yet noted in the checkpoint when the stream died, changes nothing when it comes again. Rows out of order lose to later ones.
    """

    def apply(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        files = sorted(r.path for r in batch.select("path").collect())
        if files:
            rows = read_files(session, files, schema)
            merge(session, out, clean(rows) if clean else rows, keys, sequence, tie, partition=partition, batch_id=number)

    stream = arriving_files(spark, path, max_files)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
