"""Tables in the folder that all machines share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only where none is set and Spark runs in one process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quern-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def work_dir(spark: SparkSession) -> str:
    """A new folder where the cluster shares files."""
    return f"{shared_dir(spark)}/quern-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: what several steps read is computed once, and survives a lost executor as it is."""
    path = f"{shared_dir(df.sparkSession)}/quern-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if "/quern-" in path.toString():
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
