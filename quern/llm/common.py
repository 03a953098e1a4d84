"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Input bytes handed to a Python step at once; a single longer row still goes whole.
SLICE_BYTES = 4 << 20
#: Rows in a batch between Spark and a Python worker, unless the session asks for fewer: documents are long.
BATCH_ROWS = 1_000
#: Bytes in such a batch; a single longer row still goes whole.
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where none is configured and Spark runs in one process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="quern-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it to the shared folder as Parquet and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quern-{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for file in df.inputFiles()[:1]:
            path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
            if "/quern-" in path.toString():
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, *names: str) -> list[str]:
    """Columns of ``df`` that do not clash with ``names`` (Spark compares names without case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_crc(column: str) -> Column:
    """CRC-32 of a column's value as text."""
    return F.crc32(F.col(column).cast("string"))


def sampled(df: DataFrame, key: str, bound: int, size: Column | None = None, most_bytes: int = 0) -> DataFrame:
    """About ``bound`` rows of ``df`` (all, if it has no more), chosen by a hash of ``key``.

    With ``size`` (bytes of a row), about ``most_bytes`` at most, and no row of over a sixteenth of that. The
    choice depends on the keys and sizes alone, so a rerun after a lost executor makes the same one.
    """
    if size is not None:
        df = df.where(F.coalesce(size, F.lit(0)) <= most_bytes // 16)
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0)) if size is not None else F.lit(0)).first()
    if n <= bound and total <= most_bytes:
        return df
    share = min(bound / n, most_bytes / total if total else 1.0)
    return df.where(F.pmod(F.xxhash64(F.col(quoted(key)), F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))


def sampled_rows(df: DataFrame, bound: int, size: Column | None = None, most_bytes: int = 0) -> DataFrame:
    """About ``bound`` rows of ``df`` (all, if it has no more), whatever their keys are: equal rows are chosen one by one.

    With ``size`` (bytes of a row), about ``most_bytes`` at most, and no row of over a sixteenth of that. The choice goes by a hash
    of the row's place in the scan, and never leaves out all rows of a table that has some. To be collected at once, from a table that is stored or read as it is.
    """
    if size is not None:
        df = df.where(F.coalesce(size, F.lit(0)) <= most_bytes // 16)
    n, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0)) if size is not None else F.lit(0)).first()
    if n <= bound and total <= most_bytes:
        return df
    share = min(bound / n, most_bytes / total if total else 1.0)
    return df.where(chosen(F.lit(max(1, int(share * (1 << 30))))))


def chosen(share: Column) -> Column:
    """Whether a row is taken, of 2^30 ``share`` times: by a hash of its place in the scan."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id(), F.lit("sample")), F.lit(1 << 30)) < share


def small_batches(spark: SparkSession) -> None:
    """Hold the session to batches that keep a worker's memory low with long rows, by rows and by bytes.

    Spark reads these settings when a job starts, not when its plan is made, so they stay set in the session;
    smaller values that it already has are kept.
    """
    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    if not 0 < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(size)) <= BATCH_BYTES:
        spark.conf.set(size, BATCH_BYTES)


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``limit`` bytes."""
    if batch.num_rows:
        step = max(1, int(batch.num_rows * limit / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def with_python_columns(df: DataFrame, inputs: list[str], outputs: list[T.StructField], make: Callable[[], Callable], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add or replace ``outputs``, computed from ``inputs`` in Arrow batches.

    ``make()`` is called once a task and gives a function from a list of Arrow arrays to a list of
    Arrow arrays or Python lists of the same length. All other columns pass through untouched; a
    column of the input that has an output's name is replaced; those in ``drop`` are not given back.
    """
    kept = without(df, *[f.name for f in outputs], *drop)
    fields = [*(df.schema[c] for c in kept), *outputs]
    needed = list(dict.fromkeys([*kept, *inputs]))
    kinds = [_arrow_type(f.dataType) for f in outputs]

    def run(batches):
        step = make()
        for batch in batches:
            for part in slices(batch):
                made = step([part.column(needed.index(c)) for c in inputs])
                made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, k) for x, k in zip(made, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(needed.index(c)) for c in kept), *made], names=[f.name for f in fields])

    small_batches(df.sparkSession)
    # names with dots can't enter mapInArrow
    plain = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(needed)])
    return plain.mapInArrow(run, T.StructType(fields))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    simple = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind.fields])
    return simple[kind.simpleString()]
