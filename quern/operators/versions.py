"""Keyed tables on plain Parquet as versions, each a list of folders.

    data/__version=<tag>/<partition>=<value>/...   what one write brought
    feed/__version=<tag>/                          the rows that a merge changed
    _versions/<number>                             a version: its folders, by reference, and its feed

A merge writes anew only the folders that hold a changed key; the others are carried from version to version by name. It
counts from the moment that the file with the next number appears: a rename that fails if another writer was there first, who is then
merged upon. A crash leaves the version before, and folders that nothing names, which ``vacuum`` removes.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.shared import discard, stored
from quern.operators.upsert import ordering, scd1_latest, write_partitioned

TAG = "__version"


class Conflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


@dataclass(frozen=True)
class Version:
    """``folders``: files of each folder below ``data``; ``added``: those that this version wrote; ``batch``: the highest merged so far."""

    number: int
    kind: str
    schema: str
    partition: list[str]
    folders: dict[str, int]
    added: list[str] = field(default_factory=list)
    batch: int | None = None
    feed: str | None = None

    @property
    def columns(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.schema))


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the versions that there are."""
    folder, fs = _fs(spark, f"{path}/_versions")
    names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
    return sorted(int(n) for n in names if n.isdigit())


def version(spark: SparkSession, path: str, number: int | None = None) -> Version | None:
    """A version, the newest if no number is given; None if there is none."""
    known = numbers(spark, path)
    if number is None and known:
        number = known[-1]
    if number not in known:
        return None
    file, fs = _fs(spark, f"{path}/_versions/{number}")
    stream = fs.open(file)
    try:
        return Version(**json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def commit(spark: SparkSession, path: str, made: Version) -> Version:
    """Put down a version under its number; ``Conflict`` if there is one already."""
    draft, fs = _fs(spark, f"{path}/_versions/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(asdict(made)).encode()))
    out.close()
    target, _ = _fs(spark, f"{path}/_versions/{made.number}")
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(target), spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0))
    except Exception as e:
        fs.delete(draft, False)
        if fs.exists(target):
            raise Conflict(f"version {made.number} of {path} is there already") from e
        raise
    return made


def _rows(spark: SparkSession, path: str, v: Version, folders: list[str] | None = None) -> DataFrame:
    """The rows of a version, or of some of its folders, in one scan; partition columns prune it."""
    names = list(v.folders) if folders is None else folders
    if not names:
        return spark.createDataFrame([], v.columns)
    full = T.StructType([*v.columns.fields, T.StructField(TAG, T.StringType())])
    return spark.read.schema(full).option("basePath", f"{path}/data").parquet(*[f"{path}/data/{f}" for f in names]).select(*v.columns.names)


def at(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The rows of a version that is still kept."""
    v = version(spark, path, number)
    if v is None:
        raise ValueError(f"{path} has no version {number}")
    return _rows(spark, path, v)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version's rows; None before the first."""
    v = version(spark, path)
    return None if v is None else _rows(spark, path, v)


def _foldered(df: DataFrame) -> DataFrame:
    """With ``__folder``, the folder of each row's file (as Spark writes it, escaped)."""
    return df.withColumn("__folder", F.regexp_extract(F.col("_metadata.file_path"), rf"/data/({TAG}=.*)/[^/]+$", 1))


def _written(spark: SparkSession, path: str, df: DataFrame, partition: list[str], salt: int = 1) -> dict[str, int]:
    """Write rows as new folders: (folder, files) of each that got any."""
    root = f"{TAG}={uuid.uuid4().hex[:16]}"
    write_partitioned(df, f"{path}/data/{root}", partition, salt=salt)
    out: dict[str, int] = {}
    for file in spark.read.schema(df.schema).parquet(f"{path}/data/{root}").inputFiles():
        folder = unquote(file[file.index(f"/data/{root}") + 6 :].rpartition("/")[0])
        out[folder] = out.get(folder, 0) + 1
    return out


def _drop(spark: SparkSession, path: str, folders: list[str]) -> None:
    for root in {f.partition("/")[0] for f in folders}:
        p, fs = _fs(spark, f"{path}/data/{root}")
        fs.delete(p, True)


def _same(a: str, b: str, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])


def _changes(there: DataFrame, new: DataFrame, keys: list[str], columns: list[str], sequence: str | list[str] | None, tie: str | None) -> DataFrame:
    """Rows that ``new`` changes: their new image (a deleted row's last one), ``__change`` and the folder that they stand in.

    Rows are digested once they are joined, so no digest is shuffled.
    """
    text = lambda row: F.to_json(F.col(row))
    order = lambda row: F.struct(*[F.col(row)[c] for c in ordering(sequence, tie)], F.sha2(text(row), 256))
    old = there.select(*keys, F.struct(*columns).alias("o"), "__folder").alias("old")
    put = new.select(*keys, F.struct(*columns).alias("n"), "__delete").alias("new")
    both = put.join(old, _same("new", "old", keys), "left")
    wins = order("n") > order("o") if sequence else F.lit(True)
    kind = (
        F.when(F.col("o").isNull(), F.when(~F.col("__delete"), "insert"))
        .when(F.col("__delete") & (wins | (order("n") == order("o"))), "delete")
        .when(~F.col("__delete") & wins & (text("n") != text("o")), "update")
    )
    image = F.when(F.col("__delete"), F.col("o")).otherwise(F.col("n"))
    found = both.select(image.alias("i"), kind.alias("__change"), "__folder").where("__change is not null")
    return found.select(*[F.col("i")[c].alias(c) for c in columns], "__change", "__folder")


def merge(
    spark: SparkSession, path: str, updates: DataFrame, keys: list[str], sequence: str | list[str] | None = None, tie: str | None = None, partition: list[str] | None = None,
    deletes: Column | str | None = None, batch_id: int | None = None, attempts: int = 5, salt: int = 1,
) -> Version:
    """Put ``updates`` into the keyed table at ``path``, and return the version that holds them.

    Of rows with one key the last by ``sequence`` (a column or several), ``tie`` and a hash of the row counts, in the updates and against the table, so rows
    out of order change nothing; without a sequence updates win. Rows where ``deletes`` holds (a condition, or the name of a column that is not
    kept) remove their key; a later merge of an older row brings it back, since nothing remembers what was deleted. Null keys are equal to each other. Columns that the table lacks are added,
    those that the updates lack are null in them. Partition columns are those of the first version; a key may move between them.
    A batch whose id is not above the highest one merged is not applied again.

    Read of the table are the keys of all files, and then the folders that hold a key of the updates; written are the changed rows (as the
    feed) and the folders that hold one of those, with what else is in them. If another writer commits first, all is done again on their version.
    """
    base = version(spark, path)
    if _merged_already(base, batch_id):
        return base
    if deletes is None:
        last = scd1_latest(updates, keys, sequence, tie).withColumn("__delete", F.lit(False))
    else:
        marked = updates.withColumn("__delete", F.coalesce(F.col(deletes) if isinstance(deletes, str) else deletes, F.lit(False)))
        last = scd1_latest(marked.drop(deletes) if isinstance(deletes, str) else marked, keys, sequence, tie)
    latest = stored(last, "updates")
    own = [c for c in latest.columns if c != "__delete"]
    for attempt in range(attempts):
        base = version(spark, path)
        if _merged_already(base, batch_id):
            break
        before = base.columns.fields if base else []
        fields = [*before, *[T.StructField(f.name, f.dataType) for f in latest.schema.fields if f.name in own and f.name not in {b.name for b in before}]]
        schema, columns = T.StructType([T.StructField(f.name, f.dataType) for f in fields]), [f.name for f in fields]
        made = Version(base.number + 1 if base else 1, "merge", schema.json(), base.partition if base else partition or [], {}, batch=base.batch if base else None)
        new = latest.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in own else F.lit(None).cast(f.dataType).alias(f.name) for f in fields], "__delete")
        there = replace(base, schema=schema.json()) if base else None
        feed, touched = _feed(spark, path, there, new, keys, columns, sequence, tie)
        images = feed.where("__change <> 'delete'").select(*columns)
        if touched:
            moved = feed.where("__folder is not null").select(*keys).alias("moved")
            rest = _rows(spark, path, there, touched).alias("rest")
            images = rest.join(moved, _same("rest", "moved", keys), "left_anti").unionByName(images)
        added = _written(spark, path, images, made.partition, salt)
        kept = {f: n for f, n in (base.folders if base else {}).items() if f not in touched}
        tag = feed.inputFiles()[0].rpartition("/")[0].rpartition("=")[2] if feed.inputFiles() else None
        highest = max([b for b in (made.batch, batch_id) if b is not None], default=None)
        try:
            done = commit(spark, path, replace(made, folders=kept | added, added=list(added), batch=highest, feed=tag))
            discard(latest)
            return done
        except Conflict:
            _drop(spark, path, list(added))
            if tag:
                _fs(spark, path)[1].delete(_fs(spark, f"{path}/feed/{TAG}={tag}")[0], True)
            if attempt == attempts - 1:
                raise
    discard(latest)
    return base


def _merged_already(base: Version | None, batch_id: int | None) -> bool:
    return base is not None and batch_id is not None and base.batch is not None and base.batch >= batch_id


def _feed(spark: SparkSession, path: str, base: Version | None, new: DataFrame, keys: list[str], columns: list[str], sequence: str | list[str] | None, tie: str | None) -> tuple[DataFrame, list[str]]:
    """(what ``new`` changes, as written to the feed; the folders that hold a changed key)."""
    there = new.select(*columns, F.lit(None).cast("string").alias("__folder")).limit(0)
    if base is not None and base.folders:
        wanted = new.select(*keys).alias("wanted")
        mine = _foldered(_rows(spark, path, base)).select(*keys, "__folder").alias("mine")
        near = [unquote(r[0]) for r in mine.join(wanted, _same("mine", "wanted", keys), "left_semi").select("__folder").distinct().collect()]
        if near:
            there = _foldered(_rows(spark, path, base, near))
    tag = uuid.uuid4().hex[:16]
    found = _changes(there, new, keys, columns, sequence, tie)
    found.write.parquet(f"{path}/feed/{TAG}={tag}")
    feed = spark.read.schema(found.schema).parquet(f"{path}/feed/{TAG}={tag}")
    return feed, [unquote(r[0]) for r in feed.select("__folder").where("__folder is not null").distinct().collect()]


def upsert(spark: SparkSession, path: str, updates: DataFrame, keys: list[str], sequence: str | list[str] | None = None, tie: str | None = None, partition: list[str] | None = None, batch_id: int | None = None) -> DataFrame:
    """``merge``, and the rows of the newest version."""
    merge(spark, path, updates, keys, sequence, tie, partition, batch_id=batch_id)
    return current(spark, path)


def overwrite(spark: SparkSession, path: str, df: DataFrame, partition: list[str] | None = None, salt: int = 1) -> Version:
    """A full refresh: the table is ``df`` from the next version on, and readers of earlier ones keep theirs. It has no feed."""
    base = version(spark, path)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    added = _written(spark, path, df, partition or [], salt)
    made = Version(base.number + 1 if base else 1, "overwrite", schema.json(), partition or [], added, list(added), base.batch if base else None)
    try:
        return commit(spark, path, made)
    except Conflict:
        _drop(spark, path, list(added))
        raise


def rewrite(spark: SparkSession, path: str, kind: str, folders: Callable[[str], bool], arranged: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame, str], None]) -> Version:
    """The rows of some folders written anew, otherwise arranged; no row changes, so there is no feed. ``Conflict`` if another version came meanwhile."""
    base = version(spark, path)
    if base is None:
        raise ValueError(f"{path} has no version")
    chosen = [f for f in base.folders if folders(f)]
    root = f"{TAG}={uuid.uuid4().hex[:16]}"
    added: dict[str, int] = {}
    if chosen:
        rows = _rows(spark, path, base, chosen)
        write(arranged(rows), f"{path}/data/{root}")
        for file in spark.read.schema(rows.schema).parquet(f"{path}/data/{root}").inputFiles():
            folder = unquote(file[file.index(f"/data/{root}") + 6 :].rpartition("/")[0])
            added[folder] = added.get(folder, 0) + 1
    kept = {f: n for f, n in base.folders.items() if f not in chosen}
    try:
        return commit(spark, path, replace(base, number=base.number + 1, kind=kind, folders=kept | added, added=list(added), feed=None))
    except Conflict:
        _drop(spark, path, list(added))
        raise


def changes(spark: SparkSession, path: str, after: int, upto: int | None = None) -> DataFrame:
    """The feed of the versions after ``after``: the columns, ``change`` (insert, update, delete) and ``version``; read are their files alone.

    Versions without a changed row (compacted ones too) give none. An overwritten version has no feed, and asking for it raises.
    """
    known = [version(spark, path, n) for n in numbers(spark, path)]
    if not known:
        raise ValueError(f"{path} has no version")
    last = known[-1]
    wanted = [v for v in known if after < v.number <= (last.number if upto is None else upto)]
    if len(wanted) < (last.number if upto is None else min(upto, last.number)) - after or any(v.kind == "overwrite" for v in wanted):
        raise ValueError(f"the versions of {path} after {after} are not all there with their feeds")
    tags = {v.feed: v.number for v in wanted if v.feed}
    fields = [*last.columns.fields, *[T.StructField(c, T.StringType()) for c in ("__change", "__folder", TAG)]]
    if not tags:
        return spark.createDataFrame([], T.StructType([*last.columns.fields, T.StructField("change", T.StringType()), T.StructField("version", T.LongType())]))
    rows = spark.read.schema(T.StructType(fields)).option("basePath", f"{path}/feed").parquet(*[f"{path}/feed/{TAG}={t}" for t in tags])
    number = F.create_map(*[F.lit(x) for kv in tags.items() for x in kv])[F.col(TAG)].cast("long")
    return rows.select(*last.columns.names, F.col("__change").alias("change"), number.alias("version"))


def replayed(old: DataFrame, feed: DataFrame, keys: list[str]) -> DataFrame:
    """``old`` with a feed's last change of each key put in: the table as it was at the end of the feed."""
    columns = [c for c in feed.columns if c not in ("change", "version")]
    last = feed.groupBy(*keys).agg(F.max_by(F.struct("change", *[c for c in columns if c not in keys]), "version").alias("l"))
    rest = old.alias("rest").join(last.select(*keys).alias("moved"), _same("rest", "moved", keys), "left_anti")
    images = last.where("l.change <> 'delete'").select(*[F.col(c) if c in keys else F.col(f"l.{c}").alias(c) for c in columns])
    return rest.unionByName(images, allowMissingColumns=True)


def history(spark: SparkSession, path: str) -> DataFrame:
    """A row for each kept version: what it wrote anew and what it carried on, in folders and files."""
    rows = []
    for v in (version(spark, path, n) for n in numbers(spark, path)):
        new = sum(v.folders[f] for f in v.added)
        rows.append((v.number, v.kind, v.batch, len(v.added), new, len(v.folders) - len(v.added), sum(v.folders.values()) - new))
    return spark.createDataFrame(rows, "version long, kind string, batch long, folders_written long, files_written long, folders_carried long, files_carried long")


def vacuum(spark: SparkSession, path: str, keep: int = 10, older_hours: float = 24.0) -> list[str]:
    """Remove versions beyond the newest ``keep``, and folders that no kept version names: those of crashed writers too.

    Only what is older than ``older_hours`` goes, so that running readers and writers keep their files. Returns what was removed.
    """
    folder, fs = _fs(spark, f"{path}/_versions")
    now = spark._jvm.java.lang.System.currentTimeMillis()
    old = lambda p: now - fs.getFileStatus(p).getModificationTime() >= older_hours * 3_600_000
    known = [version(spark, path, n) for n in numbers(spark, path)]
    removed: list[str] = []
    kept = []
    for v in known:
        place, _ = _fs(spark, f"{path}/_versions/{v.number}")
        if v in known[-max(1, keep) :] or not old(place):
            kept.append(v)
        else:
            fs.delete(place, False)
            removed.append(f"_versions/{v.number}")
    named, feeds = {f for v in kept for f in v.folders}, {v.feed for v in kept}
    roots = {f.partition("/")[0] for f in named}
    loose = {f for v in known if v not in kept for f in v.folders} - named
    for part, live in (("data", lambda n: n in roots), ("feed", lambda n: n.partition("=")[2] in feeds)):
        place, _ = _fs(spark, f"{path}/{part}")
        for status in fs.listStatus(place) if fs.exists(place) else []:
            name = status.getPath().getName()
            if not live(name) and old(status.getPath()):
                fs.delete(status.getPath(), True)
                removed.append(f"{part}/{name}")
    for f in sorted(loose):
        place, _ = _fs(spark, f"{path}/data/{f}")
        if fs.exists(place) and old(place):
            fs.delete(place, True)
            removed.append(f"data/{f}")
    for status in fs.listStatus(folder) if fs.exists(folder) else []:
        if status.getPath().getName().startswith(".") and not status.getPath().getName().endswith(".crc") and old(status.getPath()):
            fs.delete(status.getPath(), False)
    return removed
