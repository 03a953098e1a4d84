"""MinHash near-dedup (operator 1).

A document's set holds the hashes of its distinct shingles. Documents with equal sets form a class, of which
the smallest key stands for all. One-permutation hashing cuts the hash range into bins and keeps each
bin's smallest value; empty bins borrow from a full one that a hash chooses (optimal densification). Runs
of bins make the bands; classes that share a band meet in a bucket.

The members of a bucket of up to ``ALL_PAIRS`` are all compared with each other. In a larger one, whose pairs
would grow with its square, each is compared with the bucket's hub, the member that shares most buckets
with most others: star-shaped edges. Where that leaves a bucket with several components, the members
outside its commonest one are compared with all members of other components. All comparisons are of full
sets, so no link between two members of a bucket is lost, and pairs that the components already join are
never looked at.

Comparisons are made in blocks of a bounded number of bytes: a bucket of any size is dealt out over as many
groups as it takes, and only links leave a group, never its pairs.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, fresh, quoted, stored, with_python_columns
from quern.llm.words import Hashes, mixed

#: Bands and bins in each. At a similarity of 0.8 a pair misses all 32 bands of 5 with probability 3e-6.
BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
#: Members of a bucket up to which all pairs are compared.
ALL_PAIRS = 12
#: Entries of sets (of 8 bytes) in a block of members, and in one of those that each member is compared with.
BLOCK, OUTSIDE_BLOCK = 1 << 19, 1 << 17
#: Parts into which the rows of a node or class are dealt for joins.
SALTS = 8
#: A list of candidates' keys that is broadcast to a scan has no more entries than this.
BROADCAST_KEYS = 1_000_000


def shingles(text: str | None, hashes: Hashes, size: int = 2) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text; a text of fewer words is one shingle, one without words none."""
    words = hashes.of(text)
    if not len(words):
        return words
    n = max(1, len(words) - size + 1)
    made = words[:n]
    for k in range(1, min(size, len(words))):
        made = mixed(made, words[k : k + n])
    return np.unique(made)


@lru_cache(maxsize=64)
def probes(turn: int) -> np.ndarray:
    """The bins that each bin asks in turns 64*turn to 64*turn+63, by a hash of bin and turn."""
    bins = np.arange(BINS, dtype=np.uint64)[:, None]
    tries = np.arange(64 * turn, 64 * turn + 64, dtype=np.uint64)[None, :]
    return (mixed(bins + np.uint64(1), tries + np.uint64(1)) % np.uint64(BINS)).astype(np.int64)


BOUNDS = np.array([(i << 64) // BINS for i in range(BINS)], dtype=np.uint64)


def signature(sets: np.ndarray) -> np.ndarray:
    """One-permutation MinHash of a set that isn't empty, densified."""
    first = np.searchsorted(sets, BOUNDS)
    last = np.concatenate((first[1:], [len(sets)]))
    full = first < last
    source = np.arange(BINS)
    empty = np.flatnonzero(~full)
    if full.sum() == 1:
        source[:] = np.flatnonzero(full)[0]
        empty = empty[:0]
    turn = 0
    while len(empty):
        asked = probes(turn)[empty]
        hit = full[asked]
        done = hit.any(axis=1)
        source[empty[done]] = asked[done, hit[done].argmax(axis=1)]
        empty, turn = empty[~done], turn + 1
    return sets[first[source]]


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of a signature."""
    rows = values.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = mixed(key, rows[:, k])
    return key


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """(key, text) to (key, n, same, bands): set size, a 128-bit hash of the set, and band keys (none for an empty set)."""

    def make() -> Callable:
        hashes = Hashes()

        def step(columns):
            sets = [shingles(t, hashes, size) for t in columns[0].to_pylist()]
            keys = [band_keys(signature(s)).view(np.int64) if len(s) else np.zeros(0, dtype=np.int64) for s in sets]
            offsets = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys) if keys else np.zeros(0, dtype=np.int64)))
            digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            return pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), lists

        return step

    fields = [T.StructField("n", T.LongType()), T.StructField("same", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))]
    return with_python_columns(docs, ["text"], fields, make, drop=("text",))


def with_sets(docs: DataFrame, size: int) -> DataFrame:
    """(key, text) to (key, sets): the full set, packed."""

    def make() -> Callable:
        hashes = Hashes()
        return lambda columns: [pa.array([shingles(t, hashes, size).tobytes() for t in columns[0].to_pylist()], pa.binary())]

    made = with_python_columns(docs, ["text"], [T.StructField("sets", T.BinaryType())], make, drop=("text",))
    return made.where(F.octet_length("sets") > 0)


def alike(one: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which of the sets are at least ``percent`` like the one; all are sorted."""
    flat, sizes = np.concatenate(sets), np.array([len(s) for s in sets])
    place = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    common = np.add.reduceat(one[place] == flat, np.cumsum(sizes) - sizes, dtype=np.int64)
    return 100 * common >= percent * (sizes + len(one) - common)


class Block:
    """Some sets, and many others to compare them with one by one, as places in what they hold in common."""

    def __init__(self, rows: pa.Table, others: pa.Table) -> None:
        packed = [*rows.column("sets").to_pylist(), *others.column("sets").to_pylist()]
        sets = [np.frombuffer(x, dtype=np.uint64) for x in packed]
        self.vocabulary, places = np.unique(np.concatenate(sets), return_inverse=True)
        cut = np.cumsum([0, *map(len, sets)])
        n = rows.num_rows
        self.sizes, self.starts, self.entries = np.diff(cut[: n + 1]), cut[:n], places[: cut[n]]
        self.others = [places[i:j] for i, j in zip(cut[n:], cut[n + 1 :], strict=False)]
        self.flags = np.zeros(len(self.vocabulary), dtype=np.uint8)

    def linked(self, k: int, percent: int) -> np.ndarray:
        """Which of the block's sets are at least ``percent`` like the k-th other one."""
        own = self.others[k]
        self.flags[own] = 1
        common = np.add.reduceat(self.flags[self.entries], self.starts, dtype=np.int64)
        self.flags[own] = 0
        return 100 * common >= percent * (self.sizes + len(own) - common)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among pairs (hub, member, parts, n) by their full sets.

    ``parts``: into how many the members of the hub's largest bucket are dealt; ``n``: the member's set size.
    """
    total = pairs.agg(F.sum("n")).first()[0] or 0
    groups = max(1, -(-total // BLOCK))
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("member"), F.col("parts")))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("hub", "part"), F.lit(groups)))
    # a hub stands among its members, so that one join brings all sets
    rows = dealt.select("block", "hub", F.col("member").alias("key")).union(dealt.select("block", "hub", "hub").distinct()).join(sets, "key")

    def compare(t: pa.Table) -> pa.Table:
        t = t.select(["hub", "key", "sets"]).sort_by("hub")
        owners, keys = t.column("hub").to_numpy(), t.column("key").to_numpy()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in t.column("sets").to_pylist()]
        hub, member = [], []
        for at in np.flatnonzero(keys == owners).tolist():
            i, j = np.searchsorted(owners, [keys[at], keys[at] + 1])
            near = keys[i:j][alike(sets[at], sets[i:j], percent)]
            hub.append(np.full(len(near), keys[at]))
            member.append(near)
        ends = [np.concatenate(x).astype(np.int64) if x else np.zeros(0, dtype=np.int64) for x in (hub, member)]
        return pa.table({"a": ends[0], "b": ends[1]})

    return rows.groupBy("block").applyInArrow(compare, "a long, b long").where("a <> b").distinct()


def smallest(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that the links (a, b) reach from each.

    Alternates large-star and small-star steps: each node's larger, then smaller, neighbours are hung
    onto its smallest one, until nothing changes. Every step is an aggregation per node, stored. The
    neighbours of a node are dealt out by a salt, so that one of many neighbours is not one task's.
    """

    def state(edges: DataFrame):
        return edges.select(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()

    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    before = state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
        large = both.join(smallest(both).select("u", "m", salts), ["u", "salt"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.union(edges.groupBy("u").agg(F.min("v").alias("v"))).where("u <> v").distinct()
        ends = lambda x, y: F.struct(x.alias("u"), y.alias("v"))
        hung = large.join(smallest(large), "u").select(F.explode(F.array(ends(F.col("u"), F.col("m")), ends(F.col("v"), F.col("m")))).alias("e")).select("e.*").where("u <> v").distinct()
        new = stored(hung, "stars")
        discard(edges)
        edges, last, before = new, before, state(new)
        if before == last:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select(F.col("v"), F.col("v")).distinct())


def alike_in_size(x: str, y: str, percent: int) -> Column:
    """Whether sets of sizes x and y can be ``percent`` alike at all."""
    return F.least(x, y) * 100 >= F.greatest(x, y) * percent


def candidates(met: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (hub, member, parts, n) among members (bucket, key, n, size, mass) of buckets of two and more."""
    few = met.where(F.col("size") <= ALL_PAIRS).select("bucket", "key", "n")
    small = few.join(few.select("bucket", F.col("key").alias("member"), F.col("n").alias("its")), "bucket").where(F.col("key") < F.col("member"))
    small = small.where(alike_in_size("n", "its", percent)).select(F.col("key").alias("hub"), "member", F.lit(1).alias("parts"), F.col("its").alias("n"))
    many = met.where(F.col("size") > ALL_PAIRS)
    weight = many.groupBy("key").agg(F.sum("size").alias("weight"))
    weighed = stored(many.join(weight, "key"), "weighed")
    top = weighed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("key")).alias("minus"), F.col("n").alias("n"))).alias("top"))
    hubs = stored(top.select("bucket", (-F.col("top.minus")).alias("hub"), F.col("top.n").alias("its")), "hubs")
    stars = weighed.join(hubs, "bucket").where("key <> hub").where(alike_in_size("n", "its", percent))
    stars = stars.select("hub", F.col("key").alias("member"), F.ceil(F.col("mass") / BLOCK).cast("int").alias("parts"), "n")
    return small.union(stars).groupBy("hub", "member").agg(F.max("parts").alias("parts"), F.max("n").alias("n"))


def apart(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members (bucket, key, n) of buckets of several components, with ``label``, the bucket's commonest component
    ``main`` and whether they stand ``out`` of it."""
    labels = found.select(F.col("node").alias("key"), "label")
    named = stored(members.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key")), "named")
    per = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("share"))
    main = per.groupBy("bucket").agg(F.max(F.struct("share", "label")).alias("top"), F.count(F.lit(1)).alias("labels")).where("labels > 1")
    several = named.join(stored(main.select("bucket", F.col("top.label").alias("main")), "mains"), "bucket")
    return stored(several.withColumn("out", F.col("label") != F.col("main")), "apart")


def further(several: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of different components in the buckets that ``apart`` gives, one for each member outside and other component.

    Members outside a bucket's commonest component are compared with all members of that component which
    stand in such buckets (group 0: once for a component, however many buckets they share), and with each
    other (group 1: in each bucket).
    """
    out = several.where("out")
    mixed_out = out.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y").select("bucket")
    among = out.join(mixed_out, "bucket").select(F.lit(1).alias("kind"), F.col("bucket").alias("group"), "key", "n", "label")
    inner = several.where("not out").select(F.lit(0).alias("kind"), F.col("label").alias("group"), "key", "n", "label").distinct()
    outer = out.select(F.lit(0).alias("kind"), F.col("main").alias("group"), "key", "n", "label").distinct()
    right, left = stored(inner.union(among), "inside"), stored(outer.union(among), "outside")
    mass = lambda df, size: df.groupBy("kind", "group").agg(F.ceil(F.sum("n") / size).cast("int").alias("parts"))
    sizes = stored(mass(right, BLOCK).join(mass(left, OUTSIDE_BLOCK).withColumnRenamed("parts", "out_parts"), ["kind", "group"]), "sizes")
    part = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    groups = ["kind", "group", "part", "turn"]
    right = right.join(sizes, ["kind", "group"]).select("kind", "group", part("parts").alias("part"), every("out_parts").alias("turn"), "key", "label", F.lit(False).alias("asks"))
    left = left.join(sizes, ["kind", "group"]).select("kind", "group", every("parts").alias("part"), part("out_parts").alias("turn"), "key", "label", F.lit(True).alias("asks"))

    def compare(t: pa.Table) -> pa.Table:
        asks = t.column("asks")
        left, right = t.filter(asks), t.filter(pc.invert(asks))
        a, b = [], []
        if left.num_rows and right.num_rows:
            block = Block(right, left)
            keys, labels = right.column("key").to_numpy(), right.column("label").to_numpy()
            for k, (key, label) in enumerate(zip(left.column("key").to_pylist(), left.column("label").to_pylist(), strict=True)):
                near = np.flatnonzero(block.linked(k, percent) & (labels != label))
                near = near[np.unique(labels[near], return_index=True)[1]]
                a += [key] * len(near)
                b += keys[near].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return left.union(right).join(sets, "key").groupBy(*groups).applyInArrow(compare, "a long, b long").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2, percent: int = 80) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of ``df``.

    Words are runs of bytes without ASCII white space, A-Z lower-cased; a set holds the distinct shingles of
    ``size`` words, or the whole sequence of a shorter text. Documents are linked from ``percent`` of
    similarity (intersection by union) on; ``component_id`` is the smallest key reachable, ``kept``
    whether that is the row's own. Null, empty and word-free texts have n_shingles 0, link with
    nothing and are their own component. Rows that repeat a key with other texts link the classes of all of them; a
    row with a null key stands alone, its component null, kept. Whole texts are read, however long. Other columns
    are not returned, whatever their names; an empty table gives an empty one.
    """
    docs = df.select(F.col(quoted(key)).cast("long").alias("key"), F.col(quoted(text)).alias("text"))
    sketches = stored(sketched(docs, size), "sketches")
    full = sketches.where("n > 0 and key is not null")
    # equal sets have equal sizes and bands
    heads = stored(full.groupBy("same").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "heads")
    rows = heads.select("key", "n", F.explode("bands").alias("bucket"))
    shared = stored(rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("mass")).where("size > 1"), "shared")
    met = stored(rows.join(shared, "bucket"), "met")
    discard(shared)
    pairs = stored(candidates(met, percent), "pairs")
    members = met.where(F.col("size") > ALL_PAIRS).select("bucket", "key", "n")
    wanted = pairs.select(F.explode(F.array("hub", "member")).alias("key")).union(members.select("key")).distinct()
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    sets = with_sets(docs.join(wanted, "key", "left_semi"), size)
    # only where rows repeat must whole sets be made distinct
    sets = stored(sets if full.groupBy("key", "same").count().where("count > 1").isEmpty() else sets.distinct(), "sets")
    links = stored(confirmed(pairs, sets, percent).union(_repeated(sketches, heads)), "links")
    discard(pairs)
    found = components(links)
    discard(links)
    if not members.isEmpty():
        several = apart(members, found)
        more = stored(further(several, sets, percent), "more")
        if not more.isEmpty():
            found, before = components(more.union(found.select(F.col("node").alias("a"), F.col("label").alias("b")))), found
            discard(before)
        discard(several, more)
    discard(met, sets)
    return _labelled(sketches, heads, found, key)


def _repeated(sketches: DataFrame, heads: DataFrame) -> DataFrame:
    """Links between the classes of keys that stand with several texts."""
    full = sketches.where("n > 0 and key is not null").select("key", "same")
    several = full.groupBy("key").agg(F.min("same").alias("x"), F.max("same").alias("y")).where("x <> y").select("key")
    classes = full.join(several, "key").distinct().join(heads.select("same", F.col("key").alias("head")), "same")
    return classes.select(F.col("key").alias("a"), F.col("head").alias("b")).where("a <> b")


def _labelled(sketches: DataFrame, heads: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Each row with its class's component. Only classes of several rows or with links are joined, dealt by a salt."""
    salts = F.explode(F.array(*map(F.lit, range(SALTS)))).alias("salt")
    labels = heads.select("same", "copies", F.col("key").alias("node")).join(found, "node", "left")
    classes = labels.where("copies > 1 or label is not null").select("same", F.coalesce("label", "node").alias("label"), salts)
    rows = sketches.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int")).drop("bands")
    told = F.col("key").isNotNull() & (F.col("n") > 0)
    component = F.when(told, F.coalesce("label", "key")).otherwise(F.col("key"))
    kept: Column = F.coalesce(component == F.col("key"), F.lit(True))
    out = rows.join(classes, ["same", "salt"], "left")
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), kept.alias("kept"))


def deduplicated(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``df`` that ``near_duplicates`` keeps, with all their columns, whatever these are called.

    Rows that repeat a key count as one document: of them the one with the smallest text stays (a null one
    before all; among equal texts the rest of the row decides). Null, empty and word-free texts, and rows
    without a key, all stay. An empty table gives an empty one.
    """
    name, rank = fresh(df, "key"), fresh(df, "rank")
    found = stored(near_duplicates(df.select(key, text), key, text, size, percent), "found").withColumnRenamed(key, name)
    gone, again = found.where("not kept").select(name).distinct(), found.where(F.col(name).isNotNull()).groupBy(name).count().where("count > 1").select(name)
    gone, again = ((F.broadcast(x) if x.count() <= BROADCAST_KEYS else x) for x in (gone, again))
    own = F.col(quoted(key)).cast("long") == F.col(name)
    rows = df.join(gone, own, "left_anti")
    if again.isEmpty():
        return rows
    order = Window.partitionBy(F.col(quoted(key))).orderBy(F.col(quoted(text)), F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])))
    repeated = rows.join(again, own, "left_semi").withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)
    return rows.join(again, own, "left_anti").union(repeated)
