"""Approximate nearest neighbours over balanced posting lists (operator 2).

Balanced clustering of a bounded sample gives the centroids. Every vector goes to the list of its nearest
centroid; a vector at a boundary also to lists whose centroids are nearly as near, unless such a
centroid is nearer to one already chosen than to the vector. Nearest centroids are found by best-first
search in a neighbour graph held in memory. A query reads the lists whose centroids are within a ratio of
the nearest one's distance, however many these are. Distances are exact, in double precision, on the
original vectors.

Lists are dealt into groups of a bounded number of rows, long lists over several; the queries of a group
are dealt out as well. A query goes to a group once, with all lists that it reads there.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, quoted, sampled, stored, with_python_columns

#: Vectors of the sample that the index is fitted on, vectors of the table for each list aimed at, and of the
#: sample for each list at least; so there are 5,000 lists at most, and the graph has a bounded size.
SAMPLE, LIST_ROWS, LEAST_SAMPLE = 20_000, 128, 4
#: About the rows, and the queries, that one group compares.
PART_ROWS, QUERY_ROWS = 4_096, 4_096
#: Queries compared with a group's rows at once, and rows that search the graph at once.
BLOCK = 512


def usable(vector: str) -> Column:
    """Whether a vector has numbers only, not all of them zero."""
    v = F.col(quoted(vector))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def halves(x: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Which points go to the second of two clusters, each of at least a third of them."""
    a, b = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(8):
        side = x @ (b - a) - (b @ b - a @ a) / 2
        cut = np.clip(0.0, *np.quantile(side, (1 / 3, 2 / 3)))
        second = side > cut
        if not second.any() or second.all():
            second = np.arange(len(x)) >= len(x) // 2
        a, b = x[~second].mean(axis=0), x[second].mean(axis=0)
    return second


def balanced(x: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """About ``n`` centroids of clusters of like size: the largest is halved until there are enough."""
    rng = np.random.default_rng(seed)
    parts = [np.unique(x, axis=0)]
    while len(parts) < n:
        largest = max(range(len(parts)), key=lambda i: len(parts[i]))
        if len(parts[largest]) < 2:
            break
        points = parts.pop(largest)
        second = halves(points, rng)
        parts += [points[~second], points[second]]
    return np.stack([p.mean(axis=0) for p in parts])


class Graph:
    """Centroids, each joined to its nearest and to some that a hash chooses."""

    def __init__(self, centroids: np.ndarray, degree: int = 24) -> None:
        self.centroids = centroids
        n = len(centroids)
        near = np.empty((n, min(degree, n)), dtype=np.int64)
        for at in range(0, n, 256):
            d = ((centroids[at : at + 256, None, :] - centroids[None, :, :]) ** 2).sum(axis=2) if n <= 512 else self._squares(centroids[at : at + 256])
            near[at : at + 256] = np.argsort(d, axis=1, kind="stable")[:, : near.shape[1]]
        far = np.random.default_rng(1).integers(0, n, (n, 4))
        self.next = np.concatenate([near, far], axis=1)
        self.entries = np.linspace(0, n - 1, min(n, 16)).astype(np.int64)

    def _squares(self, x: np.ndarray) -> np.ndarray:
        return (x**2).sum(axis=1)[:, None] - 2 * x @ self.centroids.T + (self.centroids**2).sum(axis=1)[None, :]

    def nearest(self, x: np.ndarray, width: int, ratio: float = 1.0) -> np.ndarray:
        """Distances of the rows of ``x`` to all centroids that the search has met, infinite for the others.

        All rows search at once; each goes on while it knows of an unvisited centroid among its ``width``
        nearest or within ``ratio`` of the nearest one's distance.
        """
        n, k = len(x), len(self.centroids)
        x, centroids = x.astype(np.float64), self.centroids
        width, each = min(width, k), min(4, k)
        dist, visited = np.full((n, k), np.inf), np.zeros((n, k), dtype=bool)
        dist[:, self.entries] = np.sqrt(((x[:, None, :] - centroids[self.entries]) ** 2).sum(axis=2))
        busy = np.arange(n)
        while len(busy):
            own = dist[busy]
            bound = np.maximum(np.partition(own, width - 1, axis=1)[:, width - 1], ratio * own.min(axis=1))
            open_ = np.where(visited[busy] | (own > bound[:, None]), np.inf, own)
            first = np.argpartition(open_, each - 1, axis=1)[:, :each]
            row, col = np.nonzero(np.isfinite(np.take_along_axis(open_, first, axis=1)))
            node = first[row, col]
            visited[busy[row], node] = True
            new = np.zeros((len(busy), k), dtype=bool)
            new[row[:, None], self.next[node]] = True
            r, c = np.nonzero(new & np.isinf(own))
            for at in range(0, len(r), 1 << 15):
                i, j = busy[r[at : at + (1 << 15)]], c[at : at + (1 << 15)]
                dist[i, j] = np.sqrt(((x[i] - centroids[j]) ** 2).sum(axis=1))
            busy = busy[np.unique(row)]
        return dist

    def lists_of(self, x: np.ndarray, ratio: float, copies: int) -> list[list[int]]:
        """The lists that each vector goes to."""
        dist = self.nearest(x, 2 * copies)
        order = np.argsort(dist, axis=1, kind="stable")[:, : 2 * copies]
        out = []
        for own, d in zip(order, np.take_along_axis(dist, order, axis=1), strict=True):
            chosen: list[int] = []
            for c, r in zip(own.tolist(), d.tolist(), strict=True):
                if not r <= ratio * d[0] + 1e-12 or len(chosen) >= copies:
                    break
                if all(((self.centroids[c] - self.centroids[k]) ** 2).sum() > r * r for k in chosen):
                    chosen.append(c)
            out.append(chosen)
        return out

    def lists_for(self, x: np.ndarray, ratio: float, least: int) -> list[list[int]]:
        """The lists that each query reads: within ``ratio`` of the nearest centroid's distance, ``least`` at least."""
        dist = self.nearest(x, least, ratio)
        least = min(least, dist.shape[1])
        bound = np.maximum(np.partition(dist, least - 1, axis=1)[:, least - 1], ratio * dist.min(axis=1))
        return [np.flatnonzero(np.isfinite(d) & (d <= b)).tolist() for d, b in zip(dist, bound, strict=True)]


def compared(queries: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, distance) of each query's k nearest of some rows, without its own; ties go to the smaller id.

    Products of matrices tell which rows can be among the k, with room for their rounding; only these
    rows' distances are computed, as sums of squared differences.
    """
    found = []
    with np.errstate(all="ignore"):
        norms = (x**2).sum(axis=1)
        for at in range(0, len(queries), BLOCK):
            some, v = queries[at : at + BLOCK], q[at : at + BLOCK]
            own = (v**2).sum(axis=1)[:, None]
            about = own + norms[None, :] - 2 * v @ x.T
            room = 1e-12 * x.shape[1] * (own + norms.max(initial=0))
            itself, whole = some[:, None] == ids[None, :], np.isfinite(about).all(axis=1, keepdims=True)
            about[itself] = np.inf
            bound = np.partition(about, k - 1, axis=1)[:, k - 1 : k] + room if len(ids) > k else np.full((len(some), 1), np.inf)
            row, col = np.nonzero(((about <= bound) | ~whole) & ~itself)  # where squares overflow, every row can be near
            d = np.sqrt(((x[col] - v[row]) ** 2).sum(axis=1))
            order = np.lexsort((ids[col], d, row))
            row, col, d = row[order], col[order], d[order]
            near = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append((some[row[near]], ids[col[near]], d[near]))
    return tuple(np.concatenate(z) for z in zip(*found, strict=True)) if found else (np.zeros(0), np.zeros(0), np.zeros(0))


RESULT = "query_id long, vec_id long, score double"


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def grouped(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query (qid, qv, lists, qgroup, qturn) in each group of rows (id, v, list, group, turn)."""

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            q, x = matrix(left.column("qv")), matrix(right.column("v"))
            asking, ids, own = left.column("qid").to_numpy(), right.column("id").to_numpy(), right.column("list").to_numpy()
            flat = left.column("lists").combine_chunks()
            reader, read = np.repeat(np.arange(left.num_rows), flat.value_lengths().to_numpy()), flat.flatten().to_numpy()
            for name in np.unique(own):
                some, rows = reader[read == name], np.flatnonzero(own == name)
                out.append(compared(asking[some], q[some], ids[rows], x[rows], k))
        a, b, c = (np.concatenate(z) for z in zip(*out, strict=True)) if out else (np.zeros(0),) * 3
        order = np.lexsort((b, c, a))
        order = order[np.concatenate(([True], (np.diff(a[order]) != 0) | (np.diff(b[order]) != 0)))] if len(a) else order
        order = order[np.arange(len(order)) - np.searchsorted(a[order], a[order]) < k]  # the group's k nearest, each once
        a, b, c = a[order], b[order], c[order]
        return pa.table({"query_id": pa.array(a.astype(np.int64)), "vec_id": pa.array(b.astype(np.int64)), "score": pa.array(c.astype(np.float64))})

    return queries.groupBy("qgroup", "qturn").cogroup(rows.groupBy("group", "turn")).applyInArrow(nearest, RESULT)


def exact(queries: DataFrame, rows: DataFrame, k: int, n: int) -> DataFrame:
    """The k nearest of all ``n`` rows, by comparing each of the queries (id, v) with every row, both dealt into blocks."""
    parts, turns = math.ceil(n / PART_ROWS), math.ceil(queries.count() / QUERY_ROWS)
    part = lambda m: F.pmod(F.xxhash64("id"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    asked = queries.select(F.col("id").alias("qid"), F.col("v").alias("qv"), F.array(F.lit(0)).alias("lists"), part(turns).alias("qturn"), every(parts).alias("qgroup"))
    dealt = rows.select("id", "v", F.lit(0).alias("list"), part(parts).alias("group"), every(turns).alias("turn"))
    return ranked(grouped(asked, dealt, k), k)


def spot(key: int, n: int) -> int:
    """One of n places, by a hash of a key."""
    return ((key * 0x9E3779B97F4A7C15) >> 32 & 0xFFFFFFFF) % n


def placed(counts: list[tuple[int, int, int]], most: int) -> dict[int, tuple[int, int, int]]:
    """From (list, rows, queries) of each list its (first group, groups, turns): short lists share a group, long ones get several.

    ``most``: the number of all queries, so that no group counts more.
    """
    place, open_, held, asked, group = {}, [], 0, 0, 0

    def close() -> None:
        nonlocal open_, held, asked, group
        for name in open_:
            place[name] = (group, 1, max(1, math.ceil(min(most, asked) / QUERY_ROWS)))
        group += bool(open_)
        open_, held, asked = [], 0, 0

    for name, rows, queries in sorted(counts):
        if rows > PART_ROWS:
            parts = math.ceil(rows / PART_ROWS)
            close()
            place[name] = (group, parts, max(1, math.ceil(queries / QUERY_ROWS)))
            group += parts
        else:
            if held + rows > PART_ROWS:
                close()
            open_.append(name)
            held, asked = held + rows, asked + queries
    close()
    return place


def vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v) of the rows that take part, each id once."""
    own = df.where(usable(vector) & F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).cast("long").alias("id"), F.col(quoted(vector)).cast("array<double>").alias("v"))
    lengths = own.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(2).collect()
    if len(lengths) > 1:
        own = own.where(F.size("v") == lengths[0]["n"])
    if own.groupBy("id").count().where("count > 1").isEmpty():
        return own
    return own.groupBy("id").agg(F.min("v").alias("v"))


def search(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10, ratio: float = 1.1, copies: int = 4, query_ratio: float = 1.2, least: int = 8) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for each row where ``is_query`` holds.

    ``score`` is the Euclidean distance; candidates are all rows but the query's own, and ties go to the
    smaller id. A query reads all lists within ``query_ratio``, and the ``least`` nearest ones in any case: where
    vectors form clusters these are few, where they have no structure they are most. Null vectors, zero vectors,
    those with null or non-finite components, and those of another length than most take no part, neither do
    rows with a null id. Of rows that repeat an id the one of the smallest vector counts. A query that finds fewer
    than ``k`` in its lists is compared with every row. Other columns are not looked at. ``is_query`` is an
    expression of ``id``. Tables of fewer than two usable rows give an empty one.
    """
    rows = vectors(df, key, vector)
    n = rows.count()
    if n < 2:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = sampled(rows, "id", SAMPLE).select("v").collect()
    if len(sample) < 2:
        sample = rows.limit(2).collect()
    points = np.array([r["v"] for r in sample], dtype=np.float64)
    graph = Graph(balanced(points[np.lexsort(points.T)], max(1, min(math.ceil(n / LIST_ROWS), math.ceil(len(points) / LEAST_SAMPLE)))))
    context = df.sparkSession.sparkContext
    shared = context.broadcast(graph)

    def listed(part: DataFrame, how: str, *limits: float) -> DataFrame:
        def make():
            def step(columns):
                x = matrix(columns[0])
                return [[c for at in range(0, len(x), BLOCK) for c in getattr(shared.value, how)(x[at : at + BLOCK], *limits)]]

            return step

        return with_python_columns(part, ["v"], [T.StructField("lists", T.ArrayType(T.IntegerType()))], make)

    posted = stored(listed(rows, "lists_of", ratio, copies).select("id", "v", F.explode("lists").alias("list")), "postings")
    asked = stored(listed(rows.where(is_query), "lists_for", query_ratio, least), "asked")
    # a row for each list, so at most SAMPLE / LEAST_SAMPLE
    sizes = posted.groupBy("list").count().join(asked.select(F.explode("lists").alias("list")).groupBy("list").agg(F.count(F.lit(1)).alias("asked")), "list", "left").collect()
    place = context.broadcast(placed([(r["list"], r["count"], r["asked"] or 0) for r in sizes], asked.count()))

    def groups_of():
        where = place.value

        def step(columns):
            out = []
            for key, lists in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True):
                own: dict[tuple[int, int], list[int]] = {}
                for name in lists:
                    if name in where:
                        first, parts, turns = where[name]
                        for group in range(first, first + parts):
                            own.setdefault((group, spot(key, turns)), []).append(name)
                out.append([{"qgroup": g, "qturn": t, "lists": names} for (g, t), names in own.items()])
            return [out]

        return step

    def group_of():
        where = place.value
        return lambda columns: [[{"group": where[c][0] + spot(key, where[c][1]), "turns": where[c][2]} for key, c in zip(columns[0].to_pylist(), columns[1].to_pylist(), strict=True)]]

    integer = lambda *names: [T.StructField(x, T.IntegerType()) for x in names]
    wanted = T.ArrayType(T.StructType([*integer("qgroup", "qturn"), T.StructField("lists", T.ArrayType(T.IntegerType()))]))
    spread = with_python_columns(asked, ["id", "lists"], [T.StructField("groups", wanted)], groups_of).select(F.col("id").alias("qid"), F.col("v").alias("qv"), F.explode("groups").alias("g"))
    dealt = with_python_columns(posted, ["id", "list"], [T.StructField("place", T.StructType(integer("group", "turns")))], group_of)
    dealt = dealt.select("id", "v", "list", "place.group", F.explode(F.sequence(F.lit(0), F.col("place.turns") - 1)).alias("turn"))
    first = stored(ranked(grouped(spread.select("qid", "qv", "g.*"), dealt, k), k), "neighbours")
    discard(posted, asked)
    full = first.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1))
    short = rows.where(is_query).join(full, F.col("id") == F.col("query_id"), "left_anti").select("id", "v")
    if short.isEmpty():
        return first
    return first.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(exact(short, rows, k, n))
