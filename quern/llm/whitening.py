"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation (operator 11).

Entries are quantised to whole numbers, so that equal vectors are equal and sums are exact. Each distinct vector
counts once in the fit. With X the centred distinct rows, the bidiagonalisation X V = U B alternates the products
X v and X' u over blocks of rows; the singular vectors of the small B, turned by V, are the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, quoted, small_batches, slices, stored

#: Steps of a unit, and what is added to each quantised entry.
STEPS, OFFSET = 64, 1_000_000
#: Entries from this size on would leave a long when quantised; vectors with one take no part.
LARGEST = 2.0**56
#: Bytes of packed vectors in a block.
BLOCK = 2 << 20
#: Widths of packed entries; the smallest that holds a vector is used, so that equal vectors have equal bytes.
WIDTHS = [np.int8, np.int16, np.int32, np.int64]
#: Singular values below this share of the largest count as zero.
LEAST = 1e-9
#: A product below this share of the largest ends a Krylov space.
SPENT = 1e-11


def quantised(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of rows, their entries as longs less ``OFFSET``) for each length of the usable vectors of a batch."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    entries = pc.fill_null(column.flatten().cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == length)
        values = entries[starts[rows][:, None] + np.arange(length)]
        with np.errstate(invalid="ignore"):
            usable = (np.abs(values) < LARGEST).all(axis=1)  # false for NaN
        if usable.any():
            yield rows[usable], np.floor(STEPS * values[usable]).astype(np.int64)


def packed(entries: np.ndarray) -> list[bytes]:
    """Each vector as bytes: its width, then its entries in the smallest width that holds them."""
    most = np.maximum(entries.max(axis=1), -1 - entries.min(axis=1))
    width = np.searchsorted([np.iinfo(w).max for w in WIDTHS], most)
    out: list[bytes] = [b""] * len(entries)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        for i, line in zip(rows, entries[rows].astype(WIDTHS[w])):
            out[i] = bytes([w]) + line.tobytes()
    return out


def distinct_blocks(df: DataFrame, vector: str) -> DataFrame:
    """The distinct usable vectors as blocks (length long, vectors long, entries binary), stored."""
    small_batches(df.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                for _, entries in quantised(part.column(0)):
                    yield pa.RecordBatch.from_arrays([pa.array(packed(entries), pa.binary())], names=["packed"])

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[np.ndarray]] = {}
        held: dict[int, int] = {}

        def out(length: int) -> pa.RecordBatch:
            rows = np.stack(waiting.pop(length))
            most = np.maximum(rows.max(), -1 - rows.min())
            width = int(np.searchsorted([np.iinfo(w).max for w in WIDTHS], most))
            held[length] = 0
            columns = [pa.array([length]), pa.array([len(rows)]), pa.array([bytes([width]) + rows.astype(WIDTHS[width]).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, names=["length", "vectors", "entries"])

        for batch in batches:
            for value in batch.column(0):
                line = value.as_buffer()
                row = np.frombuffer(line, WIDTHS[line[0][0] if isinstance(line[0], bytes) else line[0]], offset=1)
                waiting.setdefault(len(row), []).append(row.astype(np.int64))
                held[len(row)] = held.get(len(row), 0) + len(row) * 8
                if held[len(row)] >= BLOCK:
                    yield out(len(row))
        for length in list(waiting):
            yield out(length)

    keys = df.select(F.col(quoted(vector)).alias("v")).mapInArrow(pack, "packed binary").distinct()
    return stored(keys.mapInArrow(block, "length long, vectors long, entries binary"), "vectors")


def unpacked(entries: bytes, length: int) -> np.ndarray:
    return np.frombuffer(entries, WIDTHS[entries[0]], offset=1).reshape(-1, length).astype(np.int64)


def differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: as longs where they fit, else as Python's whole numbers."""
    most = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    if most < 1 << 61:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squared(d: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, exact; None where a long can't hold it."""
    if d.dtype != object and d.shape[1] * float(np.abs(d).max(initial=0)) ** 2 < 2.0**62:
        return (d * d).sum(axis=1).tolist()
    sums = (d.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in sums]


def summed(blocks: DataFrame, length: int, each: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of ``each(block)``, an array of doubles of one shape; a task sends one such array to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for entries in batch.column(0):
                one = each(unpacked(entries.as_py(), length))
                total = one if total is None else total + one
        if total is not None:
            columns = [pa.array([TaskContext.get().partitionId()]), pa.array([total.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "total"])

    rows = sorted(blocks.select("entries").mapInArrow(run, "part long, total binary").collect())  # always added in one order
    return np.sum([np.frombuffer(r.total) for r in rows], axis=0)


def total_entries(blocks: DataFrame, length: int) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * length
        for batch in batches:
            for entries in batch.column(0):
                x = unpacked(entries.as_py(), length)
                fits = int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
                total = [a + int(b) for a, b in zip(total, x.sum(axis=0) if fits else x.astype(object).sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array([[str(t) for t in total]], pa.list_(pa.string()))], names=["total"])

    parts = blocks.select("entries").mapInArrow(run, "total array<string>").collect()
    return [sum(int(p.total[i]) for p in parts) for i in range(length)]


def bidiagonal(product: Callable[[np.ndarray], tuple[float, np.ndarray]], length: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(V, B) with X V = U B, by Golub-Kahan-Lanczos with full reorthogonalisation.

    ``product(w)`` gives |Xw|^2 and X'(Xw): one pass over the rows makes the left vector and the next right one. A
    left vector is kept as w with u = X w, so that it is never stored: inner products of left vectors are those of w
    with X'(X w), and each new one is freed from all before it. A spent Krylov space (equal singular values, fewer
    dimensions than columns) is left for a fresh direction at right angles to all before it.
    """
    rng = np.random.default_rng(seed)
    right, left, images = np.zeros((length, 0)), np.zeros((length, 0)), np.zeros((length, 0))
    alphas: list[float] = []
    betas: list[float] = []
    largest = 0.0

    def fresh() -> np.ndarray:
        v = rng.normal(size=length)
        for _ in range(3):
            v -= right @ (right.T @ v)
            v /= np.linalg.norm(v)
        return v

    def freed(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """(norm, w, X'Xw) of a left vector without its parts along those before; run twice if much was taken."""
        for _ in range(3):
            before = w
            norm, image = product(w)
            h = left.T @ image
            w, image, rest = w - left @ h, image - images @ h, norm - h @ h
            if rest > 0.5 * norm or norm <= (SPENT * largest) ** 2:
                break
        return (max(rest, 0.0) ** 0.5 if before is not w else norm**0.5), w, image

    v, beta, w = fresh(), 0.0, np.zeros(length)
    while True:
        right = np.column_stack([right, v])
        alpha, u, image = freed(v - beta * w)
        largest = max(largest, alpha)
        if alpha <= SPENT * largest:  # X v lies among the left vectors: another direction gives the next one
            scale, alpha = 0.0, 0.0
            if right.shape[1] < length:
                scale, u, image = freed(fresh())
                largest = max(largest, scale)
            if scale <= SPENT * largest:
                alphas.append(0.0)
                break
        else:
            scale = alpha
        alphas.append(alpha)
        w, image = u / scale, image / scale
        left, images = np.column_stack([left, w]), np.column_stack([images, image])
        if right.shape[1] == length:
            break
        v = image
        for _ in range(2):
            v = v - right @ (right.T @ v)
        beta = float(np.linalg.norm(v))
        largest = max(largest, beta)
        if beta <= SPENT * largest:
            beta, v = 0.0, fresh()
        else:
            v = v / beta
            v -= right @ (right.T @ v)
            v /= np.linalg.norm(v)
        betas.append(beta)
    return right, np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)


@dataclass
class Whitening:
    """What maps vectors of ``length``: n and S of the fit list (S of entries less ``OFFSET``), components as rows, their eigenvalues."""

    length: int
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def fit(df: DataFrame, vector: str, most: int = 16) -> Whitening | None:
    """The whitening of all usable vectors; None where there is none.

    Each distinct quantised vector counts once. Fitted is the commonest length of these (the shorter of equals).
    The driver gets, from each task of a pass, one vector of that length; there are as many passes as dimensions
    and four more.
    """
    every = distinct_blocks(df, vector)
    lengths = every.groupBy("length").agg(F.sum("vectors").alias("n")).orderBy(F.desc("n"), "length").first()
    if lengths is None:
        discard(every)
        return None
    length, n = lengths
    blocks = every.where(F.col("length") == length)
    sums = total_entries(blocks, length)
    trace = float(summed(blocks, length, lambda x: np.array([float(((differences(x, n, sums).astype(float) / n) ** 2).sum())]))[0]) / n
    components, eigenvalues, error = np.zeros((0, length)), np.zeros(0), 0.0
    if trace > 0:

        def product(w: np.ndarray) -> tuple[float, np.ndarray]:
            def each(x: np.ndarray) -> np.ndarray:
                centred = differences(x, n, sums).astype(float) / n
                y = centred @ w
                return np.concatenate([[y @ y], centred.T @ y])

            out = summed(blocks, length, each)
            return float(out[0]), out[1:]

        right, small = bidiagonal(product, length)
        _, values, turned = np.linalg.svd(small)
        kept = [i for i in range(min(most, len(values))) if values[i] > LEAST * values[0]]
        components = (right @ turned.T).T[kept]
        components *= np.where(np.take_along_axis(components, np.abs(components).argmax(axis=1)[:, None], axis=1) < 0, -1.0, 1.0)
        eigenvalues = values[kept] ** 2 / n
        error = identity_error(blocks, length, n, sums, components, eigenvalues)
    discard(every)
    return Whitening(length, n, sums, components, eigenvalues, trace, error)


def identity_error(blocks: DataFrame, length: int, n: int, sums: list[int], components: np.ndarray, eigenvalues: np.ndarray) -> float:
    """The largest absolute entry of the whitened fit list's covariance less the identity."""
    k, scaled = len(components), components / np.sqrt(eigenvalues)[:, None]

    def each(x: np.ndarray) -> np.ndarray:
        y = (differences(x, n, sums).astype(float) / n) @ scaled.T
        return np.concatenate([y.sum(axis=0), (y.T @ y).ravel()])

    out = summed(blocks, length, each) / n
    mean, second = out[:k], out[k:].reshape(k, k)
    return float(np.abs(second - np.outer(mean, mean) - np.eye(k)).max())


def whitened(df: DataFrame, vector: str, key: str, most: int = 16, model: Whitening | None = None) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component.

    Left out are vectors that are null or empty, hold null, NaN or infinite entries or entries of 2^56 and more, or
    are of another length than the fit list. Rows that repeat (also with null or equal keys) are each given back. Directions
    without variance are no components, so equal vectors, a single one, or an empty table give no rows. ``deviation``
    is null where a long can't hold it. Other columns of ``df`` are not read. Components are ordered by falling
    eigenvalue; their largest entry is positive.
    """
    model = model or fit(df, vector, most)
    kind = df.schema[key].dataType
    schema = T.StructType(
        [T.StructField(key, kind), T.StructField("component", T.IntegerType()), *[T.StructField(c, T.LongType()) for c in ("n", "deviation")], *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]]
    )
    if model is None or not len(model.components):
        return df.sparkSession.createDataFrame([], schema)
    m, k = model, len(model.components)
    scaled = (m.components / np.sqrt(m.eigenvalues)[:, None]).T
    explained = m.eigenvalues / m.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1 << 20):
                for rows, x in quantised(part.column(1)):
                    if x.shape[1] != m.length:
                        continue
                    d = differences(x, m.n, m.sums)
                    size = len(x)
                    columns = [
                        part.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)), pa.array(np.full(size * k, m.n)),
                        pa.array(squared(d), pa.int64()).take(pa.array(np.repeat(np.arange(size), k))), pa.array(((d.astype(float) / m.n) @ scaled).ravel()),
                        pa.array(np.tile(explained, size)), pa.array(np.full(size * k, m.identity_error)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    small_batches(df.sparkSession)
    return df.select(F.col(quoted(key)).alias("k"), F.col(quoted(vector)).alias("v")).mapInArrow(run, schema)
