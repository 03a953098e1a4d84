"""Language-model scores by deleted interpolation (operator 7).

The model is P(w|v) = l2 c(v,w)/c(v) + l1 c(w)/N + l0/(V+1). The weights depend on the bucket (power of
two) of the context's frequency c(v); expectation-maximisation learns them on a held-out tenth of the
learning documents, whose own counts are taken off the counts first.

Texts go through Spark in chunks of a few megabytes. A chunk's distinct words and pairs, each with its
count, are cut by hash into buckets and shuffled; a bucket adds up the counts of all chunks and answers
each chunk for the keys that it sent, in their order. So a word or pair costs one entry a chunk however
often it occurs, a frequent one is summed before the shuffle, and no table of counts is broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import quoted, slices, stored
from quern.llm.words import Hashes, mixed

#: Bytes of text in a chunk, and about the bytes of all texts for each bucket of counts.
CHUNK_BYTES, BUCKET_BYTES = 4 << 20, 8 << 20
START, END = np.uint64(0x51A2710000000001), np.uint64(0xE2D0000000000001)
#: Steps of the histogram of probabilities, in parts of an octave.
STEPS = 4


def packed(values: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences, byte by byte, compressed."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def packed_counts(values: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def unpacked_counts(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(raw), dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def from_ipc(raw: bytes) -> pa.Table:
    with pa.ipc.open_stream(raw) as r:
        return r.read_all()


class Chunk:
    """Tokens of a chunk's texts as places in its sorted distinct keys; pair keys are odd, word keys even."""

    def __init__(self, texts: list[str | None], hashes: Hashes) -> None:
        docs = [hashes.of(t) for t in texts]
        self.lengths = np.array([len(d) + 1 for d in docs])
        total = int(self.lengths.sum())
        tokens, context = np.full(total, END), np.full(total, START)
        at = 0
        for d in docs:
            tokens[at : at + len(d)] = d
            context[at + 1 : at + 1 + len(d)] = d
            at += len(d) + 1
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        self.first = np.zeros(total, dtype=bool)
        self.first[self.starts] = True
        word, pair = tokens & ~np.uint64(1), mixed(context, tokens) | np.uint64(1)
        self.keys, place = np.unique(np.concatenate((word, pair)), return_inverse=True)
        self.word, self.pair = place[:total], place[total:]

    def counts(self, docs: np.ndarray) -> np.ndarray:
        """How often each key occurs in the marked documents."""
        on = np.repeat(docs, self.lengths)
        return np.bincount(self.word[on], minlength=len(self.keys)) + np.bincount(self.pair[on], minlength=len(self.keys))

    def context_word(self) -> np.ndarray:
        """The place of each token's context as a word; of no meaning for a document's first token."""
        return np.concatenate(([0], self.word[:-1]))


def bucket_bounds(n: int) -> np.ndarray:
    """Smallest key of each bucket."""
    return np.array([(i << 64) // n for i in range(n)], dtype=np.uint64)


def chunked(docs: DataFrame) -> DataFrame:
    """Rows (chunk, kind, n_bytes, tokens, docs, blob): kind 0 holds all rows of a slice, kind 1 those to
    tune on; tokens and docs count those to learn from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, task = 0, TaskContext.get().partitionId()
        for batch in batches:
            for part in slices(batch, CHUNK_BYTES):
                for kind, rows in ((0, part), (1, part.filter(part.column("tune")))):
                    if rows.num_rows:
                        lengths = [len((t or "").encode("utf-8", "replace").split()) + 1 for t in rows.filter(rows.column("learn")).column("text").to_pylist()]
                        yield pa.RecordBatch.from_arrays([pa.array([(task << 33) + 2 * k + kind]), pa.array([kind], pa.int32()), pa.array([rows.nbytes]), pa.array([sum(lengths)], pa.int64()), pa.array([len(lengths)], pa.int64()), pa.array([to_ipc(rows)], pa.binary())], names=["chunk", "kind", "n_bytes", "tokens", "docs", "blob"])
                k += 1

    return docs.mapInArrow(run, "chunk long, kind int, n_bytes long, tokens long, docs long, blob binary")


def asked(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """Rows (bucket, chunk, keys, c, e): a chunk's keys of a bucket, with counts over documents to learn and to tune on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, bounds = Hashes(), bucket_bounds(n_buckets)
        for batch in batches:
            for row in batch.to_pylist():
                t = from_ipc(row["blob"])
                chunk = Chunk(t.column("text").to_pylist(), hashes)
                learn, tune = np.array(t.column("learn").to_pylist(), dtype=bool), np.array(t.column("tune").to_pylist(), dtype=bool)
                c = chunk.counts(learn if row["kind"] == 0 else learn & False)
                e = chunk.counts(tune if row["kind"] == 0 else tune & False)
                cut = [*np.searchsorted(chunk.keys, bounds).tolist(), len(chunk.keys)]
                some = [(b, cut[b], cut[b + 1]) for b in range(n_buckets) if cut[b] < cut[b + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([b for b, _, _ in some], pa.int32()),
                        pa.array([row["chunk"]] * len(some), pa.int64()),
                        pa.array([packed(chunk.keys[i:j]) for _, i, j in some], pa.binary()),
                        pa.array([packed_counts(c[i:j]) for _, i, j in some], pa.binary()),
                        pa.array([packed_counts(e[i:j]) for _, i, j in some], pa.binary()),
                    ],
                    names=["bucket", "chunk", "keys", "c", "e"],
                )

    return chunks.select("chunk", "kind", "blob").mapInArrow(run, "bucket int, chunk long, keys binary, c binary, e binary")


def answered(t: pa.Table) -> pa.Table:
    """A bucket's sums, sent back for each chunk's keys."""
    keys = [unpacked(k) for k in t.column("keys").to_pylist()]
    _, place = np.unique(np.concatenate(keys), return_inverse=True)
    every = np.concatenate(keys)
    c = np.bincount(place, weights=np.concatenate([unpacked_counts(x) for x in t.column("c").to_pylist()]))
    e = np.bincount(place, weights=np.concatenate([unpacked_counts(x) for x in t.column("e").to_pylist()]))
    is_word = np.zeros(len(c), dtype=bool)
    is_word[place[(every & np.uint64(1)) == 0]] = True
    n_words, n_words_rest = int((is_word & (c > 0)).sum()), int((is_word & (c > e)).sum())
    cut = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
    own = [place[cut[i] : cut[i + 1]] for i in range(len(keys))]
    n = len(own)
    return pa.table(
        {
            "chunk": t.column("chunk"),
            "bucket": t.column("bucket"),
            "c": pa.array([packed_counts(c[p]) for p in own], pa.binary()),
            "e": pa.array([packed_counts(e[p]) for p in own], pa.binary()),
            "n_words": pa.array([n_words] * n, pa.int64()),
            "n_words_rest": pa.array([n_words_rest] * n, pa.int64()),
        }
    )


def opened(left: pa.Table, right: pa.Table) -> tuple[pa.Table, Chunk, np.ndarray, np.ndarray]:
    """A chunk's rows, its tokens, and the counts of its keys over all chunks."""
    t = from_ipc(left.column("blob")[0].as_py())
    order = np.argsort(right.column("bucket").to_numpy())
    c, e = ([unpacked_counts(x) for x in right.column(n).take(pa.array(order)).to_pylist()] for n in ("c", "e"))
    return t, Chunk(t.column("text").to_pylist(), Hashes()), np.concatenate(c).astype(np.int64), np.concatenate(e).astype(np.int64)


def ratios(chunk: Chunk, c: np.ndarray, n_tokens: int, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each token: the bucket of its context's count, c(v,w)/c(v) and c(w)/N, 0 where nothing is known."""
    context = np.where(chunk.first, n_docs, c[chunk.context_word()])
    two = np.divide(c[chunk.pair], context, out=np.zeros(len(context)), where=context > 0)
    return np.floor(np.log2(context + 1)).astype(np.int64), two, c[chunk.word] / max(1, n_tokens)


def level(p: np.ndarray) -> np.ndarray:
    """A probability's step on the logarithmic scale; 9999 for 0."""
    return np.where(p > 0, np.rint(-STEPS * np.log2(np.where(p > 0, p, 1))), 9999).astype(np.int64)


def weights(histogram: list[tuple[int, int, int, float]], uniform: float, rounds: int = 60) -> np.ndarray:
    """Mixture weights (l2, l1, l0) for each of 64 buckets, by expectation-maximisation.

    ``histogram``: (bucket, step of the pair estimate, step of the word estimate, tokens). Buckets that
    the tuning documents don't reach get the weights learned over all of them together.
    """

    def learn(rows: list[tuple[int, int, int, float]], with_pair: bool) -> np.ndarray:
        value = lambda s: 0.0 if s == 9999 else 2.0 ** (-s / STEPS)
        p = np.array([(value(a) * with_pair, value(b), uniform) for _, a, b, _ in rows]).reshape(-1, 3)
        n = np.array([r[3] for r in rows])
        l = np.array([0.5, 0.4, 0.1]) if with_pair else np.array([0.0, 0.9, 0.1])  # noqa: E741
        for _ in range(rounds if len(rows) else 0):
            share = p * l
            share /= share.sum(axis=1, keepdims=True)
            l = (share * n[:, None]).sum(axis=0) / n.sum()  # noqa: E741
            l = np.maximum(l, [1e-6 * with_pair, 1e-6, 1e-6])  # noqa: E741
            l /= l.sum()  # noqa: E741
        return l

    overall = learn(histogram, True)
    out = np.tile(overall, (64, 1))
    out[0] = learn(histogram, False)
    for b in sorted({r[0] for r in histogram}):
        out[b] = learn([r for r in histogram if r[0] == b], b > 0)
    return out


def score(df: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", tuned_part: int = 10) -> DataFrame:
    """Score every whole text of ``df``; learn from the rows where ``learn`` holds (null: not).

    Gives one row for each row of ``df``: ``key``, ``learn``, n_tokens, n_known, train_tokens,
    base_score (add-a-half unigrams) and score (log10 probability). The tokens of a text are its words
    and one end; a null or empty text has the end alone. Equal texts get equal scores. With nothing to
    learn from, every probability is that of one unknown token, and scores are 0.
    """
    spark = df.sparkSession
    known = F.coalesce(learn, F.lit(False))
    tune = known & (F.pmod(F.xxhash64(F.col(quoted(key)), F.lit("tune")), F.lit(tuned_part)) == 0)
    docs = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"), known.alias("learn"), F.coalesce(tune, F.lit(False)).alias("tune"))
    chunks = stored(chunked(docs), "lm-chunks")
    kind = df.schema[key].dataType.simpleString()
    total = chunks.agg(F.sum("n_bytes")).first()[0] or 0
    n_buckets = max(8, math.ceil(total / BUCKET_BYTES))
    schema = "chunk long, bucket int, c binary, e binary, n_words long, n_words_rest long"
    replies = stored(asked(chunks, n_buckets).groupBy("bucket").applyInArrow(answered, schema), "lm-counts")
    per = replies.groupBy("bucket").agg(F.max("n_words").alias("v"), F.max("n_words_rest").alias("r")).agg(F.sum("v"), F.sum("r")).first()
    v, v_rest = per[0] or 0, per[1] or 0
    sums = {r["kind"]: r for r in chunks.groupBy("kind").agg(F.sum("tokens").alias("tokens"), F.sum("docs").alias("docs")).collect()}
    n, d, n_tune, d_tune = (sums[k][x] if k in sums else 0 for k in (0, 1) for x in ("tokens", "docs"))

    def tuned(group, left: pa.Table, right: pa.Table) -> pa.Table:
        _, chunk, c, e = opened(left, right)
        b, two, one = ratios(chunk, c - e, n - n_tune, d - d_tune)
        rows, times = np.unique(np.stack([b, level(two), level(one)]), axis=1, return_counts=True)
        return pa.table({"b": rows[0], "two": rows[1], "one": rows[2], "times": times.astype(np.int64)})

    small, replies_small = chunks.where("kind = 1").groupBy("chunk"), replies.where("chunk % 2 = 1").groupBy("chunk")
    histogram = small.cogroup(replies_small).applyInArrow(tuned, "b long, two long, one long, times long").groupBy("b", "two", "one").agg(F.sum("times").alias("times")).collect()
    mix = weights(sorted((r["b"], r["two"], r["one"], float(r["times"])) for r in histogram), 1 / (v_rest + 1))

    def scored(group, left: pa.Table, right: pa.Table) -> pa.Table:
        t, chunk, c, _ = opened(left, right)
        b, two, one = ratios(chunk, c, n, d)
        l = mix[b]  # noqa: E741
        p = l[:, 0] * two + l[:, 1] * one + l[:, 2] / (v + 1)
        own = c[chunk.word]
        base = np.log10((own + 0.5) / (n + 0.5 * (v + 1)))
        at = chunk.starts
        return pa.table(
            {
                "key": t.column("key"),
                "learn": t.column("learn"),
                "n_tokens": pa.array(chunk.lengths, pa.int64()),
                "n_known": pa.array(np.add.reduceat((own > 0).astype(np.int64), at), pa.int64()),
                "train_tokens": pa.array([n] * t.num_rows, pa.int64()),
                "base_score": np.add.reduceat(base, at),
                "score": np.add.reduceat(np.log10(p), at) if n else np.zeros(t.num_rows),
            }
        )

    out = f"key {kind}, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    main, replies_main = chunks.where("kind = 0").groupBy("chunk"), replies.where("chunk % 2 = 0").groupBy("chunk")
    return main.cogroup(replies_main).applyInArrow(scored, out).withColumnRenamed("key", key)


