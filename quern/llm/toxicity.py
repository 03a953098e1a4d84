"""Toxicity by a factorization machine over hashed terms (operator 5).

Terms are the words of a text and the beginnings of its longer words, hashed. The machine adds to a
weight per term the products of term vectors, so that pairs of terms count that one by one say little.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, quoted, sampled, sampled_rows, stored, with_python_columns

BITS = 20
WORD = regex.compile(r"\p{L}+").findall
#: Words that a worker remembers before it starts anew.
MEMO = 1 << 18


def terms_of(word: str) -> list[int]:
    """Hashed terms of a word: itself and its first four and five letters."""
    parts = [word + "|", *(word[:k] for k in (4, 5) if len(word) >= k)]
    return [xxhash.xxh3_64_intdigest(p) >> (64 - BITS) for p in parts]


def terms(text: str) -> np.ndarray:
    """The distinct hashed terms of a whole text, sorted."""
    return np.unique(np.array([t for w in set(WORD(text.lower())) for t in terms_of(w)], dtype=np.int32))


class Machine:
    """y = b + sum w_i + sum over pairs <v_i, v_j>, over the chosen terms that a text has."""

    def __init__(self, chosen: np.ndarray, bias: float, weights: np.ndarray, vectors: np.ndarray) -> None:
        self.index = {int(t): i for i, t in enumerate(chosen)}
        self.bias, self.weights, self.vectors = bias, weights, vectors
        self.squares = (vectors**2).sum(axis=1)

    def score(self, active: list[int]) -> float:
        if not active:
            return float(1 / (1 + np.exp(-self.bias)))
        s = self.vectors[active].sum(axis=0)
        y = self.bias + self.weights[active].sum() + 0.5 * (s @ s - self.squares[active].sum())
        return float(1 / (1 + np.exp(-np.clip(y, -30, 30))))


def choose(rows: list[np.ndarray], label: np.ndarray, most: int, least: int) -> np.ndarray:
    """Terms of at least ``least`` texts whose share differs most between the labels (by the chi-squared
    statistic, over 12), ``most`` at the utmost."""
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    owner = np.repeat(label, [len(r) for r in rows])
    n1, n0 = max(1, label.sum()), max(1, (1 - label).sum())
    c1 = np.bincount(flat[owner == 1], minlength=1 << BITS).astype(float)
    c0 = np.bincount(flat[owner == 0], minlength=1 << BITS).astype(float)
    share = (c1 + c0) / (n1 + n0)
    chi = (c1 / n1 - c0 / n0) ** 2 / (share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
    good = np.flatnonzero((c1 + c0 >= least) & (chi > 12))
    return np.sort(good[np.argsort(-chi[good], kind="stable")][:most])


def paired(rows: list[np.ndarray], label: np.ndarray, known: np.ndarray, most: int) -> np.ndarray:
    """Terms that say nothing alone but do beside another: the share of one differs between the labels in the texts that have the other.

    Looked for among the ``most`` commonest terms that some texts lack, by the chi-squared statistic in the texts
    with the other term, where at least five texts are expected in each cell; its bound rises with the number of pairs. Gives
    such terms that are not ``known``, and those beside which they tell, so that the machine can learn their product.
    """
    flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
    count = np.bincount(flat, minlength=1 << BITS)
    some = np.flatnonzero((count >= 10) & (count < len(rows)))
    some = np.sort(some[np.argsort(-count[some], kind="stable")][:most])
    m = len(some)
    if m < 2:
        return np.zeros(0, dtype=np.int64)
    place = np.full(1 << BITS, -1)
    place[some] = np.arange(m)
    joint = np.zeros((2, m, m), dtype=np.float32)
    for kind in (0, 1):
        own = [r for r, y in zip(rows, label, strict=True) if y == kind]
        for at in range(0, len(own), 1024):
            block = np.zeros((min(1024, len(own) - at), m), dtype=np.float32)
            for i, r in enumerate(own[at : at + 1024]):
                on = place[r]
                block[i, on[on >= 0]] = 1
            joint[kind] += block.T @ block
    new = np.isin(some, known, invert=True)
    beyond = 12 + 2 * np.log(m * m)
    found: set[int] = set()
    for t in range(m):
        n0, n1 = joint[0, t, t], joint[1, t, t]
        if min(n0, n1) < 5:
            continue
        c0, c1 = joint[0, t].astype(float), joint[1, t].astype(float)
        share = (c0 + c1) / (n0 + n1)
        chi = (c1 / n1 - c0 / n0) ** 2 / (share * (1 - share) * (1 / n1 + 1 / n0) + 1e-12)
        telling = np.flatnonzero(new & (chi > beyond) & (np.minimum(share, 1 - share) * min(n0, n1) >= 5))
        if len(telling):
            found.update([t, *telling.tolist()])
    return some[sorted(found)]


def train(rows: list[np.ndarray], label: np.ndarray, rank: int = 4, most: int = 20_000, least: int = 3, rounds: int = 200, penalty: float = 2e-5, common: int = 1_500) -> Machine:
    """Logistic loss by Adam over the whole sample.

    The machine knows the ``most`` terms that tell most alone, and of the ``common`` commonest those that tell in a pair.
    """
    chosen = choose(rows, label, most, least)
    chosen = np.union1d(chosen, paired(rows, label, chosen, common))
    place = np.full(1 << BITS, -1)
    place[chosen] = np.arange(len(chosen))
    kept = [place[r][place[r] >= 0] for r in rows]
    col = np.concatenate(kept) if kept else np.zeros(0, dtype=int)
    row = np.repeat(np.arange(len(rows)), [len(k) for k in kept])
    n, m = len(rows), len(chosen)
    prior = np.clip(label.mean() if n else 0.0, 1e-3, 1 - 1e-3)
    rng = np.random.default_rng(5)
    state = [np.array([np.log(prior / (1 - prior))]), np.zeros(m), rng.normal(0, 0.05, (m, rank))]
    first, second = [np.zeros_like(p) for p in state], [np.zeros_like(p) for p in state]
    for t in range(1, rounds + 1 if m else 1):
        b, w, v = state
        sums = np.stack([np.bincount(row, v[col, k], n) for k in range(rank)], axis=1)
        squares = np.bincount(row, (v**2).sum(axis=1)[col], n)
        y = b[0] + np.bincount(row, w[col], n) + 0.5 * ((sums**2).sum(axis=1) - squares)
        off = 1 / (1 + np.exp(-np.clip(y, -30, 30))) - label
        g = off[row]
        gv = np.stack([np.bincount(col, g * sums[row, k], m) for k in range(rank)], axis=1) - np.bincount(col, g, m)[:, None] * v
        grads = [np.array([off.mean()]), np.bincount(col, g, m) / n + penalty * w, gv / n + penalty * v]
        for i, grad in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.99 * second[i] + 0.01 * grad**2
            state[i] = state[i] - 0.08 * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.99**t)) + 1e-8)
    return Machine(chosen, float(state[0][0]), state[1], state[2])


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id", bound: int = 20_000, most_bytes: int = 40 << 20) -> Machine:
    """Fit on a bounded sample of labelled rows: about ``bound`` rows, and ``most_bytes`` of their hashed terms (4 bytes each).

    Rows with a null key or label are left out; of several labels of a key the largest counts. A row whose
    terms take over a sixteenth of ``most_bytes`` is not learned from. Null and empty texts have no terms, rows that
    repeat a key count each, and tables without a common key give a machine of the prior alone. The sample's keys
    are bounded and so broadcast to the scan of the texts; terms are made on the executors.
    """
    own, mark = F.col(quoted(key)), F.col(quoted(label))
    marked = labels.where(own.isNotNull() & mark.isNotNull()).groupBy(own.alias("key")).agg(F.max(mark.cast("int")).alias("label"))
    some = F.broadcast(sampled(marked, "key", bound))
    joined = docs.select(own.alias("key"), F.col(quoted(text)).alias("text")).join(some, "key")

    def make() -> Callable:
        return lambda columns: [pa.array([terms(t or "").astype("<i4").tobytes() for t in columns[0].to_pylist()], pa.binary())]

    found = stored(with_python_columns(joined, ["text"], [T.StructField("terms", T.BinaryType())], make, drop=("text",)), "terms")
    rows = sampled_rows(found, bound, F.octet_length("terms"), most_bytes).collect()
    discard(found)
    rows.sort(key=lambda r: (r["key"], bytes(r["terms"])))
    return train([np.frombuffer(r["terms"], dtype="<i4") for r in rows], np.array([min(1, max(0, r["label"])) for r in rows], dtype=float))


def score(df: DataFrame, machine: Machine, text: str = "text", score: str = "score") -> DataFrame:
    """Add ``score`` (0 to 1) of each whole text; a null or empty one has the bias alone.

    Rows are kept one for one; a column that is already called ``score`` is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(machine)

    def make() -> Callable:
        model = shared.value
        index, memo = model.index, {}

        def active(word: str) -> list[int]:
            found = memo.get(word)
            if found is None:
                if len(memo) >= MEMO:
                    memo.clear()
                found = memo[word] = [index[t] for t in terms_of(word) if t in index]
            return found

        def one(text: str) -> float:
            on: set[int] = set()
            for word in set(WORD(text.lower())):
                on.update(active(word))
            return model.score(sorted(on))

        return lambda columns: [pa.array([one(t or "") for t in columns[0].to_pylist()], pa.float64())]

    return with_python_columns(df, [text], [T.StructField(score, T.DoubleType())], make)
