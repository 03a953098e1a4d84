"""Quality rules: gradient-boosted trees over statistics of documents (operator 12).

Each text is described by counts and shares; trees learned from labelled documents rate them. The trees are flattened
into numpy arrays of nodes, so a batch of rows walks all trees at once. On chosen features the rating can only fall
(or only rise), whatever the labels of the sample are.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import quoted, stored, with_python_columns

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
#: Words in a window, and the rule's limits: fewest words, and largest share (in percent) of words in repeated windows.
WINDOW, FEWEST, MOST_REPEATED = 8, 20, 30
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features of the trees; -1: the rating may only fall as the feature grows, 0: free.
FEATURES = {
    "log_words": 0, "word_length": 0, "longest_word": 0, "symbol_share": -1, "duplicate_line_share": -1, "repeated_share": -1, "distinct_share": 0, "commonest_share": -1,
    "letter_share": 0, "upper_share": -1, "digit_share": 0, "mark_share": -1, "letterless_share": -1, "line_words": 0, "ended_share": 0, "next_equal_share": -1,
}
LETTER, UPPER, DIGIT, SPACE, MARK = 1, 2, 4, 8, 16


@lru_cache(1)
def classes() -> np.ndarray:
    """Flags of each code point."""
    table = np.zeros(0x110000, dtype=np.uint8)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            table[code] = LETTER | (UPPER if c.isupper() else 0)
        elif c.isdigit():
            table[code] = DIGIT
    table[[ord(c) for c in SPACES]] = SPACE
    table[[ord(c) for c in "!?"]] = MARK
    return table


def repeated_words(ids: np.ndarray, window: int = WINDOW) -> int:
    """Words that lie in a window which is found twice or more."""
    n = len(ids) - window + 1
    if n < 2:
        return 0
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(window):
        total = total * np.uint64(0xC2B2AE3D27D4EB4F) + mixed[k : k + n]
    total.sort()
    if not (total[1:] == total[:-1]).any():  # equal windows have equal sums
        return 0
    ranks, width = ids.astype(np.int64), 1
    while width < window:  # exact ranks of windows of twice the width
        step = min(width, window - width)
        pairs = ranks[:-step] * (int(ranks.max()) + 1) + ranks[step:]
        _, ranks = np.unique(pairs, return_inverse=True)
        width += step
    often = np.bincount(ranks)[ranks] > 1
    edges = np.zeros(len(ids) + 1, dtype=np.int64)
    edges[:n] += often
    edges[window:] -= often
    return int((np.cumsum(edges) > 0).sum())


def statistics(text: str) -> tuple[list[int], list[float]]:
    """(COUNTS, FEATURES) of a whole text."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()  # at exactly x20 and x09-x0D
    n = len(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    symbols = sum(text.count(c) for c in SYMBOLS)
    flags = classes()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype="<u4")]
    chars = int((flags != SPACE).sum())
    if not n:
        return [0, 0, symbols, 0, 0], [0.0] * len(FEATURES)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=n)
    repeated, twins = repeated_words(ids), len(lines) - len(set(lines))
    letters = int((flags & LETTER > 0).sum())
    inside = np.concatenate([[False], flags != SPACE, [False]])
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(~inside[1:] & inside[:-1])
    so_far = np.concatenate([[0], np.cumsum(flags & LETTER, dtype=np.int64)])
    letterless = int((so_far[ends] == so_far[starts]).sum())
    share = lambda a, b: a / b if b else 0.0
    features = {
        "log_words": float(np.log1p(n)), "word_length": chars / n, "longest_word": float(np.log1p(max(map(len, known)))), "symbol_share": symbols / chars, "duplicate_line_share": share(twins, len(lines)),
        "repeated_share": repeated / n, "distinct_share": len(known) / n, "commonest_share": float(np.bincount(ids).max()) / n, "letter_share": letters / chars, "upper_share": share(int((flags & UPPER > 0).sum()), letters),
        "digit_share": float((flags & DIGIT > 0).sum()) / chars, "mark_share": float((flags & MARK > 0).sum()) / chars, "letterless_share": letterless / n, "line_words": float(np.log1p(n / len(lines))),
        "ended_share": sum(line.rstrip()[-1:] in (b".", b"!", b"?", b":", b'"') for line in lines) / len(lines), "next_equal_share": share(int((ids[1:] == ids[:-1]).sum()), n - 1),
    }
    return [n, chars, symbols, twins, repeated], [features[f] for f in FEATURES]


def described(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with COUNTS and ``features`` in place of the text; a null text has no words. Rows and other columns stay; columns with these names are replaced."""

    def make() -> Callable:
        def step(columns: list[pa.Array]) -> list:
            made = [statistics(t or "") for t in columns[0].to_pylist()]
            return [*[pa.array([m[0][i] for m in made], pa.int64()) for i in range(len(COUNTS))], pa.array([m[1] for m in made], pa.list_(pa.float64()))]

        return step

    outputs = [*[T.StructField(c, T.LongType()) for c in COUNTS], T.StructField("features", T.ArrayType(T.DoubleType()))]
    return with_python_columns(df, [text], outputs, make, drop=(text,))


@dataclass
class Forest:
    """Nodes of all trees: a row goes left where ``x[feature] <= threshold``; a leaf leads to itself."""

    bias: float
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1 of each row."""
        total = np.full(len(x), self.bias)
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth if len(self.roots) else 0):
            node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
        total = total + self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train(x: np.ndarray, label: np.ndarray, signs: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, least: float = 4.0, penalty: float = 1.0, bins: int = 64) -> Forest:
    """Boosted trees for the logistic loss, by histograms of gradients.

    A split on a signed feature is taken only if its sides' values are in that order, and their mean bounds what stands
    below them; so the sum is monotone in the feature. ``least`` is the smallest sum of second derivatives of a side.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for j in range(m)]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)]) if n else np.zeros((m, 0), dtype=int)
    prior = np.clip(label.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    bias = float(np.log(prior / (1 - prior)))
    margin = np.full(n, bias)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    worth = lambda g, h, w: -(g * w + 0.5 * (h + penalty) * w * w)
    for _ in range(trees if 0 < label.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - label, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, np.inf, 0, 0, 0.0])
        waiting = [(roots[-1], np.arange(n), -np.inf, np.inf)]
        for level in range(depth + 1):
            below = []
            for at, rows, low, high in waiting:
                gs, hs = g[rows], h[rows]
                value = float(np.clip(-gs.sum() / (hs.sum() + penalty), low, high))
                best = (1e-6, None)
                for j in range(m) if level < depth else ():
                    size = len(cuts[j]) + 1
                    gl, hl = (np.cumsum(np.bincount(codes[j][rows], w, size))[:-1] for w in (gs, hs))
                    gr, hr = gs.sum() - gl, hs.sum() - hl
                    wl, wr = np.clip(-gl / (hl + penalty), low, high), np.clip(-gr / (hr + penalty), low, high)
                    gain = worth(gl, hl, wl) + worth(gr, hr, wr) - worth(gs.sum(), hs.sum(), value)
                    gain[(hl < least) | (hr < least) | (signs[j] * (wr - wl) < 0)] = -1
                    if len(gain) and gain.max() > best[0]:
                        k = int(gain.argmax())
                        best = (float(gain[k]), (j, k, float(wl[k]), float(wr[k])))
                if best[1] is None:
                    nodes[at] = [0, np.inf, at, at, rate * value]
                    margin[rows] += rate * value
                    continue
                j, k, wl, wr = best[1]
                middle, sides = (wl + wr) / 2, (len(nodes), len(nodes) + 1)
                nodes[at] = [j, float(cuts[j][k]), *sides, 0.0]
                nodes += [[0, np.inf, 0, 0, 0.0], [0, np.inf, 0, 0, 0.0]]
                goes = codes[j][rows] <= k
                bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[signs[j]]
                below += [(sides[0], rows[goes], *bounds[0]), (sides[1], rows[~goes], *bounds[1])]
            waiting = below
    flat = np.array(nodes, dtype=float).reshape(-1, 5)
    whole = lambda c: flat[:, c].astype(np.int64)
    return Forest(bias, whole(0), flat[:, 1], whole(2), whole(3), flat[:, 4], np.array(roots, dtype=np.int64), depth)


def fit(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", bound: int = 20_000, **options: float) -> Forest:
    """Trees from about ``bound`` distinct labelled rows of ``stats`` (see ``described``); all, if there are no more.

    Rows with a null key or label are left out; of several labels of a key the smallest counts. Rows that are equal in key
    and features count once, and the choice is by a hash of both, so it holds whatever the keys are. Without labels
    of both kinds there are no trees, and every row gets the share of label 1.
    """
    own, mark = F.col(quoted(key)), F.col(quoted(label))
    marked = labels.where(own.isNotNull() & mark.isNotNull()).groupBy(own.alias("key")).agg(F.min(mark.cast("int")).alias("label"))
    joined = stored(stats.select(own.alias("key"), "features").join(marked, "key").distinct(), "labelled")
    n = joined.count()
    if n > bound:
        joined = joined.where(F.pmod(F.xxhash64("key", "features", F.lit("sample")), F.lit(1 << 30)) < int(bound / n * (1 << 30)))
    rows = sorted((r.features, r.label) for r in joined.select("features", "label").collect())
    x = np.array([r[0] for r in rows], dtype=float).reshape(-1, len(FEATURES))
    return train(x, np.array([min(1, max(0, r[1])) for r in rows], dtype=float), list(FEATURES.values()), **options)


def judged(stats: DataFrame, forest: Forest, least: float = 0.3) -> DataFrame:
    """``stats`` with ``score``, ``base_failed`` and ``kept`` in place of the features.

    Base: fewer than ``FEWEST`` words, or more than ``MOST_REPEATED`` percent of the words in repeated windows. Kept are
    rows that pass it and that the trees rate ``least`` and more; without trees all that pass.
    """
    shared = stats.sparkSession.sparkContext.broadcast(forest)

    def make() -> Callable:
        model = shared.value

        def step(columns: list[pa.Array]) -> list:
            x = np.array(columns[0].to_pylist(), dtype=float).reshape(-1, len(FEATURES))
            return [pa.array(model.scores(x))]

        return step

    rated = with_python_columns(stats, ["features"], [T.StructField("score", T.DoubleType())], make, drop=("features",))
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    good = (F.col("score") >= least) if len(forest.roots) else F.lit(True)
    return rated.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & good)


def rated(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", least: float = 0.3) -> DataFrame:
    """``docs`` without the text, with COUNTS, ``score``, ``base_failed`` and ``kept``, learned from ``labels``.

    Statistics of all whole texts are made once and stored. Null and empty texts have no words and fail the base rule;
    rows that repeat, also in their key, are each given back; null keys are rated but not learned from; an empty table
    stays empty. Columns with the new names are replaced.
    """
    stats = stored(described(docs, text), "statistics")
    return judged(stats, fit(stats, labels, key), least)
