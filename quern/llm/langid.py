"""Language identification in two steps (operator 6): the family first, then the language within it.

A text's features are counts of hashed byte trigrams of its lower-cased letters, under a square root and
scaled to length one. Linear support vector machines (squared hinge) separate each pair of families, and
within a family each pair of languages; the winner of most pairs is predicted.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import chosen, quoted, with_python_columns

#: Language codes of the larger European families. Other codes form the family "other".
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "turkic": "az kk ky tr tt uz",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

DIMS = 4096
#: ASCII that is no letter counts as a space.
TO_SPACE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
LETTER = regex.compile(r"\p{L}").search
UNDETERMINED = "und"


def features(text: str) -> np.ndarray:
    """Hashed trigram counts of a whole text, square-rooted, of length one; zeros without letters."""
    codes = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(TO_SPACE) + b" ", dtype=np.uint8)
    codes = codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))].astype(np.uint32)
    if len(codes) < 3:
        return np.zeros(DIMS, dtype=np.float32)
    mixed = (codes[:-2] * np.uint32(0x9E3779B1)) ^ (codes[1:-1] * np.uint32(0x85EBCA77)) ^ (codes[2:] * np.uint32(0xC2B2AE3D))
    mixed = (mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    counts = np.sqrt(np.bincount(mixed >> np.uint32(20), minlength=DIMS).astype(np.float32))
    return counts / np.linalg.norm(counts)


def separate(x: np.ndarray, sign: np.ndarray, penalty: float = 1e-4, rounds: int = 150) -> np.ndarray:
    """A linear support vector machine with bias: squared hinge and L2 penalty, by accelerated gradients."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=np.float32)])
    weight = np.where(sign > 0, 0.5 / max(1, (sign > 0).sum()), 0.5 / max(1, (sign < 0).sum())).astype(np.float32)
    w = ahead = np.zeros(x.shape[1], dtype=np.float32)
    step = 1 / (4.0 + penalty)
    for k in range(rounds):
        slack = np.maximum(0, 1 - sign * (x @ ahead))
        new = ahead - step * (penalty * ahead - 2 * (x.T @ (weight * sign * slack)))
        ahead = new + k / (k + 3) * (new - w)
        w = new
    return w


class Tree:
    """Pairwise machines over the families, and over the languages of each."""

    def __init__(self, x: np.ndarray, y: list[str]) -> None:
        labels = np.array(y)
        family = np.array([FAMILY_OF.get(v, "other") for v in y])
        self.families = sorted(set(family.tolist()))
        self.languages = {f: sorted(set(labels[family == f].tolist())) for f in self.families}
        self.top = {p: self._pair(x, family, p) for p in combinations(self.families, 2)}
        self.within = {p: self._pair(x, labels, p) for f in self.families for p in combinations(self.languages[f], 2)}

    @staticmethod
    def _pair(x: np.ndarray, y: np.ndarray, pair: tuple[str, str]) -> np.ndarray:
        some = (y == pair[0]) | (y == pair[1])
        return separate(x[some], np.where(y[some] == pair[0], 1, -1).astype(np.float32))

    @staticmethod
    def _vote(x: np.ndarray, names: list[str], machines: dict) -> tuple[np.ndarray, np.ndarray]:
        """For each row the index of the winner (ties: larger sum of margins, then first), and its least certain win."""
        votes = np.zeros((len(x), len(names)))
        margins = np.full((len(x), len(names), len(names)), np.inf)
        for i, j in combinations(range(len(names)), 2):
            w = machines[names[i], names[j]]
            m = x @ w[:-1] + w[-1]
            margins[:, i, j], margins[:, j, i] = m, -m
            votes[:, i] += (m >= 0) + 1e-3 * np.tanh(m)
            votes[:, j] += (m < 0) - 1e-3 * np.tanh(m)
        best = votes.argmax(axis=1)
        least = margins[np.arange(len(x)), best].min(axis=1)
        return best, 1 / (1 + np.exp(-4 * np.minimum(least, 50)))

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        best, sure = self._vote(x, self.families, self.top)
        names = np.empty(len(x), dtype=object)
        for k, f in enumerate(self.families):
            rows = np.flatnonzero(best == k)
            if len(rows):
                inner, certain = self._vote(x[rows], self.languages[f], self.within)
                names[rows] = np.array(self.languages[f], dtype=object)[inner]
                sure[rows] *= certain
        return names.tolist(), sure


def fit(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = 800, total: int = 4800, most_languages: int = 200) -> Tree | None:
    """Fit on a bounded sample: about ``per_language`` rows of each language, ``total`` in all.

    Rows with a null language, or without letters, are not used; None if no rows are left, as in an empty table.
    Of more than ``most_languages`` values of ``lang`` the commonest are learned. Whole texts are read; the choice goes by
    a row's place in the scan, so null and equal keys, and equal rows, do not matter. The features are made on the
    executors; only they and the labels of the sample come to the driver.
    """
    df = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text"))
    known = df.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()}
    if not counts:
        return None
    each = max(20, min(per_language, total // len(counts)))
    share: Column = F.lit(0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, F.lit(min(1 << 30, int(each / n * (1 << 30))))).otherwise(share)
    some = known.where(chosen(share)).select("lang", "text")

    def make() -> Callable:
        return lambda columns: [pa.array([features(t).astype(np.float16).tobytes() for t in columns[0].to_pylist()], pa.binary())]

    vectors = lambda df: with_python_columns(df, ["text"], [T.StructField("vector", T.BinaryType())], make, drop=("text",)).collect()
    rows = vectors(some) or vectors(known.select("lang", "text").limit(each))
    rows.sort(key=lambda r: (r["lang"], bytes(r["vector"])))
    x = np.stack([np.frombuffer(r["vector"], dtype=np.float16).astype(np.float32) for r in rows])
    return Tree(x, [r["lang"] for r in rows])


def predict(df: DataFrame, tree: Tree | None, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add ``lang`` and ``score`` (0 to 1: the certainty of the least certain pair won, over both steps).

    A text that is null or has no letter is ``und`` with score 0, as is every text without a fitted
    tree. Whole texts are read. Rows are kept one for one; columns of the outputs' names are replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(tree)

    def make() -> Callable:
        model = shared.value

        def step(columns):
            texts = columns[0].to_pylist()
            names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
            rows = [i for i, t in enumerate(texts) if t and LETTER(t)] if model else []
            for at in range(0, len(rows), 256):
                some = rows[at : at + 256]
                found, sure = model.predict(np.stack([features(texts[i]) for i in some]))
                for i, n, s in zip(some, found, sure.tolist(), strict=True):
                    names[i], scores[i] = n, s
            return pa.array(names, pa.string()), pa.array(scores, pa.float64())

        return step

    return with_python_columns(df, [text], [T.StructField(lang, T.StringType()), T.StructField(score, T.DoubleType())], make)


def identify(docs: DataFrame, learn: Column | None = None, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """Fit on the rows where ``learn`` holds (all, if None) and predict for every row of ``docs``."""
    part = docs if learn is None else docs.where(learn)
    return predict(docs, fit(part.select(*[F.col(quoted(c)) for c in (key, text, lang)]), text, lang, key), text)
