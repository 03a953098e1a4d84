"""Benchmark decontamination by pigeonhole edit matching (operator 4).

Texts and test items are normalised: letters and digits, lower-cased, words parted by one space. A passage
of a document matches an item if it can be made the item's by at most k edits, k being a share of the
item's length. An item cut into k+1 pieces then has a piece that the passage holds unchanged. A
pyahocorasick automaton finds the pieces in whole documents; around each hit, Myers' bit-parallel
algorithm computes the smallest edit distance of the item to any substring of the window. The share holds
for items of every length; one so short that it gives no edit at all must stand as whole words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.llm.common import discard, fresh, quoted, stored, with_python_columns, without

WORDS = regex.compile(r"[\p{L}\p{N}]+").findall
#: Characters of test items in one automaton; more items are worked off in several passes over the documents.
PASS_CHARS = 8 << 20

HIT = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()), T.StructField("end", T.LongType())])


def normalised(text: str | None) -> str:
    return " ".join(WORDS((text or "").lower()))


def myers(item: str, window: str) -> tuple[int, int]:
    """The smallest edit distance of ``item`` to a substring of ``window``, and where the first such ends."""
    m = len(item)
    peq: dict[str, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, now = full, 0, m
    best, at = m, 0
    for j, c in enumerate(window):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            now += 1
        elif mh & top:
            now -= 1
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if now < best:
            best, at = now, j + 1
    return best, at


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into ``errors + 1`` pieces of nearly equal length, with their places."""
    n = errors + 1
    cut = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:], strict=False)]


class Matcher:
    """The pieces of some test items, ready to be found. An item without an edit is one piece, with a space on either side."""

    def __init__(self, items: tuple[tuple[int, str], ...], share: float) -> None:
        budgets = [(k, t, min(int(len(t) * share), len(t) - 1)) for k, t in items if t]
        self.items = [(k, t, n) if n else (k, f" {t} ", 0) for k, t, n in budgets]
        self.automaton = ahocorasick.Automaton()
        owners: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text, errors) in enumerate(self.items):
            for at, piece in pieces(text, errors):
                owners.setdefault(piece, []).append((i, at))
        for piece, where in owners.items():
            self.automaton.add_word(piece, (len(piece), where))
        if owners:
            self.automaton.make_automaton()
        self.empty = not owners

    def matches(self, text: str) -> list[tuple[int, int, int]]:
        """(item_id, distance, end) of each item that the normalised text holds within its budget.

        Windows of one item that overlap are joined, so each part of a text is searched once an item.
        """
        if self.empty or not text:
            return []
        text = f" {text} "
        windows: dict[int, list[list[int]]] = {}
        for end, (length, where) in self.automaton.iter(text):
            for i, at in where:
                _, item, errors = self.items[i]
                start = end + 1 - length - at
                # only items without an edit may take in the spaces put around the text
                lo, hi = (start, start + len(item)) if item[0] == " " else (max(1, start - errors), min(len(text) - 1, start + len(item) + errors))
                own = windows.setdefault(i, [])
                if own and lo <= own[-1][1] and hi >= own[-1][0]:
                    own[-1][0], own[-1][1] = min(lo, own[-1][0]), max(hi, own[-1][1])
                else:
                    own.append([lo, hi])
        found = []
        for i, own in windows.items():
            key, item, errors = self.items[i]
            distance, end = min((d, lo + at) for lo, hi in own for d, at in [myers(item, text[lo:hi])])
            if distance <= errors:
                # places count without the space put before the text, and without the one after a whole-word item
                found.append((key, distance, end - 1 - (item[-1] == " ")))
        return sorted(found)


@lru_cache(maxsize=1)
def matcher(items: tuple[tuple[int, str], ...], share: float) -> Matcher:
    """The matcher of these items, made once a worker and not in each of its tasks."""
    return Matcher(items, share)


def passes(items: DataFrame, key: str, text: str, limit: int) -> Iterator[tuple[tuple[int, str], ...]]:
    """The distinct test items, read partition by partition, in lists of at most about ``limit`` characters."""
    held: list[tuple[int, str]] = []
    size = 0
    rows = items.where(F.col(quoted(key)).isNotNull()).select(F.col(quoted(key)).cast("long").alias("k"), F.col(quoted(text)).alias("t")).distinct()
    for row in rows.toLocalIterator():
        own = normalised(row["t"])
        if held and size + len(own) > limit:
            yield tuple(sorted(held))
            held, size = [], 0
        held.append((row["k"], own))
        size += len(own)
    yield tuple(sorted(held))


def find(docs: DataFrame, items: DataFrame, text: str = "text", item_key: str = "item_id", item_text: str = "text", share: float = 0.08, out: str = "hits", limit: int = PASS_CHARS) -> DataFrame:
    """Add ``out``: array of (item_id, distance, end in the normalised text) of the test items in each whole text.

    ``share``: edits allowed, as a share of the normalised item's length, rounded down, whatever that length is. Items
    that it gives no edit (under 13 characters at 8 %) are found as they are, as whole words; null items and
    those without letters or digits are not searched for. An item_id with several texts gives a hit for each that is found. A null or empty text has no hits. Of an item's
    several places in a text the one of smallest distance, then the first, is given. Rows are kept one for
    one; a column that is called ``out`` is replaced, all others stay. Items of more than ``limit``
    characters in all are taken in several passes, each stored before the next, so that neither the
    driver nor a task holds more of them at once; of these tables only the last stays.
    """
    context = docs.sparkSession.sparkContext
    last: DataFrame | None = None
    docs = docs.select(*[F.col(quoted(c)) for c in without(docs, out)])
    hits = out
    for number, part in enumerate(passes(items, item_key, item_text, limit)):
        if number == 0:
            docs = _one_pass(docs, context.broadcast((part, share)), text, out)
        else:
            hits = fresh(docs, out + "_more")
            written = stored(docs, "hits")
            if last is not None:
                discard(last)
            last = written
            docs = _one_pass(written, context.broadcast((part, share)), text, hits)
            docs = docs.withColumn(out, F.array_sort(F.concat(F.col(quoted(out)), F.col(quoted(hits))))).drop(hits)
    return docs


def _one_pass(docs: DataFrame, shared, text: str, out: str) -> DataFrame:
    def make() -> Callable:
        own = matcher(*shared.value)

        def step(columns):
            hits = [own.matches(normalised(t)) for t in columns[0].to_pylist()]
            return [pa.array([[{"item_id": k, "distance": d, "end": e} for k, d, e in h] for h in hits], pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int64())])))]

        return step

    return with_python_columns(docs, [text], [T.StructField(out, T.ArrayType(HIT))], make)


def clean(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents that hold no test item, with all their columns. What ``find`` says of odd rows holds here: null and empty texts stay."""
    hits = fresh(docs, "hits")
    return find(docs, items, out=hits, **options).where(F.size(hits) == 0).drop(hits)
