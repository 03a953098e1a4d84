"""Quality rules: counts against plain Python, trees against labels kept from learning, and their monotone features."""

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quern.llm import quality
from quern.llm.q_quality import op12_quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab \n\t\x0b \x85É#|.", max_size=90))
def test_counts(text):
    assert quality.statistics(text)[0] == brute(text)


def test_counts_of_long_and_odd_texts():
    for text in ("", " \n\t", "a " * 700, "a b c d e f g h " * 40 + "x y", "one two three four five six seven eight nine " * 2, "ᛒ\U0001f600 <|> \r\n" * 9, "\x1c\x1d a b\n\na\x0c"):
        assert quality.statistics(text)[0] == brute(text)
    long = " ".join(map(str, range(200_000)))
    assert quality.statistics(long)[0][4] == 0
    assert quality.statistics(long + " end " + long)[0][4] == 400_000


def test_whole_table(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = op12_quality(spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        words = len(WORD.findall(docs[r.doc_id] or ""))
        if words < 2_000:
            assert [r[c] for c in quality.COUNTS] == brute(docs[r.doc_id] or "")
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)


def test_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    quality_of = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    some = spark.createDataFrame([(i, q) for i, q in quality_of.items() if not held(i)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.rated(docs.select("doc_id", "text"), some).collect()}
    tested = [(found[i], q) for i, q in quality_of.items() if held(i) and i in found and not found[i].base_failed]
    assert sum(q for _, q in tested) > 500 and sum(1 - q for _, q in tested) > 50
    assert np.mean([r.kept == bool(q) for r, q in tested]) > 0.97
    assert np.mean([r.kept for r, q in tested if q]) > 0.98


def test_monotone_features_and_flat_nodes():
    rng = np.random.default_rng(2)
    x = rng.random((600, 3))
    label = (rng.random(600) < 0.15 + 0.7 * (np.sin(9 * x[:, 0]) > 0) * (1 - x[:, 2])).astype(float)
    free, held = quality.train(x, label, [0, 0, 0]), quality.train(x, label, [-1, 1, -1])
    grid = np.linspace(0, 1, 101)
    for j, sign in ((0, -1), (1, 1), (2, -1)):
        for row in x[:40]:
            line = np.tile(row, (101, 1))
            line[:, j] = grid
            assert (sign * np.diff(held.scores(line)) >= -1e-12).all()
    line = np.tile(x[0], (101, 1))
    line[:, 0] = grid
    assert (np.diff(free.scores(line)) < 0).any() and (np.diff(free.scores(line)) > 0).any()

    def walk(forest, row):
        total = forest.bias
        for at in forest.roots:
            while forest.left[at] != at:
                at = forest.left[at] if row[forest.feature[at]] <= forest.threshold[at] else forest.right[at]
            total += forest.value[at]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(free.scores(x[:50]), [walk(free, r) for r in x[:50]])
    assert np.mean((free.scores(x) > 0.5) == label) > 0.8


def test_odd_rows(spark):
    text = " ".join(f"Word{i} stands here." for i in range(30))
    rows = [(1, text, 5, "a"), (1, text, 5, "a"), (None, text, 6, "b"), (2, None, 7, None), (3, "", None, ""), (4, "x " * 300_000, 8, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Score int, `a.b` string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (4, 0)], "doc_id long, quality int")
    found = quality.rated(docs, labels).collect()
    assert sorted((r.doc_id or -1, r.kept) for r in found) == [(-1, True), (1, True), (1, True), (2, False), (3, False), (4, False)]
    assert {r["a.b"] for r in found} == {"a", "b", None, "", "c"} and [c for c in docs.columns if c not in ("text", "Score")] == found[0].__fields__[:2]
    assert quality.rated(docs.limit(0), labels).count() == 0
    none = quality.rated(docs, labels.limit(0)).collect()
    assert sum(r.kept for r in none) == 3 and all(abs(r.score - 0.5) < 1e-9 for r in none)


@pytest.mark.parametrize("same", ["null", "one"])
def test_sample_is_bounded_whatever_the_keys(spark, same):
    key = "cast(null as long)" if same == "null" else "5"
    stats = spark.range(4000).selectExpr(f"{key} as doc_id", "array_repeat(cast(id as double), 16) as features")
    labels = spark.createDataFrame([(5, 1)], "doc_id long, quality int")
    forest = quality.fit(stats, labels, bound=500)
    assert len(forest.roots) == 0 and forest.bias == pytest.approx(np.log(0.999 / 0.001) if same == "one" else 0)
