import random

import numpy as np
import pytest

from quern.llm import neardup, q_neardup
from quern.llm.words import Hashes


def brute(rows, size=2, percent=80):
    """{key: (n, component)} by comparing all pairs."""
    hashes, sets = Hashes(), []
    for k, t in rows:
        sets.append((k, set(neardup.shingles(t, hashes, size).tolist())))
    up = {k: k for k, _ in sets}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, (k, s) in enumerate(sets):
        for j, t in sets[:i]:
            if (s and t and 100 * len(s & t) >= percent * len(s | t)) or j == k:
                a, b = sorted((top(k), top(j)))
                up[b] = a
    return {k: top(k) for k, _ in sets}, {(k, len(s)) for k, s in sets}


def changed(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def rows():
    """Stars whose middle has any key, chains, exact copies, short texts, shared passages."""
    rng = random.Random(3)
    word = lambda: f"x{rng.randrange(5000)}"
    texts = []
    for n, copies, edits in ((100, 40, 4), (60, 12, 3), (300, 10, 15), (12, 8, 1)):
        base = [word() for _ in range(n)]
        texts += [changed(base, edits, rng) for _ in range(copies)] + [base] * 3
    chain = [word() for _ in range(120)]
    for _ in range(10):
        texts.append(chain)
        chain = changed(chain, 5, rng)
    passage = [word() for _ in range(50)]
    texts += [passage + [word() for _ in range(rng.randrange(5, 60))] for _ in range(25)]
    texts += [[word() for _ in range(rng.randrange(1, 80))] for _ in range(60)] + [["a"], ["a"], ["A"], ["a", "b"], ["b", "a"]]
    rng.shuffle(texts)
    return [(k, "  ".join(t)) for k, t in enumerate(texts)]


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(spark, rows, size):
    want, sizes = brute(rows, size)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), size=size).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert {(r.doc_id, r.n_shingles) for r in got} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_large_bucket_is_wholly_compared(spark, monkeypatch):
    """All documents meet in one bucket, in pairs that are far from every hub."""
    monkeypatch.setattr(neardup, "band_keys", lambda values: np.array([7], dtype=np.uint64))
    rng, texts = random.Random(5), []
    for _ in range(25):
        words = [f"x{rng.randrange(10**6)}" for _ in range(200)]
        texts += [words, changed(words, 10, rng)]
    rng.shuffle(texts)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    want, _ = brute(rows)
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: r.component_id for r in got} == want and len(set(want.values())) == 25


def test_group_around_a_middle(spark, monkeypatch):
    """2,000 near copies of one text, many of them unlike each other and some unlike the middle, in small blocks."""
    monkeypatch.setattr(neardup, "BLOCK", 1 << 13)
    monkeypatch.setattr(neardup, "OUTSIDE_BLOCK", 1 << 11)
    rng = random.Random(9)
    pool = [f"p{i}" for i in range(40)]
    middle = [f"m{i}" for i in range(100)]
    texts = []
    for _ in range(2_000):
        words = list(middle)
        for _ in range(rng.randrange(3, 10)):
            words[rng.randrange(100)] = rng.choice(pool)
        texts.append(words)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    hashes = Hashes()
    sets = [neardup.shingles(t, hashes) for _, t in rows]
    words = np.unique(np.concatenate(sets))
    has = np.zeros((len(rows), len(words)), dtype=np.float32)
    for k, own in enumerate(sets):
        has[k, np.searchsorted(words, own)] = 1
    common, sizes = has @ has.T, has.sum(axis=1)
    near = 100 * common >= 80 * (sizes[:, None] + sizes[None, :] - common)
    want = np.arange(len(rows))
    while True:
        new = np.array([want[n].min() for n in near])
        if (new == want).all():
            break
        want = new
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert got == dict(enumerate(want.tolist())) and 1 < len(set(got.values())) < 2_000


def test_rows_of_one_key(spark):
    rows = [(1, "b c d", 1, 2, 3), (1, "a c d", 4, 5, 6), (1, "a c d", 0, 5, 6), (2, None, 7, 8, 9), (2, "", 7, 8, 9), (3, "x y z", 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __key int, key int, `rank` int")
    left = neardup.deduplicated(df, size=2)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.text or "", r[2]) for r in left.collect()) == [(1, "a c d", 0), (2, "", 7), (3, "x y z", 7)]


def test_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "ONE"), (6, "é É"), (7, "x y " * 100_000), (8, "x  y\n" * 100_000), (9, "p q r"), (9, "p q r"), (10, "s t u v"), (10, "p q r"), (None, "p q r"), (None, None)]
    df = spark.createDataFrame([(k, t, 5, "z") for k, t in odd], "doc_id long, text string, N_shingles int, key string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in neardup.near_duplicates(df).collect())
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (5, 1, 4, False), (6, 1, 6, True), (7, 2, 7, True), (8, 2, 7, False)]
        + [(9, 2, 9, True)] * 2 + [(10, 3, 9, False), (10, 2, 9, False), (0, 2, 0, True), (0, 0, 0, True)]
    )
    left = neardup.deduplicated(df, size=2)
    assert left.columns == df.columns and sorted((r.doc_id or 0) for r in left.collect()) == [0, 0, 1, 2, 3, 4, 6, 7, 9]
    assert neardup.near_duplicates(df.limit(0)).count() == 0 and neardup.deduplicated(df.limit(0)).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    agree = []
    for n in (3, 40, 2000):
        for _ in range(60):
            a = rng.integers(0, 2**64, n, dtype=np.uint64)
            b = a.copy()
            b[: max(1, n // 3)] = rng.integers(0, 2**64, max(1, n // 3), dtype=np.uint64)
            a, b = np.unique(a), np.unique(b)
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            agree.append((neardup.signature(a) == neardup.signature(b)).mean() - true)
    assert abs(np.mean(agree)) < 0.02


def test_query_against_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want, _ = brute(rows)
    assert {r.doc_id: r.component_id for r in q_neardup.op1_near_duplicates(spark, sf).collect()} == want
