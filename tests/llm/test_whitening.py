"""Whitening against numpy's eigenvectors."""

import numpy as np
import pytest
from pyspark.sql import types as T

from quern.llm import whitening
from quern.llm.q_whitening import op11_whitening

SCHEMA = "vec_id long, embedding array<double>, Whitened string"


def brute(rows):
    """{(id, place of the row): x} of usable rows, and the fit list's n, S, eigenvalues and vectors."""
    x = [(i, [int(np.floor(64 * c)) + 1_000_000 for c in v]) for i, v in rows]
    fit = np.array(sorted(set(map(tuple, (v for _, v in x)))), dtype=np.int64)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s) / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    return x, n, s, e[::-1], q[:, ::-1].T


def check(found, rows, most=16):
    x, n, s, e, q = brute(rows)
    kept = [k for k in range(min(most, len(e))) if e[k] > 1e-15 * e[0]]
    assert len(found) == len(x) * len(kept)
    assert all(r.n == n and r.identity_error < 1e-9 for r in found)
    by = {}
    for r in found:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    signs = {}
    for i, v in x:
        d = [n * a - int(b) for a, b in zip(v, s)]
        mine = by[(i, sum(t * t for t in d))]
        for k in kept:
            want = float(np.array(d) / n @ q[k] / np.sqrt(e[k]))
            r = min(mine[k + 1], key=lambda r: abs(abs(r.whitened) - abs(want)))
            assert abs(abs(r.whitened) - abs(want)) < 1e-7
            assert abs(r.explained - e[k] / e.sum()) < 1e-4 * e[k] / e.sum()
            if abs(want) > 1e-3:
                assert signs.setdefault(k, np.sign(want * r.whitened)) == np.sign(want * r.whitened)


def test_given_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(op11_whitening(spark, sf).collect(), rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    good = [(i, (rng.normal(size=6) * [9, 5, 3, 1, 1, 0]).tolist()) for i in range(60)]  # the last dimension is constant
    good += [(7, good[7][1])] * 40 + [(None, good[3][1]), (99, [600.0, -70.0, 3.0, 0.0, 1.0, 0.0])]
    odd = [(200, None), (201, []), (202, [1.0, None, 1, 1, 1, 1]), (203, [float("nan")] * 6), (204, [float("inf")] * 6), (205, [1.0]), (206, [1e300] * 6)]
    df = spark.createDataFrame([(i, v and [None if c is None else float(c) for c in v], "x") for i, v in good + odd], SCHEMA).repartition(5)
    found = whitening.whitened(df, "embedding", "vec_id").collect()
    check(found, good)
    assert len(found[0]) == 7


def test_equal_singular_values_and_low_rank(spark):
    corners = [(i, [float(2 * (i >> b & 1)) for b in range(4)] + [0.0]) for i in range(16)]  # all four directions alike
    found = whitening.whitened(spark.createDataFrame([(i, v, "") for i, v in corners], SCHEMA), "embedding", "vec_id").collect()
    assert len(found) == 16 * 4 and max(r.identity_error for r in found) < 1e-9
    assert all(abs(r.explained - 0.25) < 1e-9 for r in found)
    line = [(i, [float(i), 2.0 * i, -float(i)]) for i in range(9)]
    found = whitening.whitened(spark.createDataFrame([(i, v, "") for i, v in line], SCHEMA), "embedding", "vec_id").collect()
    assert len(found) == 9 and {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5, [(1, None)]])
def test_nothing_to_fit(spark, rows):
    df = spark.createDataFrame([(i, v, "") for i, v in rows], SCHEMA)
    found = whitening.whitened(df, "embedding", "vec_id")
    assert found.count() == 0 and found.schema["deviation"].dataType == T.LongType()


def test_exact_beyond_long():
    d = whitening.differences(np.array([[2**40, -(2**40)]]), 2**30, [5, -5])
    assert d.tolist() == [[2**70 - 5, 5 - 2**70]] and whitening.squared(d) == [None]
    d = whitening.differences(np.array([[3, -2]]), 10, [4, 4])
    assert whitening.squared(d) == [26**2 + 24**2]


def test_bidiagonal_against_svd():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(50, 12)) * np.geomspace(1, 1e-4, 12)
    right, small = whitening.bidiagonal(lambda w: (float((x @ w) @ (x @ w)), x.T @ (x @ w)), 12)
    assert np.abs(right.T @ right - np.eye(12)).max() < 1e-13
    assert np.allclose(np.linalg.svd(small)[1], np.linalg.svd(x)[1], rtol=1e-7)
    assert np.allclose(np.triu(np.tril(small, 1)), small)
