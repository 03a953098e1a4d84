import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import ann, q_ann


def brute(rows, queries, k=10):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float64)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
        out[q] = [(int(ids[j]), d[j]) for j in np.lexsort((ids, d)) if ids[j] != q][:k]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(found) == set(want)
    for q, own in found.items():
        assert sorted(own) == list(range(1, len(want[q]) + 1))
        assert [own[i] for i in sorted(own)] == sorted(own.values(), key=lambda x: (x[1], x[0]))
    return np.mean([len({i for i, _ in want[q]} & {i for i, _ in found[q].values()}) / len(want[q]) for q in want])


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1"])
def test_query_recall(spark, name):
    d = f"/root/testdata/{name}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    got = q_ann.op2_nearest(spark, d).collect()
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert recall(got, want) >= 0.95
    exact = {(q, i): s for q, own in want.items() for i, s in own}
    assert all(exact.get((r.query_id, r.vec_id), r.score) == pytest.approx(r.score, rel=1e-12) for r in got)


def test_random_vectors_and_copies(spark, monkeypatch):
    """A third of the rows are one vector: ties by id, in lists that are dealt out."""
    monkeypatch.setattr(ann, "PART_ROWS", 100)
    monkeypatch.setattr(ann, "QUERY_ROWS", 7)
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(20, 16))
    rows = [(i, (centre[i % 20] + 0.3 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(2000)]
    rows += [(i, rows[7][1]) for i in range(2000, 3000)]
    got = ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") % 100 == 0).collect()
    want = brute(rows, [i for i, _ in rows if i % 100 == 0])
    assert recall(got, want) >= 0.9
    assert [r.vec_id for r in sorted((r for r in got if r.query_id == 2500), key=lambda r: r.rank)] == [7, *range(2000, 2009)]


def test_odd_rows(spark):
    bad = [(100, None), (200, [0.0, 0.0]), (300, [1.0, None]), (400, [1.0, float("nan")]), (500, [float("inf"), 1.0]), (600, []), (700, [1.0, 2.0, 3.0]), (None, [1.0, 1.0])]
    good = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [1.0, 3.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in bad + good], "vec_id long, embedding array<float>, label int, Rank string")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in ann.search(df, F.col("id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 2, 0.0), (0, 2, 1, 1.0), (0, 3, 3, 3.0)]
    assert ann.search(df.limit(0), F.col("id") % 100 == 0).count() == 0
    assert ann.search(df.where("vec_id = 0"), F.col("id") % 100 == 0).count() == 0


def test_graph_and_balance():
    x = np.random.default_rng(1).normal(size=(4000, 8))
    c = ann.balanced(x, 64)
    found = ann.Graph(c).nearest(x[:200], 16)
    true = np.sqrt(((x[:200, None] - c[None]) ** 2).sum(axis=2))
    assert (found.argmin(axis=1) == true.argmin(axis=1)).mean() > 0.98 and len(c) == 64
    assert np.isclose(found, true)[np.isfinite(found)].all()


@pytest.mark.parametrize(("clusters", "noise", "dims", "share"), [(200, 0.25, 32, 0.04), (20, 1.0, 6, 0.1)])
def test_ratio_selects_few_lists_of_clustered_vectors(clusters, noise, dims, share):
    """At 50,000 vectors with the query's parameters: recall against brute force, and the share of rows compared."""
    rng = np.random.default_rng(4)
    n, k = 50_000, 10
    x = rng.normal(size=(clusters, dims))[rng.integers(0, clusters, n)] * 2 + noise * rng.normal(size=(n, dims))
    graph = ann.Graph(ann.balanced(x[rng.choice(n, ann.SAMPLE, replace=False)], n // ann.LIST_ROWS))
    lists = [c for at in range(0, n, ann.BLOCK) for c in graph.lists_of(x[at : at + ann.BLOCK], 1.1, 4)]
    posted: dict[int, list[int]] = {}
    for i, own in enumerate(lists):
        for c in own:
            posted.setdefault(c, []).append(i)
    queries = np.arange(0, n, 250)
    hits, seen, most = 0, 0, 0
    for q, own in zip(queries, graph.lists_for(x[queries], 1.2, 8), strict=True):
        rows = np.unique(np.concatenate([posted.get(c, []) for c in own])).astype(int)
        true = ann.compared(np.array([q]), x[q : q + 1], np.arange(n), x, k)[1]
        hits, seen, most = hits + np.isin(true, rows).sum(), seen + len(rows), max(most, len(own))
    assert hits / (k * len(queries)) >= 0.95 and seen / n / len(queries) < share and max(map(len, lists)) <= 4
    assert most < len(graph.centroids) / 2


def test_compared_equals_plain_distances():
    rng = np.random.default_rng(3)
    x = rng.integers(-3, 4, size=(300, 3)).astype(float)
    x[5], x[6], x[7] = 1e200, -1e200, [1e200, 0, 0]
    ids = rng.permutation(300)
    a, b, c = ann.compared(ids[:40], x[:40], ids, x, 10)
    with np.errstate(all="ignore"):
        for i in range(40):
            d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
            want = [j for j in np.lexsort((ids, d)) if j != i][:10]
            assert b[a == ids[i]].tolist() == ids[want].tolist() and (c[a == ids[i]] == d[want]).all()
