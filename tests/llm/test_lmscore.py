import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import lmscore, q_lm


def tokens(text):
    return [w.lower() for w in (text or "").encode().split()] + [b"<end>"]


def plain(rows, learn):
    """(n_tokens, n_known, N, base) of each row, by counting."""
    c = Counter(t for k, x in rows if learn(k) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    return [(len(s := tokens(x)), sum(c[t] > 0 for t in s), n, sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in s)) for _, x in rows]


def test_query_against_counting(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    learn = lambda k: zlib.crc32(str(k).encode()) % 5 != 1
    want = dict(zip([k for k, _ in rows], plain(rows, learn), strict=True))
    got = q_lm.op7_lm_score(spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not learn(r.doc_id), *w[:3])
        assert r.base_score == pytest.approx(w[3], rel=1e-9) and r.score < 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_small_cases(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "CHUNK_BYTES", 200)
    rows = [(i, "the cat sat on the mat" if i % 2 else "The dog\x0bsat  on a mat") for i in range(60)] + [(60, None), (61, ""), (62, "zzz"), (63, "cat " * 30_000), (63, "cat " * 30_000), (None, "the cat")]
    df = spark.createDataFrame([(k, t, 1.0) for k, t in rows], "doc_id long, text string, Score double")
    got = lmscore.score(df, F.col("doc_id") < 60).collect()
    assert len(got) == 66
    want = plain(rows, lambda k: k is not None and k < 60)
    found = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got)
    assert found == sorted((a, b, n, round(s, 6)) for a, b, n, s in want)
    by = {r.doc_id: r for r in got}
    assert by[1].score > by[1].base_score and by[60].score == by[61].score and math.isfinite(by[62].score)


def interpolated(rows, learn, tune):
    """log10 probability of each row's text: counts in dictionaries, weights by expectation-maximisation over quantised estimates."""

    def counts(keep):
        words, pairs, contexts = Counter(), Counter(), Counter()
        for (k, x), on in zip(rows, keep, strict=True):
            if on:
                s = tokens(x)
                words.update(s)
                pairs.update(zip([None, *s[:-1]], s, strict=True))
                contexts.update([None, *s[:-1]])
        return words, pairs, contexts

    def estimates(text, words, pairs, contexts):
        n, s = sum(words.values()), tokens(text)
        for v, w in zip([None, *s[:-1]], s, strict=True):
            # the count of a context is that of the word, ends of texts aside
            yield int(math.log2(contexts[v] + 1)), pairs[v, w] / contexts[v] if contexts[v] else 0.0, words[w] / n

    step = lambda p: 2.0 ** -(round(-4 * math.log2(p)) / 4) if p else 0.0
    rest = counts([a and not b for a, b in zip(learn, tune, strict=True)])
    seen = [(b, step(two), step(one)) for (_, x), on in zip(rows, tune, strict=True) if on for b, two, one in estimates(x, *rest)]
    uniform = 1 / (len(rest[0]) + 1)

    def mixture(some, pair):
        l = [0.5, 0.4, 0.1] if pair else [0.0, 0.9, 0.1]  # noqa: E741
        for _ in range(60 if some else 0):
            new = [0.0] * 3
            for _, two, one in some:
                parts = [l[0] * two * pair, l[1] * one, l[2] * uniform]
                new = [a + p / sum(parts) for a, p in zip(new, parts, strict=True)]
            l = [max(a / len(some), 1e-6 * (i > 0 or pair)) for i, a in enumerate(new)]  # noqa: E741
            l = [a / sum(l) for a in l]  # noqa: E741
        return l

    mix = {b: mixture([r for r in seen if r[0] == b], b > 0) for b in {r[0] for r in seen}}
    overall, none = mixture(seen, True), mixture(seen, False)
    full = counts(learn)
    out = []
    for _, x in rows:
        total = 0.0
        for b, two, one in estimates(x, *full):
            l = mix.get(b, overall if b else none)  # noqa: E741
            total += math.log10(l[0] * two + l[1] * one + l[2] / (len(full[0]) + 1))
        out.append(total)
    return out


def test_score_against_plain_model(spark, monkeypatch):
    """Scores of whole texts against a model made by counting, weights included, whatever the chunks are."""
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(150):
        at, text = int(rng.integers(60)), []
        for _ in range(int(rng.integers(0, 40))):
            at = (at + 1) % 60 if rng.random() < 0.6 else int(60 * rng.random() ** 2)
            text.append(words[at])
        rows.append((k, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    flags = {r.doc_id: r.tune for r in df.select("doc_id", (F.pmod(F.xxhash64("doc_id", F.lit("tune")), F.lit(10)) == 0).alias("tune")).collect()}
    learn = [k % 5 != 1 for k, _ in rows]
    want = interpolated(rows, learn, [a and flags[k] for (k, _), a in zip(rows, learn, strict=True)])
    monkeypatch.setattr(lmscore, "CHUNK_BYTES", 2_000)
    got = {r.doc_id: r.score for r in lmscore.score(df, F.col("doc_id") % 5 != 1).collect()}
    assert [got[k] for k, _ in rows] == pytest.approx(want, rel=1e-6)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in lmscore.score(df, F.lit(False)).collect()} == {(1, 3, 0, 0.0, 0.0), (2, 1, 0, 0.0, 0.0)}
    assert lmscore.score(df.limit(0), F.lit(True)).count() == 0


def test_weights_find_the_mixture():
    """A bucket whose pair estimates are always right gets the pair's weight; one where they are 0, none."""
    mix = lmscore.weights([(5, 0, 40, 100.0), (2, 9999, 8, 100.0)], 1e-6)
    assert mix[5, 0] > 0.99 and mix[2, 1] > 0.99 and np.allclose(mix.sum(axis=1), 1)


def test_packing():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 5000, dtype=np.uint64))
    assert (lmscore.unpacked(lmscore.packed(keys)) == keys).all()
    assert (lmscore.unpacked_counts(lmscore.packed_counts(np.arange(300))) == np.arange(300)).all()
