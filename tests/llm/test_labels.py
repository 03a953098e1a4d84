import pytest
from pyspark.sql import functions as F

from quern.llm import langid, q_labels, toxicity

WORDS = {"en": "the house and with that river through thing", "de": "das haus und mit der nicht schön über", "fr": "la maison et avec que été où ça", "es": "la casa y con que niño mañana está"}


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i * 4 + k, " ".join(w.split()[(i + j) % 8] for j in range(12)), lang, "x") for i in range(40) for k, (lang, w) in enumerate(WORDS.items())]
    odd = [(1000, None, "en", None), (1001, "", None, "x"), (1002, "123 %%% !!", "fr", "x"), (1003, "the house and " * 50_000, None, "x"), (1003, "the house and " * 50_000, None, "x"), (None, "das haus und nicht", None, None)]
    return spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, SCORE string")


def test_language_small(small):
    got = langid.identify(small).collect()
    assert len(got) == 166
    found = {r.doc_id: r for r in got}
    assert all(found[i].lang_pred == found[i].lang for i in range(160))
    assert [found[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3 and found[1003].lang_pred == "en" and found[None].lang_pred == "de"
    assert all(0 <= r.score <= 1 for r in got)


def test_language_without_rows(spark, small):
    assert langid.identify(small.limit(0)).count() == 0
    assert {r.lang_pred for r in langid.identify(small, F.lit(False)).collect()} == {"und"}


def test_one_language(small):
    got = langid.identify(small.where("lang = 'en'")).where("doc_id < 1000").select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in got] == ["en"]


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = q_labels.op6_language(spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.97


def test_toxicity_small(spark):
    calm = "river house garden stone music window table green".split()
    rows = [(i, " ".join(calm[(i * 3 + j) % 8] for j in range(6)) + (" idiot" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(300)]
    odd = [(900, None, None), (901, "", 1), (902, "idiot " * 100_000, None), (902, "idiot " * 100_000, None)]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t, _ in rows + odd], "doc_id long, text string, Score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows + odd] + [(None, 1), (3, 1)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
    assert len(got) == 304
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id < 900:
            assert (r.score >= 0.7) == (r.doc_id % 3 == 0)
    assert toxicity.score(docs, toxicity.fit(docs, labels.limit(0))).count() == 304
    assert toxicity.score(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_pairs_count():
    """Only both terms together are toxic: additive weights cannot tell, the products can."""
    import numpy as np

    rng = np.random.default_rng(0)
    rows, label = [], []
    for _ in range(3000):
        a, b = rng.integers(2, size=2)
        rows.append(np.array([x for x, on in ((10, a), (20, b), (30, True)) if on], dtype=np.int32))
        label.append(float(a and b))
    m = toxicity.train(rows, np.array(label), rounds=400)
    on = lambda *t: m.score([m.index[x] for x in t if x in m.index])
    assert on(10, 20, 30) > 0.7 and max(on(10, 30), on(20, 30), on(30)) < 0.3


def test_pairs_without_margins():
    """Exactly one of two terms is toxic: each alone says nothing, so only the pair can bring them in. A hundred others are noise."""
    import numpy as np

    rng = np.random.default_rng(1)
    rows, label = [], []
    for _ in range(4000):
        a, b = rng.integers(2, size=2)
        noise = 100 + np.flatnonzero(rng.random(100) < 0.2)
        rows.append(np.array([*(x for x, on in ((10, a), (20, b)) if on), *noise], dtype=np.int32))
        label.append(float(a != b))
    assert not len(np.intersect1d(toxicity.choose(rows, np.array(label), 20_000, 3), [10, 20]))
    m = toxicity.train(rows, np.array(label), rounds=400)
    right = [(m.score([m.index[x] for x in r if x in m.index]) >= 0.7) == bool(y) for r, y in zip(rows, label, strict=True)]
    assert np.mean(right) > 0.99 and {10, 20} <= set(m.index) and len(m.index) < 10


def test_pairs_of_noise_are_not_chosen():
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [np.flatnonzero(rng.random(300) < 0.3).astype(np.int32) for _ in range(3000)]
    label = (rng.random(3000) < 0.1).astype(float)
    assert len(toxicity.paired(rows, label, np.zeros(0, dtype=int), 1500)) == 0


def test_score_is_the_sum_over_pairs(spark):
    """Scores of whole texts against the machine's definition, pair by pair."""
    import numpy as np

    rng = np.random.default_rng(3)
    words = "river house idiot stone musically window tables greenish".split()
    chosen = np.unique([t for w in words[:6] for t in toxicity.terms_of(w)])
    m = toxicity.Machine(chosen, -0.3, rng.normal(0, 1, len(chosen)), rng.normal(0, 1, (len(chosen), 4)))
    texts = [" ".join(rng.choice(words, rng.integers(0, 6))) for _ in range(60)] + ["", None, "RIVER, river: Musical!"]
    got = toxicity.score(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), m).collect()
    for r in got:
        has = sorted({t for w in toxicity.WORD((texts[r.doc_id] or "").lower()) for t in toxicity.terms_of(w)} & set(chosen.tolist()))
        at = [m.index[t] for t in has]
        y = m.bias + sum(m.weights[i] for i in at) + sum(float(m.vectors[i] @ m.vectors[j]) for i in at for j in at if i < j)
        assert r.score == pytest.approx(1 / (1 + np.exp(-y)), rel=1e-9)


def test_language_is_the_vote_of_pairs(small, spark):
    """Predictions against a plain count of pairs won, family first."""
    tree = langid.fit(small)
    texts = [r.text for r in small.collect()] + ["casa the mit que", "schön and y avec", "über"]
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "n int, text string"), tree).collect()

    def winner(x, names, machines):
        margin = {}
        for (a, b), w in machines.items():
            if a in names and b in names:
                margin[a, b] = float(x @ w[:-1] + w[-1])
                margin[b, a] = -margin[a, b]
        won = {a: sum(m >= 0 for (f, _), m in margin.items() if f == a) for a in names}
        return max(names, key=lambda a: won[a]), sorted(won.values())[-2:]

    for r in got:
        if not texts[r.n] or not langid.LETTER(texts[r.n]):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        x = langid.features(texts[r.n])
        family, votes = winner(x, tree.families, tree.top)
        lang, inner = winner(x, tree.languages[family], tree.within)
        if len(set(votes)) == len(votes) and (len(tree.languages[family]) == 1 or len(set(inner)) == len(inner)):
            assert r.lang_pred == lang


def test_toxicity_held_out(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = q_labels.op5_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in got}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.75 and n[1, 1] / (n[1, 1] + n.get((0, 1), 0)) > 0.95
