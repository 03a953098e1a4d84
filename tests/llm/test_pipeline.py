import re

import pytest

import corpus_pipeline
from quern.llm import decontam, neardup
from quern.llm.words import Hashes


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage at sf0.01."""
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [{r.doc_id: r for r in docs.collect()}]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf), "test")
        out.append({r.doc_id: r for r in docs.collect()})
    return out


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "near-dedup", "decontamination", "secret scan", "tokenisation"]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(list(next(iter(s.values())).asDict()) == columns for s in stages[:-1])


def test_language_keeps_clean_documents(stages):
    assert set(stages[1]) >= {k for k, r in stages[0].items() if len(r.text) > 60}


def test_dedup_equals_brute_force(stages):
    hashes = Hashes()
    sets = {k: set(neardup.shingles(r.text, hashes, 5).tolist()) for k, r in stages[1].items()}
    up = {k: k for k in sets}

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            s, t = sets[a], sets[b]
            if s and t and min(len(s), len(t)) * 100 >= 80 * max(len(s), len(t)) and 100 * len(s & t) >= 80 * len(s | t):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    assert set(stages[2]) == {k for k in keys if top(k) == k}


def test_decontamination(spark, stages):
    items = [decontam.normalised(r.text) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    held = {k for k, r in stages[2].items() if any(x in decontam.normalised(r.text) for x in items)}
    assert held and not held & set(stages[3]) and len(stages[2]) - len(stages[3]) <= len(held) + 3


def test_secrets_and_tokens(stages):
    pattern = re.compile(r'token = "[0-9a-f]{40}"')
    assert set(stages[4]) == set(stages[3]) == set(stages[5])
    assert any(pattern.search(r.text) for r in stages[3].values()) and not any(pattern.search(r.text) for r in stages[4].values())
    assert all(r.text == stages[3][k].text for k, r in stages[4].items() if "[REDACTED]" not in r.text)
    assert all(r.round_trip and r.n_tokens * 4 == len(r.token_ids) for r in stages[5].values())


@pytest.mark.parametrize("ids", ["cast(null as long)", "5L", "id"])
def test_language_stage_whatever_the_ids(spark, ids):
    """Null, equal or repeated ids, and equal rows, leave the sample bounded and the clean documents in."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("length(text) > 200").limit(200)
    many = spark.range(40).crossJoin(docs.drop("doc_id")).selectExpr(f"{ids} as doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.known_language(spark, many, "")
    assert kept.columns == many.columns and kept.count() == many.count()


def test_stages_with_odd_rows(spark):
    sf = "/root/testdata/sf0.01"
    text = "The river house and the garden stand by the old stone bridge, and the music from the window is heard over the table. "
    long = " ".join(f"word{i} stands in the house by the river number" for i in range(40_000))
    rows = [(1, text * 2, "en"), (1, text * 2, "en"), (None, text * 3, None), (3, None, "en"), (4, "", "en"), (5, "12 34", "en"), (6, long, "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "y") for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long, Score string, owner string")
    out, counts = docs, []
    for _, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stored(stage(spark, out, sf), "test")
        counts.append(out.count())
        assert out.columns[: len(docs.columns)] == docs.columns
    assert counts[0] == 4 and counts[1] == counts[-1] and {r.doc_id for r in out.collect()} >= {1, 6}
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf)
        assert empty.count() == 0
