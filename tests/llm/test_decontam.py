import random

import pytest

from quern.llm import decontam, q_decontam


def plain(item, text):
    """Smallest edit distance of the item to a substring, by the full table."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (c != x), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def changed(text, n, rng):
    for _ in range(n):
        i = rng.randrange(len(text) + 1)
        text = rng.choice((text[:i] + text[i + 1 :], text[:i] + "q" + text[i:], text[:i] + "q" + text[i + 1 :]))
    return text


def test_myers_equals_table():
    rng = random.Random(1)
    for _ in range(200):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 150)))
        if rng.random() < 0.5:
            text = text[:40] + changed(item, 3, rng) + text[40:]
        d, end = decontam.myers(item, text)
        assert d == plain(item, text) and (d == len(item) or plain(item, text[:end]) == d)


@pytest.fixture(scope="module")
def case(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    item = [" ".join(word() for _ in range(20)) for _ in range(6)]
    docs = []
    for k in range(120):
        text = " ".join(word() for _ in range(60))
        if k % 4 == 0:
            text = text[:50] + " " + changed(item[k % 6], rng.randint(0, 14), rng) + " " + text[50:]
        docs.append((k, text))
    return item, docs


def test_against_plain_search(spark, case):
    item, docs = case
    want = {(k, i, d) for k, t in docs for i, x in enumerate(item) if (d := plain(decontam.normalised(x), decontam.normalised(t))) <= int(len(decontam.normalised(x)) * 0.08)}
    assert len(want) > 10
    df, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(item)), "item_id long, text string")
    for limit in (decontam.PASS_CHARS, 200):
        got = {(r.doc_id, h.item_id, h.distance) for r in decontam.find(df, items, limit=limit).collect() for h in r.hits}
        assert got == want
    assert {r.doc_id for r in decontam.clean(df, items).collect()} == {k for k, _ in docs} - {k for k, _, _ in want}


def test_odd_rows(spark, case):
    item, _ = case
    shouted = "%%% ".join(item[0].upper().split())
    rows = [(1, None, "x"), (2, "", "x"), (3, shouted, None), (3, shouted, None), (4, "ab " * 100_000 + item[1], "x"), (None, item[2] + item[2], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Hits string")
    items = spark.createDataFrame([(i, t) for i, t in enumerate(item)] + [(0, item[0]), (7, None), (8, ""), (9, "short"), (None, item[3])], "item_id long, text string")
    got = sorted(((r.doc_id or 0), [(h.item_id, h.distance) for h in r.hits]) for r in decontam.find(df, items).collect())
    assert got == [(0, [(2, 0)]), (1, []), (2, []), (3, [(0, 0)]), (3, [(0, 0)]), (4, [(1, 0)])]
    assert decontam.find(df.limit(0), items).count() == 0
    assert {len(r.hits) for r in decontam.find(df, items.limit(0)).collect()} == {0}


def test_query_finds_verbatim_items(spark, sf):
    docs, items = ([(r[0], decontam.normalised(r.text)) for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()] for t in ("documents", "benchmark"))
    want = {(k, i) for k, t in docs for i, x in items if x in t}
    assert want <= {(r.doc_id, r.item_id) for r in q_decontam.op4_decontaminate(spark, sf).collect()}


def test_short_items_as_whole_words(spark):
    items = spark.createDataFrame([(1, "Is it so?"), (2, "no"), (3, "?!")], "item_id long, text string")
    texts = ["Is it so", "I ask: is it so, or no", "this is it sober", "nobody", "No", "is it  so no no", ""]
    df = spark.createDataFrame([(k, t, "a", "b") for k, t in enumerate(texts)], "doc_id long, text string, hits string, __hits string")
    rows = decontam.find(df, items).collect()
    got = {r.doc_id: [(h.item_id, h.distance, h.end) for h in r.hits] for r in rows}
    want = {0: [(1, 0, 8)], 1: [(1, 0, 14), (2, 0, 20)], 2: [], 3: [], 4: [(2, 0, 2)], 5: [(1, 0, 8), (2, 0, 11)], 6: []}
    assert got == want and {r["__hits"] for r in rows} == {"b"}
    left = decontam.clean(df, items)
    assert left.columns == df.columns and sorted(r.doc_id for r in left.collect()) == [2, 3, 6]


def test_short_items_with_edits(spark):
    """The share of edits holds at every length: hits of items of 13 to 60 characters equal a search of all places."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8)))
    items = []
    while len(items) < 40:
        text = " ".join(word() for _ in range(rng.randint(3, 11)))
        if 13 <= len(text) <= 60:
            items.append((len(items), text))
    docs = [(k, " ".join([*(word() for _ in range(8)), changed(items[k % 40][1], rng.randint(0, 4), rng), *(word() for _ in range(8))])) for k in range(200)]
    want = {(k, i, d) for k, t in docs for i, x in items if (d := plain(x, decontam.normalised(t))) <= int(len(x) * 0.08)}
    by_budget = {min(3, int(len(items[i][1]) * 0.08)) for _, i, d in want if d}
    assert by_budget == {1, 2, 3}
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontam.find(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, h.item_id, h.distance) for r in got for h in r.hits} == want


def test_passes_leave_one_table(spark, case):
    import glob

    from quern.llm.common import shared_dir

    item, docs = case
    before = set(glob.glob(f"{shared_dir(spark)}/quern-hits-*"))
    got = decontam.find(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(list(enumerate(item)), "item_id long, text string"), limit=1)
    assert got.count() == len(docs) and len(set(glob.glob(f"{shared_dir(spark)}/quern-hits-*")) - before) == 1
