import hashlib
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import q_secrets, secrets

HEX = hashlib.sha1(b"x").hexdigest()


def test_query_finds_the_planted_shape(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = {(k, m[1]) for k, t in docs.items() for m in re.finditer(r'token = "([0-9a-f]{40})"', t)}
    got = q_secrets.op8_secrets(spark, sf).where("is_secret").collect()
    assert want and want <= {(r.doc_id, docs[r.doc_id][r.start - 1 : r.start - 1 + r.length]) for r in got}
    for r in got:
        part = docs[r.doc_id][r.start - 1 : r.start - 1 + r.length]
        assert hashlib.sha256(part.encode()).hexdigest() == r.secret_sha256


@pytest.fixture(scope="module")
def docs(spark):
    filler = "the river house and garden stone music window table lamp"
    rows = [(i, filler, "x") for i in range(30)]
    rows += [
        (100, f'set token = "{HEX}" and go', "x"),
        (101, f"commit {HEX} fixed the garden", "x"),
        (102, "see the file garden/window/table2 or river_house_music3", None),
        (103, None, "x"),
        (104, "", "x"),
        (105, ("garden " * 30_000) + f"api_key='{HEX}'", "x"),
        (105, ("garden " * 30_000) + f"api_key='{HEX}'", "x"),
        (None, f"password: {HEX}", "x"),
        (106, f'token = "{HEX}" again token = "{HEX}"', "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, Score string").withColumn("n_chars", F.length("text").cast("long"))


def test_small_cases(docs):
    got = [(r.doc_id, r.is_secret) for r in secrets.scan(docs).collect()]
    assert sorted((k or 0) for k, on in got if on) == [0, 100, 105, 105, 106]
    assert {k for k, on in got if not on} <= {101, 102}


def test_redaction(docs):
    got = secrets.redacted(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    assert len(rows) == docs.count()
    text = {r.doc_id: r.text for r in rows}
    assert text[100] == 'set token = "[REDACTED]" and go' and HEX in text[101] and text[106].count("[REDACTED]") == 2 and text[103] is None
    assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)


def test_short_and_digit_free_runs_in_telling_places(spark):
    texts = ['password = "qZxkvWpTnbRw" end', "pwd=kqzxw8ptn end", "the qZxkvWpTnbRw alone", "password = garden", "x" * 400 + "1", "token: a b c", "api_key='" + "zQ" * 200 + "7'"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.secret) for r in secrets.findings(docs, "doc_id", "text").select(F.col("key").alias("doc_id"), F.col("candidate").alias("secret")).collect()}
    assert found == {(0, "qZxkvWpTnbRw"), (1, "kqzxw8ptn"), (4, texts[4]), (6, "zQ" * 200 + "7")}
    assert {r.doc_id for r in secrets.scan(docs).where("is_secret").collect()} >= {0}


def test_redaction_goes_by_place(spark):
    """A secret is not cut out of a longer run, and columns may have any names."""
    docs = spark.createDataFrame([(1, f'token = "{HEX}" file {HEX}zz', "a", "b"), (1, f'x token = "{HEX}"', "a", "b")], "doc_id long, text string, __key string, owner string")
    labelled = secrets.redacted(docs)
    assert labelled.columns == docs.columns
    got = sorted(r.text for r in labelled.collect())
    assert got[0].startswith('token = "[REDACTED]" file ') and "[REDACTED]zz" not in got[0] and got[1] == 'x token = "[REDACTED]"'


def test_labelled_findings_decide(spark, docs):
    labelled = spark.createDataFrame([(HEX, "commit ", " ", 1)] * 20 + [(HEX, 'token = "', '" ', 0)] * 20, "candidate string, before string, after string, label int")
    got = {r.doc_id: r.is_secret for r in secrets.scan(docs, labelled=labelled).collect()}
    assert got[101] and not got[100]


def test_held_out_findings(spark, docs):
    made = secrets.generated(spark, docs, "text", 3000).withColumn("words", F.lit(None).cast("long")).withColumn("k", F.xxhash64("candidate", "before"))
    rows = secrets.measured(made)
    model = secrets.train(rows.where("k % 3 = 0"))
    right = model.transform(rows.where("k % 3 <> 0")).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right > 0.9


def test_empty(spark, docs):
    assert secrets.scan(docs.limit(0)).count() == 0 and secrets.redacted(docs.limit(0)).count() == 0


def test_every_place_is_rated(spark):
    text = f'x{HEX} é commit {HEX} fixed the garden, set token = "{HEX}" and go'
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    labelled = spark.createDataFrame([(HEX, "fixed by commit ", " ", 0)] * 20 + [(HEX, 'set token = "', '" ', 1)] * 20, "candidate string, before string, after string, label int")
    got = sorted((r.start, r.is_secret) for r in secrets.occurrences(docs, labelled=labelled).where(F.col("secret") == HEX).collect())
    assert got == [(m.start() + 1, text[m.start() - 1] == '"') for m in re.finditer(rf"(?<!x){HEX}", text)]
    assert [r.is_secret for r in secrets.scan(docs, labelled=labelled).where(F.col("secret") == HEX).collect()] == [True]


def plain_findings(text):
    return [(m.start() + 1, m[0], text[max(0, m.start() - 40) : m.start()], text[m.end() : m.end() + 16]) for m in re.finditer(r"(?<![A-Za-z0-9_+/=\-])(?=[A-Za-z_+/=\-]*[0-9])[A-Za-z0-9_+/=\-]{16,}", text)]


def test_places_of_many_candidates(spark):
    """What is beside a candidate may be other candidates, and they may be many."""
    runs = [hashlib.sha256(str(i).encode()).hexdigest()[: 16 + i % 40] for i in range(9_000)]
    gaps = [" ", "\n", ", é ", " and then something longer than forty characters comes, "]
    texts = ["".join(r + gaps[i * 7 % 4] for i, r in enumerate(runs)), " ".join(runs[:3]), f"{runs[0]}", f"é{runs[1]}é {runs[2]} x"]
    texts = [re.sub(r"\b([a-z]{16,})\b", r"\g<1>7", t) for t in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in secrets.findings(docs, "doc_id", "text").collect():
        got.setdefault(r.key, []).append((r.start, r.candidate, r.before, r.after))
    assert {k: sorted(v) for k, v in got.items()} == {k: plain_findings(t) for k, t in enumerate(texts) if plain_findings(t)}


def test_time_and_memory_grow_with_the_text(spark):
    import time

    def seconds(n):
        docs = spark.range(1).select(F.lit(1).cast("long").alias("doc_id"), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.concat(F.lit("id "), F.md5(i.cast("string")))), " ").alias("text"))
        docs = docs.withColumn("text", F.concat("text", F.lit(f' token = "{HEX}"')))
        began = time.monotonic()
        found = secrets.findings(docs, "doc_id", "text").agg(F.count(F.lit(1)).alias("n"), F.max("start").alias("last"), F.sum("start").alias("all")).first()
        assert found.n >= n * 0.99 and found.last == n * 36 + 10
        return time.monotonic() - began

    seconds(1_000)
    small, large = seconds(20_000), seconds(100_000)
    assert large < 12 * max(small, 0.5)


def test_redaction_of_many_candidates(spark):
    n = 20_000
    text = " ".join(f"see {hashlib.md5(str(i).encode()).hexdigest()}" for i in range(n)) + f' token = "{HEX}" end'
    docs = spark.createDataFrame([(1, text), (1, text), (None, text), (2, "x")], "doc_id long, text string")
    got = sorted((r.text for r in secrets.redacted(docs).collect()), key=len)
    assert len(got) == 4 and got[0] == "x" and all(t.endswith('token = "[REDACTED]" end') for t in got[1:])
