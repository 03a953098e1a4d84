import base64
import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from quern.llm import bpe, q_bpe

PATH = P.path(q_bpe.RANKS)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", None, "Hello, world!", "  two  spaces\n\n\nlines\t\x0b\x1c\x1f x y z", "a" * 5000, "<|endoftext|>", "Étrange œuvre — naïve façade 東京 🙂👩‍👩‍👧 İ", "1234567890 x2y3", "it's we'll I'd 've", "%%%***&&& $$$### " * 50, "\u0000�", "qxzjkvw" * 300, "Hello, world!"]


def test_coder_equals_library(reference):
    one = bpe.coder(bpe.read_ranks(PATH), P.PATTERN)
    rng = np.random.default_rng(1)
    more = ["".join(chr(c) for c in rng.choice([*range(32, 127), *range(192, 400), 0x4E00, 0x1F600, 10], 300)) for _ in range(60)]
    for text in [t or "" for t in TEXTS] + more:
        ids = np.frombuffer(one.encode(text), dtype="<u4").tolist()
        assert ids == reference.encode_ordinary(text)
        assert one.decode(np.array(ids, dtype="<u4").tobytes()) == text.encode()


def test_neighbours_stay_apart_as_the_merges_say():
    one = bpe.coder(bpe.read_ranks(PATH), P.PATTERN)
    one.build()
    rng = np.random.default_rng(2)
    tokens = list(one.halves)
    for k in rng.integers(0, len(tokens), 4_000):
        cut = int(rng.integers(1, len(tokens[k]) + 1))
        other = tokens[int(rng.integers(0, len(tokens)))]
        for a, b in ((tokens[k][:cut], tokens[k][cut:]), (tokens[k], other), (tokens[k][cut:] or "a", other)):
            if a in one.halves and b in one.halves:
                assert one.stays_apart(a, b) == (bpe.merged(a + b, one.ranks) == [a, b])


def test_operator_keeps_rows_and_other_columns(spark, reference):
    rows = [(i, t, "x", "clash") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `a.b` string, N_Tokens string")
    got = bpe.decode(bpe.encode(df, PATH), PATH).withColumn("array", bpe.id_array("token_ids"))
    assert set(got.columns) == {"doc_id", "text", "a.b", "token_ids", "n_tokens", "decoded", "array"}
    found = {r.doc_id: r for r in got.collect()}
    assert len(found) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        want = reference.encode_ordinary(t or "")
        assert found[i].array == want and found[i].n_tokens == len(want) and bytes(found[i].decoded) == (t or "").encode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).count() == 0


def test_query_equals_library(spark, sf, reference):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = q_bpe.op3_bpe(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = reference.encode_ordinary(docs[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
