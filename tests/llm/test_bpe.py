import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from gristmill.llm import bpe, queries

TEXTS = [
    None,
    "",
    " ",
    "a",
    "Hello  world\n\n  it's 12 o'clock \t end ",
    "one\ntwo three, four.\nfive",
    "\n \n x\r\ny z\x1c\x1dq \x85u",
    "ñandú über çà 東京 42 ² ½ 😀😀 ́x",
    "!!!!????####" * 5,
    "ab" * 2000 + "é" * 700,
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "same text",
    "same text",
]


@pytest.fixture(scope="module")
def vocabulary(spark):
    return bpe.Vocabulary(
        spark, public_tokenizers.path(queries.BPE_RANKS), public_tokenizers.PATTERN
    )


@pytest.fixture(scope="module")
def reference():
    tokens = bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS))
    return tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks={t: i for i, t in enumerate(tokens)},
        special_tokens={},
    )


def test_matches_the_library(spark, vocabulary, reference):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    rows = bpe.round_trip(docs.withColumn("ids", F.lit("clash")), vocabulary).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        text = row["text"] or ""
        assert row["bpe"]["ids"] == reference.encode_ordinary(text), text[:60]
        assert bytes(row["bpe"]["decoded"]) == text.encode()


def test_encode_then_decode(spark, vocabulary):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    back = docs.select("text", vocabulary.decode(vocabulary.encode(F.col("text"))).alias("b"))
    assert all(bytes(r["b"]).decode() == (r["text"] or "") for r in back.collect())


def test_empty_table(spark, vocabulary):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip(docs, vocabulary).collect() == []


def test_long_words_follow_the_same_rule(reference):
    tokens = bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS))
    rank = {t: i for i, t in enumerate(tokens)}
    for word in ("thestationing" * 60, "aaaa" * 300, "x1y2z3" * 200):
        want = [i for w in reference.encode_ordinary(word) for i in [w]]
        # Digits and letters are words of their own for the library, so compare one class only.
        if word.isalpha():
            assert bpe.contract_long(word.encode(), tokens, rank) == want


def test_query_on_documents(spark, reference):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op2_byte_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = reference.encode_ordinary(texts[row["doc_id"]])
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want = hashlib.sha256(texts[row["doc_id"]].encode()).hexdigest()
        assert row["decoded_sha256"] == want
