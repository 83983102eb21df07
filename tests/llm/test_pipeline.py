import re

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from gristmill.llm import bpe, decontaminate, queries, toxicity
from gristmill.sources.staging import stage
from tests.llm.test_neardup import brute
from tests.llm.test_secrets import brute as brute_secrets

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, work in corpus_pipeline.STAGES:
        before, docs = docs, stage(work(spark, docs, SMALL), name)
        found.append((before, docs))
    return found


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_filters_match_plain_code(spark, steps):
    assert all(after.columns == before.columns for before, after in steps[:-1])
    (all_docs, calm), (_, single), (_, clean), _, _ = steps
    model = toxicity.fit(all_docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    scores = all_docs.select("doc_id", model.score(F.col("text")).alias("s")).collect()
    assert set(texts(calm)) == {r["doc_id"] for r in scores if r["s"] < 0.5}
    groups = brute(list(texts(calm).items()), 5)
    assert set(texts(single)) == {i for i, (_, c) in groups.items() if c == i}
    items = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rest = {i for i, t in texts(single).items() if not any(decontaminate.normal(x) in decontaminate.normal(t) for x in items)}
    assert set(texts(clean)) <= rest and len(texts(clean)) > 0.98 * len(rest)


def test_secrets_go_and_documents_stay(steps):
    before, after = texts(steps[3][0]), texts(steps[3][1])
    assert before.keys() == after.keys()
    for i, text in before.items():
        if not brute_secrets(text):
            assert after[i] == text
        else:
            assert not re.search("[0-9a-f]{24,}", after[i])


def test_last_stage_encodes_what_is_left(spark, steps):
    left, rows = texts(steps[3][1]), steps[4][1].collect()
    tokens = bpe.read_ranks(public_tokenizers.path(queries.BPE_RANKS))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    assert len(rows) == len(left)
    assert all(r["lossless"] and r["ids"] == own.encode_ordinary(left[r["doc_id"]]) for r in rows)


def test_odd_rows_pass_every_stage(spark, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "same words in both of these rows", "en", None, 5), (3, "same words in both of these rows", None, "s", 5), (3, "same words in both of these rows", None, "s", 5), (4, "w " * 60_000, "en", "s", 9)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for table, name in ((rows, "some"), ([], "none")):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(table, schema).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
        got = [r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()]
        assert sorted(got, key=str) == ([1, 2, 4, None] if table else [])
