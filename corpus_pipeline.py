"""A training corpus out of ``documents``: five stages, each written and read again.

1. toxicity: documents with a score of 0.5 or more go;
2. near-duplicates: of each group of near copies the document with the least id stays;
3. decontamination: documents that hold a benchmark item go;
4. secrets: live-looking secrets are replaced by a mark, documents stay;
5. BPE: ids and their number are added, and whether decoding gives the text back.

All stages but the last return the columns they are given. NULL texts pass every
filter, as an empty text is neither toxic, nor a copy, nor a benchmark item. Rows
repeated under one id count as one document and stay together.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm import bpe, decontaminate, neardup, secrets, toxicity
from gristmill.llm.common import table
from gristmill.llm.queries import BPE_RANKS
from gristmill.sources.staging import stage


#: Rows per Arrow batch. Documents are long, and a task holds a batch and its results on
#: both sides; 10,000, Spark's own setting, are some 33 MB of text.
BATCH_ROWS = 2_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Pre-tokens a worker remembers. Workers live on into the next run's first stages, so
#: they hold less here than a job that only encodes.
MEMO = 120_000


def bounded_batches(spark: SparkSession) -> None:
    """Have the session send smaller batches to Python workers, for all stages of a run."""
    if not 0 < int(spark.conf.get(ARROW_ROWS)) <= BATCH_ROWS:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(model.score(F.col("text")) < 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    judged = neardup.near_duplicates(docs.select("doc_id", "text"))
    # Only the ids that go are joined; a short list is broadcast by the planner, which
    # knows its size, and texts are shuffled for a long one only.
    gone = stage(judged.where(~F.col("kept")).select("doc_id").distinct(), "copies")
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    vocabulary = bpe.Vocabulary(
        spark, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN, memo=MEMO
    )
    coded = bpe.round_trip(docs, vocabulary)
    plain = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("bpe.ids").cast("long").alias("n_tokens"),
        F.col("bpe.ids").alias("ids"),
        (F.col("bpe.decoded") == plain).alias("lossless"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_copies),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("bpe", encode),
]

# Models, sketches and merges are beyond SQL; the tests hold the rows against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
