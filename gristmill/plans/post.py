"""Last stage: enriched documents in, partitioned corpus and rule counts out."""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.paths import base_name, cut_of, literal_path
from gristmill.operators.postfilter import PostRules, corpus_rows, tag_post
from gristmill.sources.corpus import write_corpus
from gristmill.sources.enriched import is_result_file, read_enriched
from gristmill.sources.ledger import landed, mark_landed
from gristmill.sources.listing import list_files, path_batches

REASONS = (
    "missing_field",
    "perplexity",
    "few_lines",
    "line_loss",
    "language_score",
    "short_text",
    "low_ink",
    "repetitive",
)


def observe_funnel(tagged: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows per reason in passing, without a second scan."""
    seen = Observation()
    counts = [F.count_if(F.col("reason") == r).alias(r) for r in REASONS]
    return tagged.observe(seen, F.count_if(F.col("reason").isNull()).alias("kept"), *counts), seen


def pending_files(spark: SparkSession, data: str, out: str, glob: str = "*.wet") -> DataFrame:
    """Result files that are not in the ledger yet, told apart by cut and file name.

    A cut that is half done is resumed: only its finished files are skipped, and what
    an unfinished one left is in no commit, so nobody reads it.
    """
    files = list_files(spark, data, glob).where(is_result_file(F.col("path")))
    keyed = files.withColumn(
        "_key", F.concat_ws("/", cut_of(F.col("path")), base_name(F.col("path")))
    )
    done = landed(spark, out).select(F.col("path").alias("_key"))
    return keyed.join(done, "_key", "left_anti").select("path")


def run_post(
    spark: SparkSession,
    data: str,
    out: str,
    rules: PostRules = PostRules(),
    strict: bool = False,
    batch_files: int = 10_000,
    glob: str = "*.wet",
) -> dict[str, int]:
    """Filter every pending result file and write the corpus; returns rows per reason."""
    counts: Counter[str] = Counter()
    for paths in path_batches(pending_files(spark, data, out, glob), batch_files):
        counts.update(land_results(spark, paths, out, rules, strict, glob))
    return dict(counts)


def land_results(
    spark: SparkSession,
    paths: list[str],
    out: str,
    rules: PostRules = PostRules(),
    strict: bool = False,
    glob: str = "*.wet",
) -> dict[str, int]:
    """Filter some result files, write their rows as one commit and enter it; rows per reason."""
    given = read_enriched(spark, [literal_path(p) for p in paths], glob=glob)
    tagged, seen = observe_funnel(tag_post(given, rules, strict))
    kept = tagged.where("reason IS NULL")
    commit = f"c-{uuid.uuid4().hex}"
    write_corpus(corpus_rows(kept, "cut", "file"), out, commit=commit)
    names = spark.createDataFrame([(p,) for p in paths], "file string")
    key = F.concat_ws("/", cut_of(F.col("file")), base_name(F.col("file")))
    mark_landed(names.select(key.alias("path")), out, commit)
    return seen.get
