"""Final rules and the corpus, on documents with stand-in second-stage columns.

Language scores and perplexities come from outside in real use. Here they are
arithmetic on ids and lengths, so that every rule meets rows on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.catalog.common import WS, sql_words, table
from gristmill.functions.text import lines
from gristmill.operators.postfilter import (
    PostRules,
    corpus_rows as project_corpus,
    ink_share,
    keep_post,
    repetition,
    tag_post,
)
from gristmill.operators.reasons import funnel
from gristmill.plans.post import REASONS, land_results, observe_funnel, pending_files, run_post
from gristmill.sources.staging import new_folder
from gristmill.sources.corpus import read_corpus, write_corpus
from gristmill.sources.enriched import read_enriched


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    nlines = F.size(lines(F.col("text")))
    doc_id, n = F.col("doc_id"), F.col("n_chars")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(doc_id % 50 != 7, F.concat(F.lit("title "), doc_id)).alias("title"),
        F.col("text").alias("raw_content"),
        n.alias("length"),
        nlines.alias("nlines"),
        F.col("lang").alias("language"),
        (doc_id * 37 % 100 / 100.0 + 0.25).alias("language_score"),
        (nlines * (1 + doc_id % 7)).cast("int").alias("original_nlines"),
        (n * 7919 % 2000).cast("double").alias("perplexity"),
        (n * 2).alias("original_length"),
        F.col("source").alias("cut"),
    )


ENRICHED = """(SELECT doc_id, CASE WHEN doc_id % 50 <> 7 THEN 'title ' || doc_id END AS title,
    text AS raw_content, n_chars AS length, len(string_split(text, chr(10))) AS nlines,
    lang AS language, (doc_id * 37 % 100)::DOUBLE / 100.0 + 0.25 AS language_score,
    len(string_split(text, chr(10))) * (1 + doc_id % 7) AS original_nlines,
    (n_chars * 7919 % 2000)::DOUBLE AS perplexity, n_chars * 2 AS original_length, source AS cut
  FROM documents) AS e"""

INK = f"length(translate(raw_content, {WS}, ''))::DOUBLE / length"
REPETITION = f"""length(raw_content)::DOUBLE
    / list_sum(list_transform(list_distinct({sql_words('raw_content')}), lambda w: length(w)))"""


def sql_reason(perplexity=1000, below=500, nlines=3, loss=5, score=0.6, length=256, ink=0.8, rep=2.5):
    return f"""CASE WHEN title IS NULL THEN 'missing_field'
      WHEN perplexity > {perplexity} AND length < {below} THEN 'perplexity'
      WHEN nlines < {nlines} THEN 'few_lines'
      WHEN original_nlines::DOUBLE / nlines > {loss} THEN 'line_loss'
      WHEN language_score < {score} THEN 'language_score'
      WHEN length < {length} THEN 'short_text'
      WHEN {INK} < {ink} THEN 'low_ink'
      WHEN {REPETITION} > {rep} THEN 'repetitive' END"""


def post_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tag_post(enriched(spark, sf_dir)).select("doc_id", "reason")


def post_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(tag_post(enriched(spark, sf_dir)))


TIGHT = PostRules(
    max_perplexity=600,
    perplexity_below_length=2000,
    min_nlines=4,
    max_line_loss=6,
    min_language_score=0.3,
    min_length=300,
    min_ink_share=0.83,
    max_repetition=1.8,
)


def post_funnel_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(tag_post(enriched(spark, sf_dir), TIGHT))


def post_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("raw_content")
    return enriched(spark, sf_dir).select(
        "doc_id",
        F.round(ink_share(text, F.col("length")), 6).alias("ink_share"),
        F.round(repetition(text), 6).alias("repetition"),
    )


def corpus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corpus rows of texts that start with a byte order mark."""
    marked = enriched(spark, sf_dir).withColumn(
        "raw_content", F.concat(F.lit("﻿"), "raw_content")
    )
    return project_corpus(keep_post(marked), "doc_id")


def corpus_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the corpus by cut, read it back, count per cut and language."""
    out = new_folder(spark, "corpus")
    write_corpus(project_corpus(keep_post(enriched(spark, sf_dir)), "cut"), out)
    return read_corpus(spark, out).groupBy("cut", "language").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars")
    )


def post_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage in three runs, with rows of one that was broken off in between.

    Every result file lands once: rows per cut, file language and language of the corpus.
    """
    folder, out = new_folder(spark, "enriched"), new_folder(spark, "corpus")
    # Several files in each cut, told apart by their names there.
    rows = enriched(spark, sf_dir).withColumn("shard", F.lit("s")).repartition(5, "doc_id")
    rows.drop("doc_id").write.partitionBy("cut", "shard").json(f"{folder}/res")
    paths = sorted(r["path"] for r in pending_files(spark, folder, out, "*.json").collect())
    # A run that stops before its entry leaves rows, here even such as no rule lets through.
    left = read_enriched(spark, paths[::3], glob="*.json")
    write_corpus(project_corpus(left, "cut", "file"), out, commit="c-broken-off")
    land_results(spark, paths[::2], out, glob="*.json")
    for _ in range(2):
        run_post(spark, folder, out, glob="*.json", batch_files=1 + len(paths) // 3)
    kept = read_corpus(spark, out)
    return kept.groupBy("cut", "language").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("n_chars")
    )


def post_funnel_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts taken in passing while the corpus is written."""
    tagged, seen = observe_funnel(tag_post(enriched(spark, sf_dir)))
    kept = project_corpus(tagged.where("reason IS NULL"), "cut")
    write_corpus(kept, new_folder(spark, "corpus"))
    counts = seen.get
    rows = [(r, int(counts[r])) for r in ("kept", *REASONS)]
    return spark.createDataFrame(rows, "reason string, n bigint")


def enriched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched rows as JSON lines by cut and shard, read back and counted per reason."""
    folder = new_folder(spark, "enriched")
    rows = enriched(spark, sf_dir).withColumn("shard", F.col("language")).drop("doc_id")
    for part in ("res", "res/hashes"):
        rows.write.mode("append").partitionBy("cut", "shard").json(f"{folder}/{part}")
    tagged = tag_post(read_enriched(spark, folder, glob="*.json"))
    return tagged.groupBy("cut", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


QUERIES = {
    "post_reason": post_reason,
    "post_funnel": post_funnel,
    "post_funnel_tight": post_funnel_tight,
    "post_funnel_observed": post_funnel_observed,
    "post_measures": post_measures,
    "corpus_rows": corpus_rows,
    "corpus_partitions": corpus_partitions,
    "enriched_files": enriched_files,
    "post_resume": post_resume,
}

KEPT = f"(SELECT * FROM {ENRICHED} WHERE {sql_reason()} IS NULL) AS k"
# The byte order mark adds one character to the text but none to the column.
MARKED = ENRICHED.replace("text AS raw_content", "chr(65279) || text AS raw_content")
ALL_REASONS = ", ".join(f"('{r}')" for r in ("kept", *REASONS))


def _funnel(reason: str) -> str:
    return f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n
        FROM (SELECT {reason} AS reason FROM {ENRICHED}) AS r GROUP BY ALL"""


SQL = {
    "post_reason": f"SELECT doc_id, {sql_reason()} AS reason FROM {ENRICHED}",
    "post_funnel": _funnel(sql_reason()),
    "post_funnel_tight": _funnel(sql_reason(600, 2000, 4, 6, 0.3, 300, 0.83, 1.8)),
    "post_funnel_observed": f"""SELECT a.reason, coalesce(f.n, 0)::BIGINT AS n
        FROM (VALUES {ALL_REASONS}) AS a(reason) LEFT JOIN ({_funnel(sql_reason())}) AS f
        ON f.reason = a.reason""",
    "post_measures": f"""SELECT doc_id, round({INK}, 6) AS ink_share,
        round({REPETITION}, 6) AS repetition FROM {ENRICHED}""",
    "corpus_rows": f"""SELECT 'CommonCrawl' AS source, replace(raw_content, chr(65279), '') AS text,
        language, doc_id FROM {MARKED} WHERE {sql_reason()} IS NULL""",
    "corpus_partitions": f"""SELECT cut, language, count(*) AS n,
        sum(length(raw_content))::BIGINT AS n_chars FROM {KEPT} GROUP BY cut, language""",
    "post_resume": f"""SELECT 'cut=' || cut AS cut, language, count(*) AS n,
        sum(length(raw_content))::BIGINT AS n_chars FROM {KEPT} GROUP BY cut, language""",
    "enriched_files": f"""SELECT 'cut=' || cut AS cut, coalesce(reason, 'kept') AS reason, count(*) AS n
        FROM (SELECT cut, {sql_reason()} AS reason FROM {ENRICHED}) AS r GROUP BY ALL""",
}
