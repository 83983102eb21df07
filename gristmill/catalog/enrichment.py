"""Second stage over ``documents``, and all stages together without stand-in columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.catalog.common import DEMO_WORDS, sql_clean, sql_passage_reason, sql_paragraphs, sql_strip, sql_words, table
from gristmill.catalog.corpus import sql_reason
from gristmill.operators import enrich, ngrams
from gristmill.operators.postfilter import tag_post
from gristmill.operators.reasons import funnel
from gristmill.plans.coarse import clean_rows
from gristmill.sources.staging import new_folder, stage


def paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return enrich.dedup_paragraphs(docs, "doc_id", "text")


def paragraph_dedup_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in three increments by id, the second of them run twice."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    state = new_folder(spark, "paragraphs")
    last = docs.agg(F.max("doc_id")).first()[0] or 0
    parts = [docs.where(F.floor(F.col("doc_id") * 3 / (last + 1)) == i) for i in range(3)]
    kept = [
        stage(enrich.dedup_increment(parts[i], state, f"{i}", "doc_id", "text"), "increment")
        for i in (0, 1, 1, 2)
    ]
    return kept[0].unionByName(kept[2]).unionByName(kept[3])


def language_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    scored = enrich.language_score(docs, enrich.language_profiles(docs))
    return scored.withColumn("language_score", F.round("language_score", 6))


def unigram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return enrich.unigram_perplexity(docs).select(
        "doc_id", F.round("perplexity", 4).alias("perplexity")
    )


def ngram_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents under the trigram model of their language."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    scored = ngrams.ngram_perplexity(docs, ngrams.fit_ngrams(docs))
    return scored.select("doc_id", F.round("perplexity", 4).alias("perplexity"))


def ngram_perplexity_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations, with n-grams never seen, under the model of all documents."""
    docs = table(spark, sf_dir, "documents").select(F.lit("all").alias("lang"), "text")
    turns = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), F.lit("all").alias("lang"), "text"
    )
    scored = ngrams.ngram_perplexity(turns, ngrams.fit_ngrams(docs), "turn_id")
    return scored.select("turn_id", F.round("perplexity", 3).alias("perplexity"))


def _enriched(docs: DataFrame) -> DataFrame:
    """Deduplicated documents with the columns of the final rules."""
    # Profiles, scores, perplexity and rows all read the texts that stay.
    unique = stage(enrich.dedup_paragraphs(docs, "doc_id", "raw_content"), "unique")
    scores = enrich.language_score(
        unique, enrich.language_profiles(unique, "lang", "raw_content"), "doc_id", "raw_content"
    )
    perplexity = enrich.unigram_perplexity(unique, "doc_id", "raw_content", "lang")
    return (
        unique.withColumn("title", F.concat(F.lit("title "), "doc_id"))
        .join(scores, "doc_id")
        .join(perplexity, "doc_id", "left")
    )


def post_funnel_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final rules on deduplicated, scored documents."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.col("text").alias("raw_content")
    )
    return funnel(tag_post(_enriched(docs)))


def pipeline_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse cleaning, deduplication, scores and final rules in a row."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.col("text").alias("raw_content")
    )
    cleaned = clean_rows(docs, DEMO_WORDS).select("doc_id", "lang", "raw_content")
    tagged = tag_post(_enriched(cleaned))
    return tagged.select("doc_id", "nlines", "length", "language", "reason")


QUERIES = {
    "paragraph_dedup": paragraph_dedup,
    "paragraph_dedup_increments": paragraph_dedup_increments,
    "language_score": language_score,
    "unigram_perplexity": unigram_perplexity,
    "ngram_perplexity": ngram_perplexity,
    "ngram_perplexity_turns": ngram_perplexity_turns,
    "post_funnel_dedup": post_funnel_dedup,
    "pipeline_full": pipeline_full,
}


def _dedup(source: str, text: str, keys: str) -> str:
    return f"""SELECT {keys}, len(ps) AS original_nlines, length({text}) AS original_length,
        coalesce(n, 0) AS nlines, length(coalesce(t, ''))::BIGINT AS length, coalesce(t, '') AS {text}
      FROM (SELECT *, {sql_paragraphs(text)} AS ps FROM {source}) AS d
      LEFT JOIN (
        SELECT k, count(*)::INTEGER AS n, string_agg(p, chr(10) ORDER BY pos) AS t FROM (
          SELECT k, pos, p, row_number() OVER (PARTITION BY md5({sql_strip('lower(p)')}) ORDER BY k, pos) AS r
          FROM (SELECT doc_id AS k, unnest(ps) AS p, generate_subscripts(ps, 1) AS pos
                FROM (SELECT doc_id, {sql_paragraphs(text)} AS ps FROM {source}) AS a) AS b) AS c
        WHERE r = 1 GROUP BY k) AS f ON f.k = d.doc_id"""


def _scores(source: str, text: str) -> str:
    tokens = f"(SELECT doc_id, lang, unnest({sql_words(f'lower({text})')}) AS word FROM {source})"
    return f"""WITH tokens AS {tokens},
      profile AS (SELECT lang, word FROM (
        SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS r
        FROM tokens GROUP BY lang, word) AS x WHERE r <= {enrich.PROFILE_WORDS}),
      found AS (SELECT doc_id, p.lang, count(*) AS n FROM tokens JOIN profile AS p USING (word)
                GROUP BY doc_id, p.lang),
      best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, lang) AS r
               FROM found) AS x WHERE r = 1)
      SELECT d.doc_id, best.lang AS language,
             coalesce(n::DOUBLE / nullif((SELECT count(*) FROM tokens AS t WHERE t.doc_id = d.doc_id), 0), 0)
               AS language_score
      FROM {source} AS d LEFT JOIN best USING (doc_id)"""


def _perplexity(source: str, text: str) -> str:
    tokens = f"(SELECT doc_id, lang, unnest({sql_words(f'lower({text})')}) AS word FROM {source})"
    return f"""WITH tokens AS {tokens},
      c AS (SELECT lang, word, count(*) AS c FROM tokens GROUP BY lang, word),
      s AS (SELECT lang, sum(c) AS total, count(*) AS v FROM c GROUP BY lang)
      SELECT doc_id, exp(-avg(ln((c + 1)::DOUBLE / (total + v)::DOUBLE))) AS perplexity
      FROM tokens JOIN c USING (lang, word) JOIN s USING (lang) GROUP BY doc_id"""


def _grams(source: str, key: str, text: str, by: str) -> str:
    return f"""SELECT k, b, w, coalesce(lag(w, 1) OVER o, '') AS v, coalesce(lag(w, 2) OVER o, '') AS u
      FROM (SELECT k, b, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
            FROM (SELECT {key} AS k, {by} AS b, {sql_words(f'lower({text})')} AS ws FROM {source}) AS a) AS c
      WINDOW o AS (PARTITION BY k ORDER BY i)"""


def _trigrams(fit: str, scored: str, name: str, digits: int) -> str:
    """Perplexity of the scored rows under the trigram model of the fitted ones."""

    def share(c: str, s: str, d: str) -> str:
        return f"""CASE WHEN {s}.total IS NULL THEN p
          ELSE (greatest(coalesce({c}.c, 0) - {d}, 0) + {d} * {s}.types * p) / {s}.total END"""

    def discount(i: int) -> str:
        once, twice = (f"count(*) FILTER (c = {n})" for n in (1, 2))
        return f"""d{i} AS (SELECT b, coalesce({once}::DOUBLE / nullif({once} + 2 * {twice}, 0), 0) AS d
          FROM c{i} GROUP BY b)"""

    return f"""WITH f AS ({fit}), g AS ({scored}),
      c3 AS (SELECT b, u, v, w, count(*) AS c FROM f GROUP BY ALL),
      c2 AS (SELECT b, v, w, count(*) AS c FROM c3 GROUP BY ALL),
      c1 AS (SELECT b, w, count(*) AS c FROM c2 GROUP BY ALL),
      s3 AS (SELECT b, u, v, sum(c)::DOUBLE AS total, count(*) AS types FROM c3 GROUP BY ALL),
      s2 AS (SELECT b, v, sum(c)::DOUBLE AS total, count(*) AS types FROM c2 GROUP BY ALL),
      s1 AS (SELECT b, sum(c)::DOUBLE AS total, count(*) AS types FROM c1 GROUP BY ALL),
      {discount(1)}, {discount(2)}, {discount(3)},
      p1 AS (SELECT g.*, (greatest(coalesce(c1.c, 0) - d1.d, 0) + d1.d * s1.types / (s1.types + 1)) / s1.total AS p,
                    d2.d AS e2, d3.d AS e3
             FROM g JOIN s1 USING (b) JOIN d1 USING (b) JOIN d2 USING (b) JOIN d3 USING (b) LEFT JOIN c1 USING (b, w)),
      p2 AS (SELECT p1.* REPLACE ({share('c2', 's2', 'e2')} AS p)
             FROM p1 LEFT JOIN c2 USING (b, v, w) LEFT JOIN s2 USING (b, v)),
      p3 AS (SELECT p2.* REPLACE ({share('c3', 's3', 'e3')} AS p)
             FROM p2 LEFT JOIN c3 USING (b, u, v, w) LEFT JOIN s3 USING (b, u, v))
      SELECT k AS {name}, round(exp(-avg(ln(p))), {digits}) AS perplexity FROM p3 GROUP BY k"""


def _all(source: str) -> str:
    """Deduplicated rows with scores, as CTEs ``u`` and ``e``."""
    return f"""WITH u AS MATERIALIZED ({_dedup(source, 'raw_content', 'doc_id, lang')}),
      l AS MATERIALIZED ({_scores('u', 'raw_content')}),
      q AS MATERIALIZED ({_perplexity('u', 'raw_content')}),
      e AS MATERIALIZED (SELECT u.*, 'title ' || u.doc_id AS title, l.language, l.language_score, q.perplexity
        FROM u JOIN l USING (doc_id) LEFT JOIN q USING (doc_id))"""


# A missing perplexity, language or title is a reason of its own.
FINAL = sql_reason().replace(
    "title IS NULL", "title IS NULL OR perplexity IS NULL OR language IS NULL"
)
DOCS = "(SELECT doc_id, lang, text AS raw_content FROM documents)"
PASSED = f"""(SELECT doc_id, lang, text FROM (SELECT *, {sql_paragraphs('text')} AS ps FROM documents) AS d
    WHERE {sql_passage_reason()} IS NULL) AS s"""
CLEANED = f"(SELECT doc_id, lang, text AS raw_content FROM ({sql_clean(PASSED, 'doc_id, lang')}) AS z)"

SQL = {
    "paragraph_dedup": _dedup("documents", "text", "doc_id"),
    "paragraph_dedup_increments": _dedup("documents", "text", "doc_id"),
    "language_score": f"""SELECT doc_id, language, round(language_score, 6) AS language_score
        FROM ({_scores('documents', 'text')}) AS x""",
    "unigram_perplexity": f"""SELECT doc_id, round(perplexity, 4) AS perplexity
        FROM ({_perplexity('documents', 'text')}) AS x""",
    "ngram_perplexity": _trigrams(
        _grams("documents", "doc_id", "text", "lang"), _grams("documents", "doc_id", "text", "lang"), "doc_id", 4
    ),
    "ngram_perplexity_turns": _trigrams(
        _grams("documents", "doc_id", "text", "'all'"),
        _grams("conversations", "conv_id * 1000 + turn", "text", "'all'"),
        "turn_id",
        3,
    ),
    "post_funnel_dedup": f"""{_all(DOCS)} SELECT coalesce(reason, 'kept') AS reason, count(*) AS n
        FROM (SELECT {FINAL} AS reason FROM e) AS r GROUP BY ALL""",
    "pipeline_full": f"""{_all(CLEANED)} SELECT doc_id, nlines, length, language, {FINAL} AS reason FROM e""",
}
