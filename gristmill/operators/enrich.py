"""Columns the final rules need: paragraph deduplication, language scores, perplexity.

Shuffles carry hashes, counts and keys; texts meet their results in one join by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.functions.text import is_blank, let, lines, strip, words
from gristmill.sources import ledger
from gristmill.sources.staging import stage

#: Words in a language profile.
PROFILE_WORDS = 100
#: Languages a profile may have; more are refused, as profiles are broadcast.
MAX_LANGUAGES = 1_000
#: Words of all profiles that are looked up in the row.
IN_ROW_WORDS = 4_000
#: Frequent words whose counts are broadcast, some 100 bytes each; rarer ones are joined.
BROADCAST_WORDS = 300_000


def _kept_lines(text: str) -> Column:
    return F.filter(lines(F.col(text)), lambda p: ~is_blank(p))


def first_places(df: DataFrame, key: str = "doc_id", text: str = "raw_content") -> DataFrame:
    """(_hash, _at) of the different paragraphs: the first place of each, by key and position.

    Paragraphs are hashed before the shuffle and their first places combined in it, so a
    line that every document has is no hot key.
    """
    places = df.select(F.col(key).alias("_key"), F.posexplode(_kept_lines(text)).alias("_pos", "_p"))
    hashed = places.select("_key", "_pos", F.md5(strip(F.lower("_p")).cast("binary")).alias("_hash"))
    return hashed.groupBy("_hash").agg(F.min(F.struct("_key", "_pos")).alias("_at"))


def keep_places(df: DataFrame, first: DataFrame, key: str, text: str) -> DataFrame:
    """The texts with the paragraphs of the given places only, and their sizes before and after."""
    by_key = first.groupBy(F.col("_at._key").alias("_key")).agg(
        F.sort_array(F.collect_list("_at._pos")).alias("_kept")
    )
    joined = df.join(by_key, F.col(key) == F.col("_key"), "left").withColumns(
        {"_lines": _kept_lines(text), "_kept": F.coalesce("_kept", F.array().cast("array<int>"))}
    )
    stays = F.array_join(F.transform("_kept", lambda i: F.get("_lines", i)), "\n")
    return (
        joined.withColumns(
            {
                "original_nlines": F.size("_lines"),
                "original_length": F.length(text).cast("long"),
                "nlines": F.size("_kept"),
                "_text": stays,
            }
        )
        .withColumn("length", F.length("_text").cast("long"))
        .withColumn(text, F.col("_text"))
        .drop("_key", "_lines", "_kept", "_text")
    )


def dedup_paragraphs(df: DataFrame, key: str = "doc_id", text: str = "raw_content") -> DataFrame:
    """Keep the first of equal paragraphs in the whole corpus, by key and position.

    Paragraphs are the lines that are not blank; they are equal when they match in lower
    case without surrounding whitespace. Adds ``original_nlines``, ``original_length``,
    ``nlines`` and ``length``; a text of which nothing stays is empty. The key is unique.
    """
    return keep_places(df, first_places(df, key, text), key, text)


def dedup_increment(
    df: DataFrame, state: str, name: str, key: str = "doc_id", text: str = "raw_content"
) -> DataFrame:
    """As ``dedup_paragraphs``, for rows that come after those of earlier increments.

    ``state`` is a folder with the hashes of all paragraphs seen, a commit for each
    increment and a ledger. Increments in the order of their keys keep what one run over
    all keeps. An increment is known by its name: run again, as after a failure or for a
    batch a stream repeats, it finds its own paragraphs new and gives the same rows.
    """
    spark = df.sparkSession
    root = state.rstrip("/")
    known = [r["commit"] for r in ledger.commits(spark, root).collect()]
    mine = f"c-{name}"
    folders = [f"{root}/{c}" for c in sorted(known) if c != mine]
    first = first_places(df, key, text)
    if folders:
        seen = spark.read.schema("_hash string").parquet(*folders)
        first = first.join(seen, "_hash", "left_anti")
    first = stage(first, "first-places")
    if mine not in known:
        first.select("_hash").write.mode("overwrite").parquet(f"{root}/{mine}")
        entry = spark.createDataFrame([(name,)], "path string")
        ledger.mark_landed(entry, root, mine)
    return keep_places(df, first, key, text)


def language_profiles(
    df: DataFrame, lang: str = "lang", text: str = "text", size: int = PROFILE_WORDS
) -> DataFrame:
    """(lang, word) of the most frequent words of each language; ties go by word."""
    counts = (
        df.select(F.col(lang).alias("lang"), F.explode(words(F.lower(F.col(text)))).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Heads of buckets first: no task ranks the whole vocabulary of a language.
    order = (F.desc("n"), F.asc("word"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(64))
    heads = counts.withColumn("bucket", bucket).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))
    )
    ranked = heads.where(F.col("rank") <= size).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    )
    return ranked.where(F.col("rank") <= size).select("lang", "word")


def language_score(
    df: DataFrame, profiles: DataFrame, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, language, language_score): the language whose frequent words make the largest share.

    Ties go to the first language in alphabetical order; a text without any such word has
    no language and score 0. The key is unique. Profiles of up to ``IN_ROW_WORDS`` words in
    all are looked up in the row; more are joined, after a check of the number of languages.
    """
    few = profiles.select("lang", "word").limit(IN_ROW_WORDS + 1).collect()
    if len(few) <= IN_ROW_WORDS:
        by_lang: dict[str, list[str]] = {}
        for r in few:
            by_lang.setdefault(r["lang"], []).append(r["word"])
        return _score_in_row(df, by_lang, key, text)
    return _score_by_join(df, stage(profiles, "profiles"), key, text)


def _score_in_row(df: DataFrame, by_lang: dict[str, list[str]], key: str, text: str) -> DataFrame:
    """Scores by a set of words for each language, in one pass over a text's words."""

    def count(tokens: Column, lang: str) -> Column:
        found = F.filter(tokens, lambda w: w.isin(by_lang[lang]))
        return F.struct((-F.size(found)).alias("less"), F.lit(lang).alias("lang"))

    def scored(tokens: Column) -> Column:
        counts = [count(tokens, lang) for lang in sorted(by_lang)]
        none = F.struct(F.lit(0).alias("less"), F.lit(None).cast("string").alias("lang"))
        return let(
            F.array_min(F.array(none, *counts)),
            lambda best: F.struct(
                F.when(best["less"] < 0, best["lang"]).alias("language"),
                F.coalesce(F.try_divide(-best["less"], F.size(tokens)), F.lit(0.0)).alias(
                    "language_score"
                ),
            ),
        )

    tokens = F.coalesce(words(F.lower(F.col(text))), F.array().cast("array<string>"))
    return df.select(key, let(tokens, scored).alias("_score")).select(
        key, "_score.language", "_score.language_score"
    )


def _score_by_join(df: DataFrame, profiles: DataFrame, key: str, text: str) -> DataFrame:
    """Scores by a join of words with the profiles, which have a bounded number of rows for
    each language and are broadcast."""
    if profiles.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    tokens = words(F.lower(F.col(text)))
    found = (
        df.select(key, F.explode(tokens).alias("word"))
        .join(F.broadcast(profiles), "word")
        .groupBy(key, "lang")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = found.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), "lang")).alias("best"))
    sizes = df.select(key, F.size(tokens).alias("_words"))
    return sizes.join(best, key, "left").select(
        key,
        F.col("best.lang").alias("language"),
        F.coalesce(F.try_divide(-F.col("best.n"), "_words"), F.lit(0.0)).alias("language_score"),
    )


def _by_frequency(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame | None]:
    """The words of the highest counts, ``most`` at most, and the others if there are any.

    The bound between them is a power of two, so a few dozen numbers come to the driver.
    """
    power = F.floor(F.log2("c")).cast("int")
    sizes = counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, max((r["power"] for r in sizes), default=0) + 1
    for r in sorted(sizes, key=lambda r: -r["power"]):
        total += r["n"]
        if total > most:
            return counts.where(power >= least), counts.where(power < least)
        least = r["power"]
    return counts, None


def unigram_perplexity(
    df: DataFrame, key: str = "doc_id", text: str = "text", by: str = "lang"
) -> DataFrame:
    """(key, perplexity) under the add-one smoothed unigram model of each document's group.

    Counts come from the whole corpus and are staged. Frequent words are looked up in a
    broadcast table, so only sums of documents are shuffled for them; the others, each in
    few documents, meet their counts in a join. Texts without a word have no perplexity.
    """
    tokens = df.select(
        key, F.col(by).alias("_by"), F.explode(words(F.lower(F.col(text)))).alias("word")
    ).where("_by IS NOT NULL")
    counted = tokens.groupBy("word", "_by").agg(F.count(F.lit(1)).alias("c"))
    counts = stage(counted, "word-counts")
    sizes = counts.groupBy("_by").agg(
        F.sum("c").alias("total"), F.count(F.lit(1)).alias("vocabulary")
    )
    log_p = F.log((F.col("c") + 1) / (F.col("total") + F.col("vocabulary")))
    known = counts.join(sizes, "_by").select("word", "_by", log_p.alias("log_p"), "c")
    frequent, rare = _by_frequency(known, BROADCAST_WORDS)
    table = F.broadcast(frequent.select("word", "_by", "log_p"))

    def sums(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.sum("log_p").alias("s"), F.count(F.lit(1)).alias("n"))

    parts = sums(tokens.join(table, ["word", "_by"]))
    if rare is not None:
        others = tokens.join(table, ["word", "_by"], "left_anti")
        parts = parts.unionByName(sums(others.join(rare.drop("c"), ["word", "_by"])))
    return parts.groupBy(key).agg(F.exp(-F.sum("s") / F.sum("n")).alias("perplexity"))
