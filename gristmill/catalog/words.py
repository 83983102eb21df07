"""Word-list operators, with lists that come from the tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.catalog.common import DEMO_WORDS, sql_hit, sql_values, sql_words, table
from gristmill.functions.text import words as words_of
from gristmill.operators import lexicon as lex
from gristmill.sources.staging import new_folder


def _part_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words of part names, as a list to match."""
    names = table(spark, sf_dir, "part").select(F.explode(words_of(F.col("p_name"))).alias("word"))
    return names.distinct()


PART_WORDS = f"(SELECT DISTINCT unnest({sql_words('p_name')}) AS word FROM part) AS w"


def _benchmark_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = words_of(F.col("text"))
    return table(spark, sf_dir, "benchmark").select(F.explode(words).alias("word")).distinct()


BENCHMARK_WORDS = f"(SELECT DISTINCT unnest({sql_words('text')}) AS word FROM benchmark)"


def lexicon_load_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of the documents' languages in load order, with the size of each."""
    docs = table(spark, sf_dir, "documents")
    words = docs.select("lang", F.explode(words_of(F.lower("text"))).alias("word")).distinct()
    ranked = lex.with_load_order(words)
    return ranked.groupBy("lang", "lang_rank").agg(F.count(F.lit(1)).alias("n_words"))


def lexicon_minimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lex.minimal_substrings(_benchmark_words(spark, sf_dir))


def lexicon_shortest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lex.shortest_listed(_part_words(spark, sf_dir).unionByName(_benchmark_words(spark, sf_dir)))


def lexicon_matchable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lex.drop_unmatchable(lex.with_literals(_benchmark_words(spark, sf_dir)))


def lexicon_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts per listed word."""
    docs = table(spark, sf_dir, "documents").select(F.lower("text").alias("text"))
    hits = docs.select(F.explode(lex.words_found(F.col("text"), DEMO_WORDS)).alias("word"))
    return hits.groupBy("word").agg(F.count(F.lit(1)).alias("n_docs"))


def lexicon_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lex.lexicon_pairs(docs, "doc_id", "text", _part_words(spark, sf_dir))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("turn_id"), "text"
    )


def lexicon_pairs_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs on conversations, by the index of q-grams that long lists become."""
    words = _part_words(spark, sf_dir)
    return lex.lexicon_pairs(_turns(spark, sf_dir), "turn_id", "text", words, max_entries=5)


def lexicon_pairs_by_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pairs by an equi-join on all substrings of a listed length."""
    turns = _turns(spark, sf_dir).withColumn("text", F.lower("text"))
    return lex.substring_pairs(turns, "turn_id", "text", _part_words(spark, sf_dir))


def lexicon_benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a word of ten letters or more of the benchmark, by the index."""
    words = _benchmark_words(spark, sf_dir).where(F.length("word") >= 10)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    flagged = lex.flag_hits(docs, F.lower("text"), words, max_entries=20)
    return flagged.select("doc_id", F.col("_hit").alias("hit"))


def lexicon_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without any word of a list held in a table."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return lex.drop_hits(docs, "text", _part_words(spark, sf_dir)).select("doc_id", "lang")


def lexicon_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit flag per document, in the plain and in the automaton form."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lower("text").alias("text"))
    return docs.select(
        "doc_id",
        lex.lexicon_hit(F.col("text"), DEMO_WORDS, "chain").alias("by_chain"),
        lex.lexicon_hit(F.col("text"), DEMO_WORDS, "automaton").alias("by_automaton"),
    )


def _write_lists(spark: SparkSession, words: DataFrame) -> str:
    """Word files in a folder for each language, a language in several files; returns the path."""
    folder = new_folder(spark, "lists")
    (
        words.select("lang", F.col("word").alias("value"))
        .withColumn("part", F.pmod(F.xxhash64("value"), F.lit(8)))
        .repartition("lang", "part")
        .select("lang", "value")
        .write.partitionBy("lang")
        .text(folder)
    )
    return folder


def _words_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("lang", F.explode(words_of(F.lower("text"))).alias("word")).distinct()


def lexicon_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word files by language, written and loaded again, in load order."""
    folder = _write_lists(spark, _words_by_lang(spark, sf_dir))
    loaded = lex.load_lexicon(spark, folder, name=-2)
    return lex.with_load_order(loaded).select("lang", "lang_rank", "word")


def lexicon_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of each language's list; of English, which has no folder, the error instead."""
    words = _words_by_lang(spark, sf_dir)
    folder = _write_lists(spark, words.where("lang <> 'en'"))
    found = spark.createDataFrame([], "lang string, n_words long, error string")
    for lang in sorted(r["lang"] for r in words.select("lang").distinct().collect()):
        name = F.lit(lang).alias("lang")
        try:
            loaded = lex.load_lexicon(spark, f"{folder}/lang={lang}", name=-2)
            row = loaded.agg(F.count(F.lit(1)).alias("n_words")).select(
                name, "n_words", F.lit(None).cast("string").alias("error")
            )
        except AnalysisException as err:
            row = spark.range(1).select(
                name, F.lit(None).cast("long").alias("n_words"), F.lit(err.getCondition()).alias("error")
            )
        found = found.unionByName(row)
    return found


QUERIES = {
    "lexicon_load_order": lexicon_load_order,
    "lexicon_minimal": lexicon_minimal,
    "lexicon_shortest": lexicon_shortest,
    "lexicon_matchable": lexicon_matchable,
    "lexicon_hits": lexicon_hits,
    "lexicon_pairs": lexicon_pairs,
    "lexicon_pairs_joined": lexicon_pairs_joined,
    "lexicon_pairs_by_substring": lexicon_pairs_by_substring,
    "lexicon_benchmark_hits": lexicon_benchmark_hits,
    "lexicon_clean_documents": lexicon_clean_documents,
    "lexicon_flags": lexicon_flags,
    "lexicon_files": lexicon_files,
    "lexicon_missing": lexicon_missing,
}

HEAD = "[" + ", ".join(f"'{h}'" for h in lex.HEAD_LANGUAGES) + "]"
LITERAL_ROWS = sql_values(lex.LITERALS)

SQL = {
    "lexicon_load_order": f"""SELECT lang,
        coalesce(list_position({HEAD}, lang), {len(lex.HEAD_LANGUAGES) + 1})::INTEGER AS lang_rank,
        count(*) AS n_words
        FROM (SELECT DISTINCT lang, unnest({sql_words('lower(text)')}) AS word FROM documents) AS x
        GROUP BY lang""",
    "lexicon_files": f"""SELECT DISTINCT lang,
        coalesce(list_position({HEAD}, lang), {len(lex.HEAD_LANGUAGES) + 1})::INTEGER AS lang_rank,
        unnest({sql_words('lower(text)')}) AS word FROM documents""",
    "lexicon_minimal": f"""WITH l AS {BENCHMARK_WORDS}
        SELECT word FROM l WHERE NOT EXISTS (
          SELECT 1 FROM l AS s WHERE s.word <> l.word AND contains(l.word, s.word))""",
    "lexicon_shortest": f"""WITH l AS (SELECT word FROM {PART_WORDS} UNION SELECT word FROM {BENCHMARK_WORDS} AS b)
        SELECT word, shortest FROM (
          SELECT l.word, s.word AS shortest,
                 row_number() OVER (PARTITION BY l.word ORDER BY length(s.word), s.word) AS rn
          FROM l JOIN l AS s ON contains(l.word, s.word)) AS x WHERE rn = 1""",
    "lexicon_matchable": f"""SELECT word FROM (SELECT word FROM {LITERAL_ROWS}
        UNION ALL SELECT word FROM {BENCHMARK_WORDS} AS b) AS x WHERE word = lower(word)""",
    "lexicon_hits": f"""SELECT w.word, count(*) AS n_docs FROM documents
        JOIN {sql_values(DEMO_WORDS)} ON contains(lower(text), w.word) GROUP BY w.word""",
    "lexicon_pairs": f"""SELECT doc_id, w.word FROM documents
        JOIN {PART_WORDS} ON contains(lower(text), w.word)""",
    "lexicon_pairs_joined": f"""SELECT conv_id * 1000 + turn AS turn_id, w.word FROM conversations
        JOIN {PART_WORDS} ON contains(lower(text), w.word)""",
    "lexicon_pairs_by_substring": f"""SELECT conv_id * 1000 + turn AS turn_id, w.word FROM conversations
        JOIN {PART_WORDS} ON contains(lower(text), w.word)""",
    "lexicon_benchmark_hits": f"""SELECT doc_id, coalesce(EXISTS (SELECT 1 FROM {BENCHMARK_WORDS} AS w
        WHERE length(w.word) >= 10 AND contains(lower(text), w.word)), false) AS hit FROM documents""",
    "lexicon_missing": f"""SELECT lang, CASE WHEN lang <> 'en' THEN count(*) END AS n_words,
        CASE WHEN lang = 'en' THEN 'PATH_NOT_FOUND' END AS error
        FROM (SELECT DISTINCT lang, unnest({sql_words('lower(text)')}) AS word FROM documents) AS x
        GROUP BY lang""",
    "lexicon_clean_documents": f"""SELECT doc_id, lang FROM documents WHERE NOT EXISTS (
        SELECT 1 FROM {PART_WORDS} WHERE contains(lower(text), w.word))""",
    "lexicon_flags": f"""SELECT doc_id, {sql_hit('text')} AS by_chain, {sql_hit('text')} AS by_automaton
        FROM documents""",
}
