"""Document and paragraph rules over ``documents`` and ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.catalog.common import (
    BULLET_COND,
    DEMO_WORDS,
    ELLIPSIS_COND,
    sql_clean,
    sql_hit,
    sql_paragraph_reason,
    sql_paragraphs,
    sql_passage_reason,
    sql_share,
    sql_symbol_share,
    sql_words,
    table,
)
from gristmill.functions.text import words as words_of
from gristmill.operators import paragraphs as para
from gristmill.operators import passage
from gristmill.operators.reasons import funnel
from gristmill.plans.coarse import clean_rows

PS = f"(SELECT *, {sql_paragraphs('text')} AS ps FROM documents) AS d"
REASONS = f"SELECT doc_id, {sql_passage_reason()} AS reason FROM {PS}"


def passage_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tagged = passage.tag_passages(docs, "text", DEMO_WORDS, method="automaton")
    return tagged.select("doc_id", "reason")


def _word_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in DEMO_WORDS], "word string")


def passage_reason_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same reasons with a list over the bound, folded in shards of three entries."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tagged = passage.tag_passages(docs, "text", _word_frame(spark), max_entries=3)
    return tagged.select("doc_id", "reason")


LONG_LIST_LENGTH = 12


def passage_reason_long_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons by a list of all long words of the benchmark."""
    items = table(spark, sf_dir, "benchmark")
    listed = items.select(F.explode(words_of(F.lower("text"))).alias("word"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    long = listed.where(F.length("word") >= LONG_LIST_LENGTH).distinct()
    return passage.tag_passages(docs, "text", long).select("doc_id", "reason")


def passage_funnel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funnel(passage_reason(spark, sf_dir))


def passage_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return passage.keep_passages(docs, "text", DEMO_WORDS).select("doc_id", "source")


def passage_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", passage.layout(F.col("text")).alias("l")
    )
    share = F.try_divide(F.col("l.n_short"), F.col("l.n"))
    return docs.select("doc_id", F.col("l.n").alias("n"), F.round(share, 6).alias("short_share"))


def _restyled(docs: DataFrame) -> DataFrame:
    """Bulleted, trailing-off and unchanged forms of the texts, by id."""
    kind = F.col("doc_id") % 3
    text = (
        F.when(kind == 0, F.concat(F.lit("• "), F.replace("text", F.lit("\n"), F.lit("\n- "))))
        .when(kind == 1, F.replace("text", F.lit(".\n"), F.lit("...\n")))
        .otherwise(F.col("text"))
    )
    return docs.select("doc_id", text.alias("text"))


RESTYLED = """(SELECT doc_id, CASE doc_id % 3
    WHEN 0 THEN '• ' || replace(text, chr(10), chr(10) || '- ')
    WHEN 1 THEN replace(text, '.' || chr(10), '...' || chr(10)) ELSE text END AS text
  FROM documents) AS d"""


def passage_bullet_ellipsis(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _restyled(table(spark, sf_dir, "documents"))
    tagged = passage.tag_passages(docs, "text")
    return tagged.select(
        "doc_id", "reason", passage.layout(F.col("text")).alias("l")
    ).select("doc_id", "reason", F.col("l.n_bullet").alias("n_bullet"), F.col("l.n_ellipsis").alias("n_ellipsis"))


def _noisy(docs: DataFrame) -> DataFrame:
    """Texts with one letter turned into a symbol, by id."""
    kind = F.col("doc_id") % 3
    text = (
        F.when(kind == 0, F.replace("text", F.lit("e"), F.lit("#")))
        .when(kind == 1, F.replace("text", F.lit("a"), F.lit("…")))
        .otherwise(F.replace("text", F.lit(" "), F.lit("...")))
    )
    return docs.select("doc_id", text.alias("text"))


NOISY = """(SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN replace(text, 'e', '#')
    WHEN 1 THEN replace(text, 'a', '…') ELSE replace(text, ' ', '...') END AS text
  FROM documents) AS d"""


def passage_symbol_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _noisy(table(spark, sf_dir, "documents"))
    shares = [
        F.round(passage.symbol_share(F.col("text"), token), 6).alias(f"{name}_share")
        for name, token in passage.PassageRules().symbols
    ]
    return passage.tag_passages(docs, "text").select("doc_id", "reason", *shares)


def clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return para.clean_documents(docs, "text")


def clean_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return para.clean_documents(turns, "text")


def clean_paragraph_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("text")
    return funnel(para.explode_paragraphs(docs, "text"))


MESSY = """(SELECT doc_id, replace(replace(replace(text, ' th', chr(9) || 'th'), 'an', chr(65533) || 'an'),
    ' de ', chr(12288) || 'de' || chr(8195)) || chr(10) || chr(1) || text AS text FROM documents) AS d"""


def clean_characters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with tabs, U+FFFD, wide blanks and a control character put in."""
    text = F.replace("text", F.lit(" th"), F.lit("\tth"))
    text = F.replace(text, F.lit("an"), F.lit("\ufffdan"))
    text = F.replace(text, F.lit(" de "), F.lit("\u3000de\u2003"))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(text, F.lit("\n\x01"), F.col("text")).alias("text")
    )
    return para.clean_documents(docs, "text")


def coarse_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_rows(docs, DEMO_WORDS, text="text")


def strict_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rules with other thresholds."""
    rules = passage.PassageRules(min_chars=1024, few_paragraphs=8, max_short_share=0.05)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return funnel(passage.tag_passages(docs, "text", rules=rules))


def coarse_clean_sharded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coarse cleaning with a list over the bound: the same rows as ``coarse_clean``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_rows(docs, _word_frame(spark), text="text", max_entries=3).select(
        "doc_id", "n_kept", "text"
    )


QUERIES = {
    "passage_reason": passage_reason,
    "passage_funnel": passage_funnel,
    "passage_survivors": passage_survivors,
    "passage_layout": passage_layout,
    "passage_bullet_ellipsis": passage_bullet_ellipsis,
    "passage_symbol_share": passage_symbol_share,
    "clean_documents": clean_documents,
    "clean_conversations": clean_conversations,
    "clean_paragraph_reasons": clean_paragraph_reasons,
    "clean_characters": clean_characters,
    "coarse_clean": coarse_clean,
    "coarse_clean_sharded": coarse_clean_sharded,
    "passage_reason_sharded": passage_reason_sharded,
    "passage_reason_long_list": passage_reason_long_list,
    "strict_rules": strict_rules,
}

NO_WORDS = ("no such token in any text \x02",)


def _tagged(source: str) -> str:
    return f"(SELECT *, {sql_paragraphs('text')} AS ps FROM {source}) AS t"


SQL = {
    "passage_reason": REASONS,
    "passage_funnel": f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n
        FROM ({REASONS}) AS r GROUP BY ALL""",
    "passage_survivors": f"""SELECT doc_id, source FROM {PS} WHERE {sql_passage_reason()} IS NULL""",
    "passage_layout": f"""SELECT doc_id, len(ps)::INTEGER AS n,
        round({sql_share('length(p) < 16')}, 6) AS short_share FROM {PS}""",
    "passage_bullet_ellipsis": f"""SELECT doc_id, {sql_passage_reason(words=NO_WORDS)} AS reason,
        len(list_filter(ps, lambda p: {BULLET_COND}))::INTEGER AS n_bullet,
        len(list_filter(ps, lambda p: {ELLIPSIS_COND}))::INTEGER AS n_ellipsis
        FROM {_tagged(RESTYLED)}""",
    "passage_symbol_share": f"""SELECT doc_id, {sql_passage_reason(words=NO_WORDS)} AS reason,
        round({sql_symbol_share('text', '#')}, 6) AS hash_signs_share,
        round({sql_symbol_share('text', '…')}, 6) AS ellipsis_signs_share,
        round({sql_symbol_share('text', '...')}, 6) AS dot_runs_share
        FROM {_tagged(NOISY)}""",
    "clean_documents": sql_clean("documents", "doc_id"),
    "clean_conversations": sql_clean("conversations", "conv_id, turn"),
    "clean_paragraph_reasons": f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n
        FROM (SELECT {sql_paragraph_reason('p')} AS reason
              FROM (SELECT unnest(string_split(text, chr(10))) AS p FROM documents) AS x) AS r
        GROUP BY ALL""",
    "clean_characters": sql_clean(MESSY, "doc_id"),
    "coarse_clean": sql_clean(
        f"(SELECT doc_id, text FROM {PS} WHERE {sql_passage_reason()} IS NULL) AS s", "doc_id"
    ),
    "strict_rules": f"""SELECT coalesce(reason, 'kept') AS reason, count(*) AS n FROM (
        SELECT CASE WHEN length(text) < 1024 THEN 'short_text' WHEN len(ps) <= 8 THEN 'few_paragraphs'
          WHEN {sql_share('length(p) < 16')} > 0.05 THEN 'short_paragraphs' END AS reason
        FROM {PS}) AS r GROUP BY ALL""",
}
SQL["coarse_clean_sharded"] = SQL["coarse_clean"]
SQL["passage_reason_sharded"] = REASONS
SQL["passage_reason_long_list"] = f"""SELECT doc_id, {sql_passage_reason()} AS reason FROM {PS}""".replace(
    sql_hit("text"),
    f"""EXISTS (SELECT 1 FROM (SELECT DISTINCT unnest({sql_words('lower(text)')}) AS word FROM benchmark) AS w
        WHERE length(w.word) >= {LONG_LIST_LENGTH} AND contains(lower(d.text), w.word))""",
)
