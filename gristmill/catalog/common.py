"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.functions.text import WHITESPACE
from gristmill.operators.paragraphs import END_MARKS
from gristmill.operators.passage import BULLETS

# A short neutral list; real lists are a parameter.
DEMO_WORDS = ("nicht", "worthless", "mentpa", "shof ", "óciónc", "{", "}", "javascript", "lorem ipsum")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sql_str(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_list(items) -> str:
    return "(" + ", ".join(sql_str(i) for i in items) + ")"


def sql_values(items) -> str:
    return "(VALUES " + ", ".join(f"({sql_str(i)})" for i in items) + ") AS w(word)"


WS = sql_str(WHITESPACE)
# The same characters as a class of the SQL engine's regular expressions.
WS_RE = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def sql_strip(x: str) -> str:
    return f"trim({x}, {WS})"


def sql_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{WS_RE}+'), lambda w: w <> '')"


def sql_hit(text: str, words=DEMO_WORDS) -> str:
    return f"EXISTS (SELECT 1 FROM {sql_values(words)} WHERE contains(lower({text}), w.word))"


def sql_paragraphs(text: str) -> str:
    return f"list_filter(string_split({text}, chr(10)), lambda p: {sql_strip('p')} <> '')"


def sql_share(cond: str, ps: str = "ps") -> str:
    return f"len(list_filter({ps}, lambda p: {cond}))::DOUBLE / len({ps})"


BULLET_COND = f"left({sql_strip('p')}, 1) IN {sql_list(BULLETS)}"
ELLIPSIS_COND = f"(suffix({sql_strip('p')}, '...') OR suffix({sql_strip('p')}, '…'))"


def sql_symbol_share(text: str, token: str) -> str:
    lost = f"(length({text}) - length(replace({text}, {sql_str(token)}, '')))"
    return f"({lost} / {len(token)})::DOUBLE / length({text})"


def sql_passage_reason(text: str = "text", ps: str = "ps", words=DEMO_WORDS) -> str:
    """CASE expression of the document rules over a text and its paragraphs."""
    return f"""CASE
      WHEN length({text}) < 512 THEN 'short_text'
      WHEN len({ps}) <= 5 THEN 'few_paragraphs'
      WHEN {sql_share('length(p) < 16', ps)} > 0.5 THEN 'short_paragraphs'
      WHEN {sql_hit(text, words)} THEN 'lexicon'
      WHEN {sql_share(BULLET_COND, ps)} > 0.9 THEN 'bullets'
      WHEN {sql_share(ELLIPSIS_COND, ps)} > 0.3 THEN 'ellipses'
      WHEN {sql_symbol_share(text, '#')} > 0.1 THEN 'hash_signs'
      WHEN {sql_symbol_share(text, '…')} > 0.1 THEN 'ellipsis_signs'
      WHEN {sql_symbol_share(text, '...')} > 0.1 THEN 'dot_runs'
    END"""


def sql_paragraph_reason(p: str = "p") -> str:
    s = sql_strip(p)
    w = sql_words(f"replace({p}, chr(65533), '')")
    mean = f"list_sum(list_transform({w}, lambda x: length(x)))::DOUBLE / len({w})"
    return f"""CASE
      WHEN {s} = '' OR right({s}, 1) NOT IN {sql_list(END_MARKS)} THEN 'no_end_mark'
      WHEN length({s}) < 16 THEN 'short'
      WHEN len({w}) <= 3 THEN 'few_words'
      WHEN {mean} < 3 OR {mean} > 10 THEN 'word_length'
    END"""


def sql_tidy(p: str) -> str:
    """Characters of one kept paragraph."""
    clean = f"regexp_replace(replace({p}, chr(65533), ''), '[\\x00-\\x1f\\x7f]', '', 'g')"
    return f"regexp_replace({clean}, '[\\x{{2002}}\\x{{2003}}\\x{{3000}}]', ' ', 'g')"


def sql_clean(source: str, keys: str, text: str = "text") -> str:
    """Query body: keys, n_kept and cleaned text of documents with > 3 kept paragraphs."""
    return f"""
    SELECT {keys}, len(kept)::INTEGER AS n_kept,
           list_reduce(list_transform(kept, lambda p: {sql_tidy('p')}),
                       lambda a, b: a || chr(10) || b) || chr(10) AS {text}
    FROM (SELECT {keys}, list_filter(string_split({text}, chr(10)),
                 lambda p: {sql_paragraph_reason('p')} IS NULL) AS kept FROM {source}) AS k
    WHERE len(kept) > 3"""
