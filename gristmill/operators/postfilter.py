"""Final quality rules on documents that carry language and perplexity columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import blanks_for_whitespace, let, remove, swap
from gristmill.operators.reasons import first_reason

# Columns the second stage has to deliver; two are required though unused.
ENRICHED_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("raw_content", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("nlines", T.IntegerType()),
        T.StructField("language", T.StringType()),
        T.StructField("language_score", T.DoubleType()),
        T.StructField("original_nlines", T.IntegerType()),
        T.StructField("perplexity", T.DoubleType()),
        T.StructField("original_length", T.LongType()),
    ]
)
SOURCE_NAME = "CommonCrawl"
BYTE_ORDER_MARK = "\ufeff"


@dataclass(frozen=True)
class PostRules:
    max_perplexity: float = 1000
    perplexity_below_length: int = 500
    min_nlines: int = 3
    max_line_loss: float = 5
    min_language_score: float = 0.6
    min_length: int = 256
    min_ink_share: float = 0.8
    max_repetition: float = 2.5


def _ink_share(spaced: Column, length: Column) -> Column:
    return F.try_divide(F.length(remove(spaced, " ")), length)


def _repetition(spaced: Column) -> Column:
    distinct = F.array_distinct(F.split(spaced, " "))
    return F.try_divide(F.length(spaced), F.length(F.array_join(distinct, "")))


def ink_share(text: Column, length: Column) -> Column:
    """Visible characters of the text over the ``length`` column."""
    return _ink_share(blanks_for_whitespace(text), length)


def repetition(text: Column) -> Column:
    """Text length over the total length of its distinct words; NULL if it has none."""
    return let(blanks_for_whitespace(text), _repetition)


def missing_field() -> Column:
    """True when any required column is NULL."""
    cond = F.lit(False)
    for field in ENRICHED_SCHEMA.names:
        cond = cond | F.col(field).isNull()
    return cond


def post_reason(rules: PostRules = PostRules()) -> Column:
    """First rule that rejects the row, NULL when it stays.

    A missing field is a reason of its own, so that a NULL in a comparison
    cannot let a row through. Cheap numeric rules come before text rules.
    """
    perplexity, length = F.col("perplexity"), F.col("length")
    by_numbers = first_reason(
        [
            ("missing_field", missing_field()),
            (
                "perplexity",
                (perplexity > rules.max_perplexity)
                & ~F.isnan(perplexity)
                & (length < rules.perplexity_below_length),
            ),
            ("few_lines", F.col("nlines") < rules.min_nlines),
            (
                "line_loss",
                F.try_divide(F.col("original_nlines"), F.col("nlines")) > rules.max_line_loss,
            ),
            ("language_score", F.col("language_score") < rules.min_language_score),
            ("short_text", length < rules.min_length),
        ]
    )

    def by_text(spaced: Column) -> Column:
        repeats = _repetition(spaced) > rules.max_repetition
        return first_reason(
            [
                ("low_ink", _ink_share(spaced, length) < rules.min_ink_share),
                ("repetitive", F.coalesce(repeats, F.lit(True))),
            ]
        )

    return by_numbers.otherwise(let(blanks_for_whitespace(F.col("raw_content")), by_text))


def tag_post(df: DataFrame, rules: PostRules = PostRules(), strict: bool = False) -> DataFrame:
    """Add ``reason``. With ``strict`` a missing field ends the job instead."""
    reason = post_reason(rules)
    if strict:
        reason = F.when(
            missing_field(), F.raise_error(F.lit("row without a required field"))
        ).otherwise(reason)
    return df.withColumn("reason", reason)


def keep_post(df: DataFrame, rules: PostRules = PostRules()) -> DataFrame:
    return df.where(post_reason(rules).isNull())


def corpus_rows(df: DataFrame, *extra: str, source: str = SOURCE_NAME) -> DataFrame:
    """Project to (source, text, language), plus any columns named."""
    return df.select(
        F.lit(source).alias("source"),
        swap(F.col("raw_content"), BYTE_ORDER_MARK, "").alias("text"),
        "language",
        *extra,
    )
