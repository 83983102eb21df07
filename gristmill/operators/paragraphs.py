"""Paragraph cleaning of the coarse stage.

A paragraph stays when its last visible character ends a sentence, it has at
least 16 visible characters, more than 3 words and a mean word length from 3 to
10. Unspaced scripts therefore lose most paragraphs; that is the rule's nature.
Header fields such as ``length`` and ``nlines`` are not recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import (
    blanks_for_whitespace,
    ends_in,
    has_rare_blank,
    let,
    lines,
    lstrip,
    remove,
    rstrip_unless,
    shorter_than,
    swap,
    word_count,
)
from gristmill.operators.reasons import first_reason

# Characters that may end a paragraph.
END_MARKS = tuple(".。!！?？\"”'’…")
REPLACEMENT_CHAR = "\ufffd"
# Control characters to delete (the line feed separates
# paragraphs and cannot occur inside one) and wide blanks to narrow.
CONTROL_CHARS = r"[\x00-\x09\x0b-\x1f\x7f]"
WIDE_BLANKS = "\u2002\u2003\u3000"


@dataclass(frozen=True)
class ParagraphRules:
    end_marks: Sequence[str] = END_MARKS
    min_chars: int = 16
    few_words: int = 3
    min_word_length: float = 3
    max_word_length: float = 10
    few_paragraphs: int = 3


def _word_rules(p: Column, rules: ParagraphRules, rare: Column | None):
    """Word count and mean length, over the text without U+FFFD."""

    def check(spaced: Column) -> Column:
        return let(
            F.length(remove(spaced, " ")),
            lambda ink: let(
                word_count(spaced, ink),
                lambda n: first_reason(
                    [
                        ("few_words", n <= rules.few_words),
                        (
                            "word_length",
                            (ink < n * rules.min_word_length) | (ink > n * rules.max_word_length),
                        ),
                    ]
                ),
            ),
        )

    return let(blanks_for_whitespace(swap(p, REPLACEMENT_CHAR, ""), rare), check)


def paragraph_reason(
    p: Column, rules: ParagraphRules = ParagraphRules(), rare: Column | None = None
) -> Column:
    """Why a paragraph is dropped, NULL when it stays.

    ``rare`` may tell whether the text around it has unusual whitespace.
    """
    return let(
        rstrip_unless(p, rules.end_marks),
        lambda t: F.when(~ends_in(t, rules.end_marks), "no_end_mark").otherwise(
            F.when(shorter_than(lstrip(t), rules.min_chars), "short").otherwise(
                _word_rules(p, rules, rare)
            )
        ),
    )


def kept_paragraphs(text: Column, rules: ParagraphRules = ParagraphRules()) -> Column:
    """Array of the paragraphs that stay, characters still untouched."""
    return let(
        has_rare_blank(text),
        lambda rare: F.filter(lines(text), lambda p: paragraph_reason(p, rules, rare).isNull()),
    )


def tidy_characters(text: Column) -> Column:
    """Delete U+FFFD and control characters, narrow wide blanks.

    Works on joined paragraphs: line feeds are left alone.
    """
    clean = let(
        swap(text, REPLACEMENT_CHAR, ""),
        lambda t: F.when(
            t.rlike(CONTROL_CHARS), F.regexp_replace(t, CONTROL_CHARS, "")
        ).otherwise(t),
    )
    for blank in WIDE_BLANKS:
        clean = swap(clean, blank, " ")
    return clean


def join_paragraphs(kept: Column) -> Column:
    """Kept paragraphs, each followed by a line feed."""
    return F.when(F.size(kept) == 0, F.lit("")).otherwise(
        F.concat(tidy_characters(F.array_join(kept, "\n")), F.lit("\n"))
    )


def clean_text(text: Column, rules: ParagraphRules = ParagraphRules()) -> Column:
    return let(kept_paragraphs(text, rules), join_paragraphs)


def clean_documents(
    df: DataFrame,
    text: str = "raw_content",
    rules: ParagraphRules = ParagraphRules(),
    only: Column | None = None,
) -> DataFrame:
    """Replace ``text`` by its cleaned form; drop documents left with few paragraphs.

    Adds ``n_kept``. Rows outside ``only`` pass with an empty text. The kept
    paragraphs leave a generator that yields no row for a poor document: a
    filter on them would be pushed down and would clean twice.
    """
    others = [c for c in df.columns if c != text]
    kept = kept_paragraphs(F.col(text), rules)
    enough = F.filter(F.array(kept), lambda ks: F.size(ks) > rules.few_paragraphs)
    if only is not None:
        enough = F.when(only, enough).otherwise(F.array(F.array().cast("array<string>")))
    return df.select(*others, F.explode(enough).alias("_kept")).select(
        *others,
        F.size("_kept").alias("n_kept"),
        join_paragraphs(F.col("_kept")).alias(text),
    )


def explode_paragraphs(
    df: DataFrame, text: str = "raw_content", rules: ParagraphRules = ParagraphRules()
) -> DataFrame:
    """One row per paragraph with its position and the reason it is dropped."""
    others = [c for c in df.columns if c != text]
    return df.select(*others, F.posexplode(lines(F.col(text))).alias("pos", "paragraph")).withColumn(
        "reason", paragraph_reason(F.col("paragraph"), rules)
    )
