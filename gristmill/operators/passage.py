"""Document rules of the coarse stage.

Rules in order: short text, few paragraphs, mostly short paragraphs, lexicon
hit, bullet lists, trailing ellipses, symbol noise. A paragraph is a non-blank
piece between line feeds, kept unstripped.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import (
    count_token,
    ends_with_any,
    first_char,
    holds_any,
    is_blank,
    let,
    lines,
    lstrip,
    shorter_than,
)
from gristmill.operators.lexicon import BROADCAST_CHARS, BROADCAST_ENTRIES, flag_hits
from gristmill.operators.reasons import first_reason

# Characters that open a bullet point.
BULLETS = tuple("-–—⁃*+●•·◦▪▫▶▸▹►▼▽▾▿")

# Endings of a paragraph that trails off.
ELLIPSES = ("...", "…")


@dataclass(frozen=True)
class PassageRules:
    """Thresholds; each is the last value that still passes."""

    min_chars: int = 512
    few_paragraphs: int = 5
    short_paragraph: int = 16
    max_short_share: float = 0.5
    max_bullet_share: float = 0.9
    max_ellipsis_share: float = 0.3
    max_symbol_share: float = 0.1
    bullets: Sequence[str] = BULLETS
    ellipses: Sequence[str] = ELLIPSES
    symbols: Sequence[tuple[str, str]] = (
        ("hash_signs", "#"),
        ("ellipsis_signs", "…"),
        ("dot_runs", "..."),
    )


def paragraphs(text: Column) -> Column:
    return F.filter(lines(text), lambda p: ~is_blank(p))


def _starts_as_bullet(p: Column, rules: PassageRules) -> Column:
    return first_char(lstrip(p)).isin(*rules.bullets)


def _trails_off(p: Column, rules: PassageRules) -> Column:
    return ends_with_any(p, rules.ellipses)


def layout(text: Column, rules: PassageRules = PassageRules()) -> Column:
    """Struct of paragraph counts: n, n_short, n_bullet, n_ellipsis."""
    return let(
        paragraphs(text),
        lambda ps: F.struct(
            F.size(ps).alias("n"),
            F.size(F.filter(ps, lambda p: shorter_than(p, rules.short_paragraph))).alias("n_short"),
            F.size(F.filter(ps, lambda p: _starts_as_bullet(p, rules))).alias("n_bullet"),
            F.size(F.filter(ps, lambda p: _trails_off(p, rules))).alias("n_ellipsis"),
        ),
    )


def symbol_share(text: Column, token: str) -> Column:
    """Occurrences of the token per character of the whole text."""
    return F.try_divide(count_token(text, token), F.length(text))


def _symbol_rules(text: Column, rules: PassageRules):
    # Most texts lack the token, which one search tells.
    return [
        (
            name,
            F.contains(text, F.lit(token)) & (symbol_share(text, token) > rules.max_symbol_share),
        )
        for name, token in rules.symbols
    ]


def layout_reasons(text: Column, rules: PassageRules = PassageRules()) -> Column:
    """Struct (early, late): the first reason before and after the lexicon rule.

    ``late`` is only worked out where ``early`` is NULL. Paragraphs are split
    once, and not at all for texts under the length limit.
    """

    def early(ps: Column) -> Column:
        n_short = F.size(F.filter(ps, lambda p: shorter_than(p, rules.short_paragraph)))
        return first_reason(
            [
                ("few_paragraphs", F.size(ps) <= rules.few_paragraphs),
                ("short_paragraphs", F.try_divide(n_short, F.size(ps)) > rules.max_short_share),
            ]
        )

    def late(ps: Column) -> Column:
        n_bullet = F.size(F.filter(ps, lambda p: _starts_as_bullet(p, rules)))
        n_ellipsis = F.size(F.filter(ps, lambda p: _trails_off(p, rules)))
        return first_reason(
            [
                ("bullets", F.try_divide(n_bullet, F.size(ps)) > rules.max_bullet_share),
                (
                    "ellipses",
                    holds_any(text, rules.ellipses)
                    & (F.try_divide(n_ellipsis, F.size(ps)) > rules.max_ellipsis_share),
                ),
            ]
            + _symbol_rules(text, rules)
        )

    def both(ps: Column) -> Column:
        return let(
            early(ps),
            lambda e: F.struct(e.alias("early"), F.when(e.isNull(), late(ps)).alias("late")),
        )

    nothing = F.lit(None).cast("string")
    return F.when(
        shorter_than(text, rules.min_chars),
        F.struct(F.lit("short_text").alias("early"), nothing.alias("late")),
    ).otherwise(let(paragraphs(text), both))


def tag_passages(
    df: DataFrame,
    text: str = "raw_content",
    words: Sequence[str] | DataFrame = (),
    rules: PassageRules = PassageRules(),
    method: str = "auto",
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """Add ``reason`` to every row, NULL for the ones that pass.

    The lexicon is matched only on texts that got past the earlier rules.
    """
    tagged = df.withColumn("_layout", layout_reasons(F.col(text), rules))
    candidate = F.when(F.col("_layout.early").isNull(), F.lower(F.col(text)))
    return (
        flag_hits(tagged, candidate, words, method, max_entries, max_chars)
        .withColumn(
            "reason",
            F.coalesce(
                F.col("_layout.early"),
                F.when(F.col("_hit"), "lexicon"),
                F.col("_layout.late"),
            ),
        )
        .drop("_layout", "_hit")
    )


def keep_passages(
    df: DataFrame,
    text: str = "raw_content",
    words: Sequence[str] | DataFrame = (),
    rules: PassageRules = PassageRules(),
    method: str = "auto",
    only: Column | None = None,
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """Rows that no rule rejects; rows outside ``only`` pass unseen.

    Which rule hits does not matter here, so every built-in rule runs before
    the lexicon and only the remaining texts are searched.
    """
    passes = let(
        layout_reasons(F.col(text), rules),
        lambda r: F.coalesce(r["early"], r["late"]).isNull(),
    )
    lowered = F.lower(F.col(text))
    if only is not None:
        passes = F.when(only, passes).otherwise(True)
        lowered = F.when(only, lowered)
    flagged = flag_hits(df.where(passes), lowered, words, method, max_entries, max_chars)
    return flagged.where(~F.col("_hit")).drop("_hit")
