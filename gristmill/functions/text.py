"""Text helpers with full-Unicode whitespace.

Spark's ``trim`` and Java's ``\\s`` know ASCII blanks only, so every helper here
names its whitespace. Trimming and single-character tests use ``btrim`` and
``substring``, which cost far less than a regular expression per paragraph.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points that count as whitespace.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as the inside of a Java character class.
WS_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Whitespace other than the blank and the line feed, which most
# texts lack. Those of the second group share their first two bytes in UTF-8.
RARE_BLANKS = "\t\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u205f\u3000"
RARE_BLANKS_E280 = (
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f"
)



def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` to a lambda variable so that ``body`` may use it many times.

    Catalyst copies an alias into every predicate it pushes down; a lambda
    variable is evaluated once wherever the expression ends up.
    """
    return F.transform(F.array(value), body).getItem(0)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(WHITESPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    # Trimming the left side alone stops at the first visible character.
    return lstrip(c) == ""


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def first_char(c: Column) -> Column:
    return F.substring(c, 1, 1)


def swap(c: Column, old: str, new: str) -> Column:
    """Replace a literal token that most texts lack; a plain search goes first.

    ``replace`` calls a comparison at every byte, the search only at a first match.
    """
    return let(
        c,
        lambda t: F.when(
            F.contains(t, F.lit(old)), F.replace(t, F.lit(old), F.lit(new))
        ).otherwise(t),
    )


def remove(c: Column, token: str) -> Column:
    return F.replace(c, F.lit(token), F.lit(""))


def count_token(c: Column, token: str) -> Column:
    """Non-overlapping occurrences of a literal token."""
    lost = F.length(c) - F.length(remove(c, token))
    return lost if len(token) == 1 else (lost / len(token)).cast("int")


def ends_in(c: Column, ends: Sequence[str]) -> Column:
    """True when the text ends with one of ``ends``."""
    cond = F.endswith(c, F.lit(ends[0]))
    for end in ends[1:]:
        cond = cond | F.endswith(c, F.lit(end))
    return cond


def rstrip_unless(c: Column, ends: Sequence[str]) -> Column:
    """Text without trailing whitespace; visible ``ends`` show that there is none."""
    return F.when(ends_in(c, ends), c).otherwise(rstrip(c))


def ends_with_any(c: Column, ends: Sequence[str]) -> Column:
    """True when the text without trailing whitespace ends with one of ``ends``."""
    return ends_in(c, ends) | let(rstrip(c), lambda t: ends_in(t, ends))


def shorter_than(c: Column, n: int) -> Column:
    """``length(c) < n``, counting characters only where the byte length leaves it open."""
    return (F.octet_length(c) < 4 * n) & (F.length(c) < n)


def holds_any(c: Column, tokens: Sequence[str]) -> Column:
    """True when the text holds one of a short list of literal tokens."""
    tokens = list(tokens)
    if not tokens:
        return F.lit(False)

    def any_of(t: Column) -> Column:
        cond = F.contains(t, F.lit(tokens[0]))
        for token in tokens[1:]:
            cond = cond | F.contains(t, F.lit(token))
        return cond

    return let(c, any_of)


def has_rare_blank(c: Column) -> Column:
    """True when the text has whitespace other than blanks and line feeds.

    Byte searches only; a character class took more than twice as long.
    """
    return let(
        c,
        lambda t: holds_any(t, RARE_BLANKS)
        | (
            F.contains(t.cast("binary"), F.lit(bytearray(b"\xe2\x80")))
            & holds_any(t, RARE_BLANKS_E280)
        ),
    )


def blanks_for_whitespace(c: Column, rare: Column | None = None) -> Column:
    """Every whitespace character as one plain blank.

    ``translate`` walks the text code point by code point, so it only runs on
    texts that need it. ``rare`` tells that, where it is known for many pieces.
    """
    rare = has_rare_blank(c) if rare is None else rare
    return F.when(rare, F.translate(c, WHITESPACE, " " * len(WHITESPACE))).otherwise(
        swap(c, "\n", " ")
    )


def words(c: Column, rare: Column | None = None) -> Column:
    """Whitespace-separated words as an array, without empty ones."""
    return F.array_remove(F.split(blanks_for_whitespace(c, rare), " "), "")


def word_count(spaced: Column, ink: Column) -> Column:
    """Number of words in a text whose whitespace is plain blanks, given its ink length.

    Single blanks between words are counted without building an array.
    """
    return let(
        F.btrim(spaced),
        lambda t: F.when(
            F.contains(t, F.lit("  ")), F.size(F.array_remove(F.split(t, " "), ""))
        ).otherwise(F.when(t == "", 0).otherwise(F.length(t) - ink + 1)),
    )


def ink_length(c: Column) -> Column:
    """Number of characters that are not whitespace."""
    return F.length(remove(blanks_for_whitespace(c), " "))


def second_word(c: Column, rare: Column | None = None) -> Column:
    """Second whitespace-separated word of a line, NULL when there is none."""
    return F.get(words(c, rare), F.lit(1))


def unix_newlines(c: Column) -> Column:
    return swap(swap(c, "\r\n", "\n"), "\r", "\n")
