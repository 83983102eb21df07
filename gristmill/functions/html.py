"""List items and link texts out of HTML, by regular expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Entities that occur in index pages.
ENTITIES = [
    ("&nbsp;", " "),
    ("&ndash;", "–"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&amp;", "&"),
]


NUMERIC = r"&#([xX][0-9a-fA-F]{1,6}|[0-9]{1,7});"


def list_items(html: Column) -> Column:
    """Inner HTML of every ``<li>`` element, in page order.

    An item ends at its end tag, at the next item (also one inside it) or at the end of
    the list, so items that are nested or left open are found.
    """
    parts = F.split(html, r"(?i)<li(?:\s[^>]*)?>", -1)
    opened = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.transform(opened, lambda x: F.get(F.split(x, r"(?i)</(?:li|ul|ol)\b", 2), F.lit(0)))


def _character(code: Column) -> Column:
    """Character of a number such as ``233`` or ``xE9``; NULL if there is none."""
    hexadecimal = F.lower(F.substring(code, 1, 1)) == "x"
    n = F.when(hexadecimal, F.conv(F.substring(code, 2, 6), 16, 10)).otherwise(code).cast("int")
    known = n.between(1, 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return F.when(known, F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))


def numeric_entities(text: Column) -> Column:
    """Decimal and hexadecimal character references decoded; unknown ones stay."""
    codes = F.regexp_extract_all(text, F.lit(NUMERIC), F.lit(1))
    decoded = F.transform(
        codes, lambda c: F.coalesce(_character(c), F.concat(F.lit("&#"), c, F.lit(";")))
    )
    pieces = F.zip_with(
        F.split(text, NUMERIC, -1), decoded, lambda gap, c: F.concat(gap, F.coalesce(c, F.lit("")))
    )
    return F.when(F.contains(text, F.lit("&#")), F.array_join(pieces, "")).otherwise(text)


def first_link(html: Column) -> Column:
    """Inner HTML of the first ``<a>`` element, '' if there is none."""
    return F.regexp_extract(html, r"(?is)<a(?:\s[^>]*)?>(.*?)</a\s*>", 1)


def inner_text(html: Column) -> Column:
    """Text with tags removed, numeric and the common named entities decoded."""
    text = numeric_entities(F.regexp_replace(html, r"(?s)<[^>]*>", ""))
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text
