"""Spans of regular expressions in texts, as columns of built-in functions.

Positions count code points from 0, ends are exclusive. Every function here takes time in
proportion to text and spans, but for sorting: a fold that appends to one long array would
copy it for each element, so ``fold`` goes through blocks and appends to short ones, and
no position is found by counting from the start of a text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import let

SPAN = "struct<s:int,e:int,v:string,before:string>"
#: Elements of an array that are folded together.
BLOCK = 128
#: Characters of text kept from before a span.
AROUND = 24


def no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def fold(
    rows: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column, Column]], kind: str
) -> Column:
    """What ``step`` gives for the elements of an array, in order, as an array of ``kind``.

    ``step(state, x)`` returns the next state, whether x gives something, and what.
    """
    nothing = F.array().cast(f"array<{kind}>")

    def one(acc: Column, x: Column) -> Column:
        state, gives, what = step(acc["state"], x)
        out = F.when(gives, F.array_append(acc["out"], what)).otherwise(acc["out"])
        return F.struct(state.alias("state"), out.alias("out"))

    def block(acc: Column, xs: Column) -> Column:
        first = F.struct(acc["state"].alias("state"), nothing.alias("out"))
        return let(
            F.aggregate(xs, first, one),
            lambda r: F.struct(
                r["state"].alias("state"), F.array_append(acc["outs"], r["out"]).alias("outs")
            ),
        )

    first = F.struct(start.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("outs"))

    def through(rows: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda b: F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)))
        whole = F.aggregate(blocks, first, block, lambda acc: F.flatten(acc["outs"]))
        return F.when(F.size(rows) > 0, whole).otherwise(nothing)

    # Bound once: an expression that lambdas refer to is worked out anew for each block.
    return let(rows, through)


def find_spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches of a pattern as array of (s, e, v, before).

    The text between the matches comes from ``split`` with the same pattern, so a
    match starts where the lengths of all pieces and matches before it end. ``before``
    is the text in front of a match, of ``AROUND`` characters at most.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.filter(
        F.zip_with(gaps, found, lambda gap, v: F.struct(gap.alias("gap"), v.alias("v"))),
        lambda x: x["v"].isNotNull(),
    )

    def follow(state: Column, x: Column) -> tuple[Column, Column, Column]:
        s = state["at"] + F.length(x["gap"])
        before = F.right(F.concat(state["tail"], x["gap"]), F.lit(AROUND))
        e = s + F.length(x["v"])
        tail = F.right(F.concat(before, x["v"]), F.lit(AROUND))
        span = F.struct(s.alias("s"), e.alias("e"), x["v"].alias("v"), before.alias("before"))
        return F.struct(e.alias("at"), tail.alias("tail")), F.lit(True), span

    return fold(pairs, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")), follow, SPAN)


def kind_spans(text: Column, kind: str, order: int, pattern: str, gate: Column, ok) -> Column:
    """Valid spans of one kind as array of (s, k, e, kind, v); ``gate`` tells texts without any."""
    valid = F.filter(find_spans(text, pattern), lambda x: ok(x["v"]))
    tagged = F.transform(
        F.when(gate, valid).otherwise(no_spans()),
        lambda x: F.struct(
            x["s"].alias("s"),
            F.lit(order).alias("k"),
            x["e"].alias("e"),
            F.lit(kind).alias("kind"),
            x["v"].alias("v"),
        ),
    )
    return tagged


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas, in the order given."""
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")),
        ),
        ",",
    )


def without_overlap(added: Column, base: Column, kind: str) -> Column:
    """Spans of ``added`` that share no code point with one of ``base``, by start.

    ``kind`` is the type of an added span. One pass forward over both, by start, with the
    furthest end of a base span so far; one back with the nearest start after it.
    """
    mark = f"struct<s:int,side:int,e:int,x:{kind}>"

    def ends(spans: Column, side: int) -> Column:
        value = (lambda x: x) if side else (lambda x: F.lit(None).cast(kind))
        return F.transform(
            spans,
            lambda x: F.struct(
                x["s"].alias("s"), F.lit(side).alias("side"), x["e"].alias("e"), value(x).alias("x")
            ),
        )

    def forward(end: Column, m: Column):
        is_base = m["side"] == 0
        return F.when(is_base, F.greatest(end, m["e"])).otherwise(end), is_base | (end <= m["s"]), m

    def back(start: Column, m: Column):
        is_base = m["side"] == 0
        return F.when(is_base, m["s"]).otherwise(start), ~is_base & (m["e"] <= start), m["x"]

    def apart(both: Column) -> Column:
        merged = F.array_sort(F.concat(ends(both["base"], 0), ends(both["added"], 1)))
        left = fold(merged, F.lit(0), forward, mark)
        kept = F.reverse(fold(F.reverse(left), F.lit(2**31 - 1), back, kind))
        some = (F.size(both["added"]) > 0) & (F.size(both["base"]) > 0)
        return F.when(some, kept).otherwise(both["added"])

    return let(F.struct(added.alias("added"), base.alias("base")), apart)


def not_inside_others(spans: Column, kind: str) -> Column:
    """Of overlapping spans the one that starts first, then the longer, then the earlier kind."""
    ordered = F.transform(
        F.array_sort(
            F.transform(
                spans,
                lambda x: F.struct(
                    x["s"].alias("s"), (-x["e"]).alias("less"), x["k"].alias("k"), x.alias("x")
                ),
            )
        ),
        lambda o: o["x"],
    )

    def step(end: Column, x: Column):
        return F.when(end <= x["s"], x["e"]).otherwise(end), end <= x["s"], x

    return fold(ordered, F.lit(0), step, kind)


def looked_up(spans: Column, table: Column, kind: str, found: str) -> Column:
    """Each span with the entry of its hash, as array of (x, found), in no given order.

    ``table`` is an array of (hash, ...) of type ``found``; spans without an entry get NULL.
    Both are sorted by hash and gone through once.
    """
    pair = f"struct<x:{kind},found:{found}>"

    def mark(of: Column, side: int) -> Column:
        def one(r: Column) -> Column:
            x = r.cast(kind) if side else F.lit(None).cast(kind)
            entry = F.lit(None).cast(found) if side else r.cast(found)
            return F.struct(
                r["hash"].alias("hash"), F.lit(side).alias("side"), x.alias("x"), entry.alias("found")
            )

        return F.transform(of, one)

    def step(last: Column, m: Column):
        is_entry = m["side"] == 0
        same = F.when(last["hash"] == m["hash"], last)
        given = F.struct(m["x"].alias("x"), same.alias("found"))
        return F.when(is_entry, m["found"]).otherwise(last), ~is_entry, given

    both = F.array_sort(F.concat(mark(table, 0), mark(spans, 1)))
    return fold(both, F.lit(None).cast(found), step, pair)


def replaced(text: Column, spans: Column, by: str) -> Column:
    """The text with each of the given spans (sorted, not overlapping) replaced.

    Texts are cut once for each block of spans, so characters are counted within a block.
    """

    def block(r: Column) -> Column:
        def within(piece: Column) -> Column:
            first = F.struct(r["start"].alias("at"), F.lit("").alias("out"))

            def step(acc: Column, x: Column) -> Column:
                gap = F.substring(piece, acc["at"] - r["start"] + 1, x["s"] - acc["at"])
                return F.struct(
                    x["e"].alias("at"), F.concat(acc["out"], gap, F.lit(by)).alias("out")
                )

            def finish(acc: Column) -> Column:
                rest = F.substring(piece, acc["at"] - r["start"] + 1, F.lit(2**31 - 1))
                return F.concat(acc["out"], rest)

            return F.aggregate(r["spans"], first, step, finish)

        return let(F.substring(text, r["start"] + 1, r["end"] - r["start"]), within)

    def through(rows: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(rows) - 1) / BLOCK).cast("int"))
        blocks = F.transform(
            numbers,
            lambda b: F.struct(
                F.slice(rows, b * BLOCK + 1, F.lit(BLOCK)).alias("spans"),
                F.when(b == 0, 0).otherwise(F.get(rows, b * BLOCK)["s"]).alias("start"),
                F.coalesce(F.get(rows, (b + 1) * BLOCK)["s"], F.lit(2**31 - 1)).alias("end"),
            ),
        )
        pieces = F.array_join(F.transform(blocks, block), "")
        return F.when(F.size(rows) > 0, pieces).otherwise(text)

    return let(spans, through)
