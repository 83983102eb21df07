"""Token counts by section, from one encoding of the whole document.

A document is encoded once, as its tokens depend on what stands around them. Token
lengths in bytes give each token's span of characters, and an interval join by
binary search finds the sections a span touches. Tokens that cross a boundary are
allotted by a stated rule:

* ``start``: the section that holds the token's first character;
* ``most``: the section that holds most of its characters, the first of equals;
* ``share``: every section by its share of the token's characters.

The join is within a row, so there is no shuffle. Sections are an array column of
structs (start, end), sorted and without overlap; without one, each line with its
line feed is a section. Tokens outside all sections belong to none.

Defined results: NULL and empty texts have no lines and no tokens; with given
sections these count 0. Empty sections count 0. A NULL section array has no sections.
Rows that are repeated are counted each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.llm.bpe import read_ranks

RULES = ("start", "most", "share")
COUNTS = "array<struct<section:int,start:int,end:int,tokens:double>>"
_KIND = pa.list_(
    pa.struct(
        [("section", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("tokens", pa.float64())]
    )
)


def line_sections(text: str) -> np.ndarray:
    """(start, end) of each line, its line feed included."""
    ends = np.cumsum([len(line) + 1 for line in text.split("\n")])
    ends[-1] -= 1  # no line feed ends the last one
    starts = np.concatenate([[0], ends[:-1]])
    full = starts < ends
    return np.stack([starts[full], ends[full]], axis=1)


def token_spans(ids: np.ndarray, lengths: np.ndarray, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last-but-one character of each token; a split character belongs to all its tokens."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    first = np.frombuffer(data, dtype=np.uint8) & 0xC0 != 0x80
    if first.all():
        return starts, ends
    character = np.cumsum(first) - 1
    return character[starts], character[ends - 1] + 1


def allot(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section."""
    count = np.zeros(len(sections))
    if not len(sections) or not len(starts):
        return count
    low, high = sections[:, 0], sections[:, 1]
    if rule == "start":
        at = np.searchsorted(low, starts, side="right") - 1
        inside = (at >= 0) & (starts < high[np.maximum(at, 0)])
        return np.bincount(at[inside], minlength=len(sections)).astype(float)
    # Sections a token touches: from the first that ends after its start.
    begin = np.searchsorted(high, starts, side="right")
    stop = np.searchsorted(low, ends, side="left")
    touched = np.maximum(stop - begin, 0)
    token = np.repeat(np.arange(len(starts)), touched)
    place = np.arange(touched.sum()) - np.repeat(np.cumsum(touched) - touched, touched)
    section = begin[token] + place
    common = np.minimum(ends[token], high[section]) - np.maximum(starts[token], low[section])
    if rule == "share":
        np.add.at(count, section, np.maximum(common, 0) / (ends - starts)[token])
        return count
    order = np.lexsort((section, -common, token))
    token, section, common = token[order], section[order], common[order]
    best = np.concatenate([[True], token[1:] != token[:-1]])[: len(token)] & (common > 0)
    return np.bincount(section[best], minlength=len(sections)).astype(float)


class Encoder:
    """A rank file sent to the workers; its size is that of the file."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.shared = spark.sparkContext.broadcast({"tokens": read_ranks(path), "pattern": pattern})

    def counts(self, text: Column, sections: Column | None = None, rule: str = "start") -> Column:
        """Array of (section, start, end, tokens) of a text."""
        if rule not in RULES:
            raise ValueError(f"unknown rule {rule!r}")
        shared = self.shared

        def held() -> tuple:
            # A worker keeps the broadcast, and with it the encoder, from task to task.
            state = shared.value
            if "encoder" not in state:
                import tiktoken

                state["encoder"] = tiktoken.Encoding(
                    "given",
                    pat_str=state["pattern"],
                    mergeable_ranks={t: i for i, t in enumerate(state["tokens"])},
                    special_tokens={},
                )
                state["lengths"] = np.array([len(t) for t in state["tokens"]], dtype=np.int64)
            return state["encoder"], state["lengths"]

        def row(text: str | None, given) -> tuple[np.ndarray, np.ndarray]:
            text = text or ""
            encoder, lengths = held()
            cuts = line_sections(text) if given is None else given
            ids = encoder.encode_to_numpy(text, disallowed_special=()).astype(np.int64)
            return cuts, allot(*token_spans(ids, lengths, text.encode()), cuts, rule)

        def packed(rows) -> pa.Array:
            rows = list(rows)
            offsets = np.cumsum([0] + [len(c) for c, _ in rows]).astype(np.int32)
            cuts = np.concatenate([c for c, _ in rows] or [np.zeros((0, 2), np.int64)])
            fields = [
                np.concatenate([np.arange(len(c)) for c, _ in rows] or [np.zeros(0)]).astype(np.int32),
                cuts[:, 0].astype(np.int32),
                cuts[:, 1].astype(np.int32),
                np.concatenate([n for _, n in rows] or [np.zeros(0)]),
            ]
            names = [f.name for f in _KIND.value_type]
            values = pa.StructArray.from_arrays([pa.array(f) for f in fields], names)
            return pa.ListArray.from_arrays(pa.array(offsets), values)

        def spans(value) -> np.ndarray:
            found = [(s["start"], s["end"]) for s in value.as_py() or []]
            return np.array(found, dtype=np.int64).reshape(-1, 2)

        if sections is None:

            @F.arrow_udf(COUNTS)
            def by_line(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
                for texts in batches:
                    yield packed(row(t.as_py(), None) for t in texts)

            return by_line(text)

        @F.arrow_udf(COUNTS)
        def by_section(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for texts, given in batches:
                yield packed(row(t.as_py(), spans(s)) for t, s in zip(texts, given, strict=True))

        return by_section(text, sections)


def section_counts(
    docs: DataFrame, encoder: Encoder, key: str = "doc_id", text: str = "text",
    sections: str | None = None, rule: str = "start",
) -> DataFrame:
    """(key, section, start, end, tokens): one row per section of each row of ``docs``."""
    given = None if sections is None else F.col(sections)
    counts = encoder.counts(F.col(text), given, rule)
    return docs.select(F.col(key), F.explode(counts).alias("_c")).select(key, "_c.*")
