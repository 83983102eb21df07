"""Periodic runs of words by a dictionary of basic factors.

Level k of the dictionary names the factors of 2**k words: equal factors of one document
have equal names, and a name of level k + 1 is a pair of names of level k. Only factors
that occur again are kept, so a level of ordinary prose is soon empty. Per level, the
occurrences of a factor that follow each other closely form an arithmetic progression,
and progressions within twice the factor's length propose periods (see ``proposals``).
Proposals of one distance that touch or overlap are one stretch. Each is extended to both
sides by the dictionary itself, from the longest factors to the shortest; what is long
enough is a run. Runs of one extent are one run with the least of their periods.

Rows stay in their partition. Documents of a batch are named together, in blocks of
bounded size; a document longer than a block is one of its own, with memory in proportion
to its words and the levels on which they repeat.

Defined results: NULL, empty and blank texts have no words and no runs, and collapse to
the empty text; repeated rows and NULL keys give one result each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gristmill.functions.text import let
from gristmill.llm.common import freed

#: Bytes of text named together.
BLOCK_BYTES = 1_000_000
#: Words a run has at least; it also has to hold its period twice.
MIN_LENGTH = 12

RESULT = (
    "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"
)


def repeated(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose code occurs more than once, ascending, and small names for the codes."""
    _, names, counts = np.unique(codes, return_inverse=True, return_counts=True)
    again = counts[names] > 1
    return at[again], names[again]


def dictionary(codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(positions, names) of the factors that occur again, by level."""
    levels = [repeated(codes, np.arange(len(codes)))]
    while len(levels[-1][0]):
        at, names = levels[-1]
        other = np.searchsorted(at, at + (1 << (len(levels) - 1)))
        other[other == len(at)] = 0
        whole = at[other] == at + (1 << (len(levels) - 1))
        pairs = names[whole] * np.int64(names.max() + 1) + names[other[whole]]
        levels.append(repeated(pairs, at[whole]))
    return levels[:-1]


def same(level: tuple[np.ndarray, np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the factors at ``a`` and at ``b`` are equal; positions may lie outside."""
    at, names = level
    i, j = (np.minimum(np.searchsorted(at, x), len(at) - 1) for x in (a, b))
    return (at[i] == a) & (at[j] == b) & (names[i] == names[j])


def proposals(at: np.ndarray, names: np.ndarray, width: int):
    """(first, end, distance): words first..end equal those that distance further on.

    Occurrences of a factor that overlap by half form a progression, whose difference is
    the factor's period, and is proposed. Of two progressions within reach, the last
    occurrence of the first one is held against each of the second, and each of the first
    one against the first of the second: a run that joins them is aligned with one of
    their ends, or is one of a family that these pairs list.
    """
    order = np.argsort(names, kind="stable")
    here, named = at[order], names[order]
    opens = np.ones(len(here), dtype=bool)
    opens[1:] = (named[1:] != named[:-1]) | (here[1:] - here[:-1] > width // 2)
    lo = np.flatnonzero(opens)
    hi = np.append(lo[1:], len(here)) - 1 if len(lo) else lo
    several = lo < hi
    found = [(here[lo], here[hi - 1] + width, here[np.minimum(lo + 1, hi)] - here[lo])]
    found = [tuple(x[several] for x in found[0])]
    one, two = np.arange(len(lo)), np.arange(len(lo))
    while len(one):
        one, two = one[two < len(lo) - 1], two[two < len(lo) - 1] + 1
        near = (named[lo[one]] == named[lo[two]]) & (here[lo[two]] - here[hi[one]] <= 2 * width)
        one, two = one[near], two[near]
        for a, b in (
            (np.repeat(hi[one], hi[two] - lo[two] + 1), each(lo[two], hi[two])),
            (each(lo[one], hi[one]), np.repeat(lo[two], hi[one] - lo[one] + 1)),
        ):
            first, gap = here[a], here[b] - here[a]
            reach = gap <= 2 * width
            found.append((first[reach], first[reach] + width, gap[reach]))
    return stretches(*(np.concatenate(x) for x in zip(*found, strict=True)))


def each(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The numbers lo..hi of every pair, one pair after the other."""
    sizes = hi - lo + 1
    return np.arange(sizes.sum()) + np.repeat(lo - np.cumsum(sizes) + sizes, sizes)


def stretches(first: np.ndarray, end: np.ndarray, gap: np.ndarray):
    """Proposals of one distance that touch or overlap, as one each."""
    order = np.lexsort((first, gap))
    first, end, gap = first[order], end[order], gap[order]
    # Ends are compared with all before them of the same distance: shift each distance
    # beyond the one before it.
    span = np.int64(end.max() + 1) if len(end) else np.int64(1)
    group = np.cumsum(np.append(False, gap[1:] != gap[:-1])) if len(gap) else gap
    reach = np.maximum.accumulate(group * span + end)
    opens = np.ones(len(first), dtype=bool)
    opens[1:] = group[1:] * span + first[1:] > reach[:-1]
    heads = np.flatnonzero(opens)
    tails = np.append(heads[1:], len(first)) - 1 if len(heads) else heads
    return first[heads], reach[tails] - group[tails] * span, gap[heads]


def find_runs(codes: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period."""
    levels = dictionary(codes)
    found = [proposals(at, names, 1 << k) for k, (at, names) in enumerate(levels)]
    if not found:
        return np.empty((0, 3), dtype=np.int64)
    first, end, period = (np.concatenate(x) for x in zip(*found, strict=True))
    for k in reversed(range(len(levels))):
        end = end + (same(levels[k], end, end + period) << k)
    for k in reversed(range(len(levels))):
        before = first - (1 << k)
        first = first - (same(levels[k], before, before + period) << k)
    end = end + period
    long = end - first >= np.maximum(min_length, 2 * period)
    rows = np.stack([first[long], end[long], period[long]], axis=1)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    least = np.ones(len(rows), dtype=bool)
    least[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[least]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def blocks(texts: pa.Array) -> Iterator[list[bytes]]:
    """The texts as bytes, in order, in lists of bounded size; NULL is the empty text."""
    block, size = [], 0
    for text in texts.cast(pa.binary()):
        block.append(text.as_py() or b"")
        size += len(block[-1])
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def measure(texts: list[bytes], min_length: int) -> list[dict]:
    """Words, runs and the collapsed text of each text of a block."""
    cut = [t.split() for t in texts]
    ends = np.cumsum([len(words) for words in cut], dtype=np.int64)
    index: dict[bytes, int] = {}
    ids = np.fromiter(
        (index.setdefault(w, len(index)) for words in cut for w in words), np.int64, ends[-1]
    )
    owner = np.repeat(np.arange(len(cut)), [len(words) for words in cut])
    runs = find_runs(owner * np.int64(len(index)) + ids, min_length)
    whose = np.searchsorted(ends, runs[:, 0], side="right")
    bounds = np.searchsorted(whose, np.arange(len(cut) + 1))
    results = []
    for i, words in enumerate(cut):
        own = runs[bounds[i] : bounds[i + 1]]
        kept = words
        if len(own):
            own = own - np.array([ends[i] - len(words), ends[i] - len(words), 0])
            step = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(step, own[:, 0] + own[:, 2], 1)
            np.add.at(step, own[:, 1], -1)
            kept = [w for w, covered in zip(words, np.cumsum(step)[:-1], strict=True) if not covered]
        results.append(
            {
                "n_words": len(words),
                "runs": [
                    {"start": a, "length": b - a, "period": p} for a, b, p in own.tolist()
                ],
                "collapsed": b" ".join(kept),
            }
        )
    return results


RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
#: As RESULT; the text crosses as bytes, which need not be checked again.
RESULT_ARROW = pa.struct(
    [("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.binary())]
)


def scan(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH) -> DataFrame:
    """All rows; the text gives way to ``periodic``, a struct (n_words, runs, collapsed).

    ``runs`` is ordered by start, then period. ``collapsed`` holds the words that no run
    contains after its first period, joined by blanks.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text]
    given = docs.select(F.col(f"`{text}`").alias("_text"), *others)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            at = 0
            for block in blocks(batch.column(0)):
                rows = batch.slice(at, len(block))
                at += len(block)
                found = pa.array(measure(block, min_length), RESULT_ARROW)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], found], [*rows.schema.names[1:], "periodic"]
                )

    schema = StructType(given.schema.fields[1:]).add("periodic", StructType.fromDDL(RESULT))
    found = given.mapInArrow(work, schema)
    plain = F.col("periodic.collapsed").cast("string").alias("collapsed")
    return found.withColumn("periodic", F.struct("periodic.n_words", "periodic.runs", plain))


def words(text: Column) -> Column:
    """Words between ASCII blanks; none of a NULL."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")


def planted(doc_id: Column, text: Column) -> Column:
    """The text; in one of ten documents, by a hash of the id, its end repeats a stretch.

    With h = crc32(id), g = h / 10 and n words, the words from a = g % n on become the
    stretch of p = 1 + (n - a) / (3 + g % 8) words that starts there, over and over.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(found: Column) -> Column:
        n = F.size(found)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return let(
            F.struct(a.alias("a"), p.alias("p")),
            lambda v: F.array_join(
                F.transform(
                    found,
                    lambda w, i: F.when(i < v["a"], w).otherwise(
                        F.get(found, (v["a"] + (i - v["a"]) % v["p"]).cast("int"))
                    ),
                ),
                " ",
            ),
        )

    chosen = (h % 10 == 0) & (F.length(F.coalesce(text, F.lit(""))) > 0)
    return F.when(
        chosen, let(words(text), lambda found: F.when(F.size(found) > 0, periodic(found)))
    ).otherwise(text)


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """The row of each document: its longest run, and hashes of all runs and of what stays.

    Ties between longest runs go to the smallest start, then the smallest period.
    """
    runs = F.col("periodic.runs")
    lines = F.transform(
        runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    longest = F.array_min(
        F.transform(
            runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"], r["period"])
        )
    )
    return (
        found.withColumn("_longest", longest)
        .withColumn("_length", -F.col("_longest.less"))
        .select(
            key,
            F.size(runs).cast("long").alias("n_runs"),
            F.col("_longest.start").alias("start"),
            F.col("_length").alias("length"),
            F.col("_longest.period").alias("period"),
            F.floor(F.lit(1000) * F.col("_length") / F.col("_longest.period"))
            .cast("long")
            .alias("exponent_milli"),
            F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
            F.sha2(F.col("periodic.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
        )
    )
