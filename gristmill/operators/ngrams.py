"""Perplexity under an interpolated trigram model with absolute discounts.

Counts of trigrams are those of the corpus; a lower order counts in how many contexts an
n-gram goes on from (Kneser and Ney). Each order takes a discount D = n1 / (n1 + 2 * n2)
off every count, where n1 and n2 are the numbers of n-grams counted once and twice, and
gives what it has taken to the next lower order; the lowest one shares it among its words
and one unknown word. An unseen context leaves all to the lower order.

The model is a table of cells (``cells``), compressed arrays of all trigrams of some middle
words, from which all counts of order 3 and 2 follow. Words go by 64-bit hashes of group and
word; two of 10 million words share one by a chance of 1 in 300,000. Such two would be
counted as one. Texts send their trigrams to the cells, again as compressed arrays, and get
one sum for each cell they meet. Of order 1 the frequent words are broadcast, up to a bound;
trigrams that end in other words meet their counts in a join. Only what a trigram takes in
these arrays is shuffled, some 5 bytes; shuffles are deleted as soon as their result is staged.

No task holds the vocabulary of a group, or more than a cell and what one task has sent to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from gristmill.operators import cells
from gristmill.sources.staging import stage, staged

#: Groups a model may have; more are refused, as their discounts are broadcast.
MAX_GROUPS = 100_000


#: Known words of a model, the most frequent ones. They are broadcast, some 30 bytes each.
BROADCAST_WORDS = 2_000_000
#: Trigrams of the corpus for a cell, on average.
CELL_TRIGRAMS = 2_000_000
#: Words are counted in so many parts.
PARTS = 64

BLOBS = "part int, blob binary"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass
class NgramModel:
    """Staged tables: cells with their trigrams, the sums of contexts that are in several cells
    (part, blob), and of words that are not known, where there are any, the counts for their
    cells (part, blob) and for all (w, c). Broadcast: the known words, and their counts with the discounts and sums of each group."""

    cells: DataFrame
    contexts: DataFrame | None
    counts: DataFrame | None
    words: DataFrame | None
    known: Broadcast
    fitted: Broadcast
    count: int


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within the block, the files of a shuffle go when the query that needs them has ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _texts(df: DataFrame, text: str, by: str, *keep: str) -> DataFrame:
    """(group, text, keep...) of the texts of groups."""
    found = df.where(F.col(by).isNotNull() & F.col(text).isNotNull())
    return found.select(F.xxhash64(by), F.lower(F.col(text)), *keep)


def _dealt(df: DataFrame, parts: int, *columns: str) -> DataFrame:
    return df.repartition(parts, columns[0]).sortWithinPartitions(*columns)


def _known(counts: DataFrame) -> tuple[dict, bool]:
    """The known words and the number of cells, and whether all words are known."""
    if counts.select("g").distinct().limit(MAX_GROUPS + 1).count() > MAX_GROUPS:
        raise ValueError(f"more than {MAX_GROUPS} groups")
    groups = np.sort(counts.select("g").distinct().toArrow().column("g").to_numpy())
    words, total = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequent = counts
    if words > BROADCAST_WORDS:
        least, left = None, BROADCAST_WORDS
        for n, many in counts.groupBy("n").count().orderBy(F.desc("n")).collect():
            left -= many
            if left < 0:
                break
            least = n
        frequent = counts.where(F.col("n") >= least if least is not None else F.lit(False))
    g, h, n = (c.to_numpy() for c in frequent.toArrow().columns)
    by = np.lexsort((h, -n))
    g, h, n = g[by], h[by], n[by]
    sort = np.argsort(h)
    count = max(4, min(32, total // 100_000), -(-total // CELL_TRIGRAMS))
    # A word with more trigrams than a cell has on average is dealt to several.
    hot = int((n * count > total).sum())
    return {
        "sorted": h[sort],
        "code": sort.astype(np.int32),
        "group": np.searchsorted(groups, g).astype(np.int32),
        "groups": groups,
        "cells": count,
        "hot": np.arange(hot),
        "deals": np.minimum(-(-n[:hot] * count // max(total, 1)), count),
    }, words <= BROADCAST_WORDS


def _discount(n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    all_ = n1 + 2 * n2
    return np.divide(n1, all_, out=np.zeros(len(n1)), where=all_ > 0)


def _fitted(known: dict, complete: bool, table: DataFrame, words: DataFrame) -> dict:
    """What is small: sums of all cells, and the counts of known words."""
    groups, size, hot = len(known["groups"]), len(known["sorted"]), len(known["hot"])
    n = [np.zeros(groups, np.int64) for _ in range(4)]
    total, types = np.zeros(hot, np.int64), np.zeros(hot, np.int64)
    for blob in table.select("sums").toArrow().column(0):
        *counted, at, some_total, some_types = cells.unpacked(blob.as_py())
        for c, more in zip(n, counted, strict=True):
            c += more
        total[at] += some_total
        types[at] += some_types
    ones, twos = (F.count_if(F.col("c") == i) for i in (1, 2))
    sums = words.where("g IS NOT NULL").groupBy("g").agg(F.sum("c"), F.count(F.lit(1)), ones, twos).toArrow()
    g, *found = (c.to_numpy() for c in sums.columns)
    total1, types1, n1, n2 = (np.zeros(groups, np.int64) for _ in range(4))
    for column, c in zip((total1, types1, n1, n2), found, strict=True):
        column[g] = c
    code, c = (c.to_numpy() for c in words.where("code >= 0").select("code", "c").toArrow().columns)
    # The last one is that of a word that is not known.
    c1 = np.zeros(size + 1, np.int32 if total1.max(initial=0) < 2**31 else np.int64)
    c1[code] = c
    return {
        "c1": c1, "complete": complete, "hot_total": total, "hot_types": types,
        "total1": total1, "types1": types1, "d1": _discount(n1, n2), "d2": _discount(*n[2:]), "d3": _discount(*n[:2]),
    }


def fit_ngrams(df: DataFrame, text: str = "text", by: str = "lang") -> NgramModel:
    """The model of each group of texts; a NULL group has no model."""
    spark, texts = df.sparkSession, _texts(df, text, by)
    share = spark.sparkContext.broadcast
    with _shuffles_deleted(spark):
        counted = _dealt(texts.mapInArrow(cells.count_words(PARTS), BLOBS), PARTS // 2, "part")
        with staged(counted.mapInArrow(cells.sum_words(), "g long, h long, n long"), "counts") as counts:
            held, complete = _known(counts)
        known, count = share(held), held["cells"]
        parts = min(count, PARTS)
        dealt = _dealt(texts.mapInArrow(cells.deal_counts(known), BLOBS), count, "part")
        schema = "cell int, model binary, contexts array<binary>, words array<binary>, sums binary"
        table = stage(dealt.mapInArrow(cells.fit_cells(known, parts), schema), "cells")

        def by_part(column: str) -> DataFrame:
            return _dealt(table.select(F.posexplode(column).alias("part", "blob")), parts, "part")

        schema = "code int, w long, g int, c long, " + BLOBS
        with staged(by_part("words").mapInArrow(cells.sum_types(known), schema), "types") as types:
            fitted = share(_fitted(held, complete, table, types))
            counts = words = contexts = None
            if not complete:
                counts = stage(types.where("part IS NOT NULL").select("part", "blob"), "counts")
                words = stage(types.where("code < 0").select("w", "c"), "words")
        if len(held["hot"]):
            contexts = stage(by_part("contexts").mapInArrow(cells.merge_contexts(known), BLOBS), "contexts")
    return NgramModel(table, contexts, counts, words, known, fitted, count)


def _sums(rows: DataFrame, model: NgramModel, trigrams: bool = False) -> DataFrame:
    """(key, _s, _n) of the rows (group, text, key) or (group, u, v, w, key): the sum of the
    logarithms of their probabilities. A key comes as often as its rows."""
    dealt = rows.mapInArrow(
        cells.deal_texts(model.known, trigrams), "cell int, kind int, chunk long, blob binary"
    )

    def of_model(df: DataFrame, kind: int, cell: str, blob: str) -> DataFrame:
        return df.select(F.col(cell), F.lit(kind), F.lit(None).cast("long"), F.col(blob))

    both = dealt.union(of_model(model.cells, cells.MODEL, "cell", "model"))
    for table, kind in ((model.contexts, cells.CONTEXTS), (model.counts, cells.COUNTS)):
        if table is not None:
            both = both.union(of_model(table, kind, "part", "blob"))
    schema = "chunk long, keys binary, sums binary, w long, text int, a double, b double, d double"
    scored = _dealt(both, model.count, "cell", "kind").mapInArrow(
        cells.score_cells(model.known, model.fitted), schema
    )
    found, none = scored.select("chunk", "keys", "sums", "text"), F.lit(None)
    found = found.withColumn("p", none.cast("double"))
    if model.words is not None:
        # Staged, as sums go one way and trigrams that lack a count another.
        with _shuffles_deleted(rows.sparkSession):
            scored = stage(scored, "scored")
        c = F.coalesce("c", F.lit(0).cast("long"))
        p = F.col("a") + F.col("b") * F.greatest(c - F.col("d"), F.lit(0.0))
        rest = scored.where("w IS NOT NULL").join(model.words, "w", "left")
        found = scored.where("w IS NULL").select(*found.columns[:-1], none.cast("double").alias("p")).union(
            rest.select(*found.columns[:-1], p.alias("p"))
        )
    key = rows.schema.fields[-1]
    schema = StructType([StructField(key.name, key.dataType), StructField("_s", DoubleType()), StructField("_n", LongType())])
    return _dealt(found, model.count, "chunk").mapInArrow(cells.sum_texts(), schema)


def probabilities(needed: DataFrame, model: NgramModel) -> DataFrame:
    """(by, u, v, w, p) of different trigrams; those of a group without a model are left out."""
    # NULL is no word, as a blank is none.
    words = [F.coalesce(c, F.lit(" ")) for c in ("u", "v", "w")]
    rows = needed.where("by IS NOT NULL").select(
        F.xxhash64("by"), *words, F.struct("by", "u", "v", "w").alias("_t")
    )
    p = F.when(F.col("_n") > 0, F.exp("_s")).otherwise(0.0)
    return _sums(rows, model, trigrams=True).select("_t.*", p.alias("p"))


def ngram_perplexity(
    df: DataFrame, model: NgramModel, key: str = "doc_id", text: str = "text", by: str = "lang"
) -> DataFrame:
    """(key, perplexity) of each text under the model of its group.

    Texts without a word, and those of groups without a model, have no row. The key is
    unique.
    """
    mean = F.try_divide(F.sum("_s"), F.sum("_n"))
    return _sums(_texts(df, text, by, key), model).groupBy(key).agg(F.exp(-mean).alias("perplexity"))
