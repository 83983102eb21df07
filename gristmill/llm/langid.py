"""Language identification by rank-order profiles.

A profile is the list of the most frequent character n-grams (1 to 3) of a
language, in order. A document gets a profile of its own, and the language whose
profile is nearest wins: for each n-gram of the document the difference of the two
ranks, or the greatest difference when the language lacks it.

Counts of n-grams leave a task once per batch and language and are summed before
the profiles are cut, so training covers every row with two narrow columns. A
profile has ``SIZE`` rows for each language, whatever the data.

Defined results: NULL texts and texts without a letter are ``und`` with score 0.
Ties between n-grams go to the smaller code, between languages to the first in
alphabetical order. Rows with a NULL language train nothing. Without any training
text every document is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Entries of a profile, and the longest n-gram (three code points fit in 63 bits).
SIZE = 400
LONGEST = 3
#: Languages a table may name; more are refused, as their profiles travel to every task.
MAX_LANGUAGES = 1_000
UNKNOWN = "und"
_BLANK = 32


def letter_table(spark: SparkSession):
    """Broadcast of one bit per code point: is it a letter?"""
    alpha = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool)
    return spark.sparkContext.broadcast(np.packbits(alpha))


def letters(text: str, alpha: np.ndarray) -> np.ndarray:
    """Code points in lower case, runs of anything but letters as one blank, blanks around."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    padded = np.full(len(points) + 2, _BLANK, dtype=np.int64)
    padded[1:-1] = np.where(alpha[points], points, _BLANK)
    blank = padded == _BLANK
    blank[1:] &= blank[:-1]
    blank[0] = False
    return padded[~blank]


def ngrams(points: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of up to ``LONGEST`` letters; blanks are letters at their ends only."""
    found = []
    for n in range(1, LONGEST + 1):
        m = len(points) - n + 1
        if m <= 0:
            break
        code = np.zeros(m, dtype=np.int64)
        for k in range(n):
            code = (code << 21) | points[k : k + m]
        keep = np.ones(m, dtype=bool)
        if n == 1:
            keep = points != _BLANK
        for k in range(1, n - 1):
            keep &= points[k : k + m] != _BLANK
        found.append(code[keep])
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)])
    return codes[first], np.diff(np.append(first, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, best first."""
    if len(codes) > 2 * size:
        # Ties at the edge stay in, so the order alone decides.
        edge = np.partition(counts, len(counts) - size)[len(counts) - size]
        codes, counts = codes[counts >= edge], counts[counts >= edge]
    return codes[np.lexsort((codes, -counts))][:size]


def count_ngrams(rows: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, code, n) summed over all rows with a language."""
    table = letter_table(rows.sparkSession)

    def per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alpha = np.unpackbits(table.value).astype(bool)
        for batch in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            for text_value, name in zip(batch.column(0), batch.column(1), strict=True):
                found = by_lang.setdefault(name.as_py(), [])
                found.append(ngrams(letters(text_value.as_py(), alpha)))
                if len(found) >= 500:
                    merge(by_lang, name.as_py())
            for name, found in by_lang.items():
                merge(by_lang, name)
                (codes, counts) = by_lang[name][0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                    ["lang", "code", "n"],
                )

    def merge(by_lang, name):
        """Replace what was found for a language by one pair of codes and counts."""
        plain = [f for f in by_lang[name] if isinstance(f, np.ndarray)]
        pairs = [f for f in by_lang[name] if isinstance(f, tuple)]
        if plain:
            pairs.append(counted(np.concatenate(plain)))
        codes = np.concatenate([c for c, _ in pairs])
        counts = np.concatenate([n for _, n in pairs])
        distinct, at = np.unique(codes, return_inverse=True)
        total = np.bincount(at, counts, len(distinct)).astype(np.int64)
        by_lang[name] = [(distinct, total)]

    given = rows.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(text, lang)
    counts = given.mapInArrow(per_batch, "lang string, code long, n long")
    return counts.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def profiles(rows: DataFrame, text: str = "text", lang: str = "lang", size: int = SIZE):
    """Language -> codes in order of rank, learnt from all given rows."""
    counts = count_ngrams(rows, text, lang)
    # Heads of buckets first, and limited before they meet: no task sorts or holds all
    # n-grams of a large language.
    in_bucket = Window.partitionBy("lang", F.pmod(F.xxhash64("code"), F.lit(64))).orderBy(
        F.desc("n"), F.asc("code")
    )
    heads = counts.withColumn("rank", F.row_number().over(in_bucket)).where(F.col("rank") <= size)
    best = heads.groupBy("lang").agg(
        F.slice(
            F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "code"))), 1, size
        ).alias("head")
    )
    found = best.select("lang", F.col("head.code").alias("codes")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r["lang"]: np.array(r["codes"], dtype=np.int64) for r in sorted(found, key=lambda r: r["lang"])}


class Ranks:
    """All profiles as one sorted list of codes and a table of ranks by language."""

    def __init__(self, by_lang: dict[str, np.ndarray], size: int):
        self.languages = list(by_lang)
        self.size = size
        self.codes = np.unique(np.concatenate(list(by_lang.values())))
        self.rank = np.full((len(by_lang), len(self.codes) + 1), -1, dtype=np.int64)
        for i, codes in enumerate(by_lang.values()):
            self.rank[i, np.searchsorted(self.codes, codes)] = np.arange(len(codes))

    def nearest(self, text: str, alpha: np.ndarray) -> tuple[str, float]:
        codes = ranked(*counted(ngrams(letters(text, alpha))), self.size)
        if not len(codes):
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        rank = self.rank[:, np.where(self.codes[at] == codes, at, len(self.codes))]
        far = np.abs(rank - np.arange(len(codes)))
        distance = np.where(rank < 0, self.size, far).sum(1)
        best = int(np.argmin(distance))
        return self.languages[best], 1 - distance[best] / (self.size * len(codes))


def predict(text: Column, by_lang: dict[str, np.ndarray], size: int = SIZE) -> Column:
    """Struct (lang_pred, score): the nearest language and 1 less the share of the greatest distance."""
    if not by_lang:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    ranks, table = Ranks(by_lang, size), letter_table(SparkSession.active())

    @F.arrow_udf("lang_pred string, score double")
    def nearest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        alpha = np.unpackbits(table.value).astype(bool)
        for texts in batches:
            found = [ranks.nearest(t.as_py() or "", alpha) for t in texts]
            yield pa.StructArray.from_arrays(
                [
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["lang_pred", "score"],
            )

    return nearest(text)
