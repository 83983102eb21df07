"""Listed words in texts by an index of their rarest q-grams, for lists of any size.

A word is found by one of its q-grams, the one that the fewest other words share; a word
shorter than q is its own gram. A text gives the places of its grams that the index may
hold, each with as much text around it as the longest entry can take, and meets the index
in an equi-join on the gram's hash; a candidate is verified within its row. Nothing that
grows with the list is sent to the tasks: they know the grams by a bitmap of fixed size,
which lets through grams of others now and then, and never stops one of the list.

Before the join a text gives a row at most for each of its characters and gram lengths.
The text of a match is bounded by the longest entry.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.sources.staging import stage

#: Characters of a gram.
Q = 8
#: Bits of the bitmap, and of one row of it as Spark's bitmap functions build them.
BITMAP_BITS = 1 << 26
ROW_BITS = 1 << 15
#: Parts of a hot gram's rows in the join.
SALTS = 16


def _gram_hashes():
    """Function from a text to the hashes of its grams, by length.

    A closure, hence pickled whole: tasks need not import this package.
    """

    def hashes(text: str, lengths: list[int]) -> dict:
        import numpy as np

        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        points = points.astype(np.uint64) + np.uint64(1)
        rolled, found = np.zeros(len(points), dtype=np.uint64), {}
        for n in range(1, min(max(lengths, default=0), len(points)) + 1):
            rolled = rolled[: len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :]
            if n in lengths:
                x = rolled ^ (rolled >> np.uint64(30)) ^ np.uint64(n)
                x = x * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                found[n] = x ^ (x >> np.uint64(31))
        return found

    return hashes


def word_grams(word: Column, q: int) -> Column:
    """Hashes of the grams of a word, by place: of q characters, or of the whole word."""
    hashes = _gram_hashes()

    @F.pandas_udf("array<long>")
    def grams(words: pd.Series) -> pd.Series:
        return words.map(lambda w: hashes(w, [min(q, len(w))])[min(q, len(w))].view("int64"))

    return grams(word)


def bit_of(gram: Column, bits: int) -> Column:
    return F.pmod(gram, F.lit(bits))


@dataclass
class GramIndex:
    """A word list by its rarest q-grams; built once, used for any number of tables."""

    words: DataFrame
    rows: DataFrame  # (gram, word)
    shared: object  # broadcast: bitmap, and by gram length the characters needed around it
    q: int = Q

    @classmethod
    def of(cls, words: DataFrame, q: int = Q, bits: int = BITMAP_BITS) -> GramIndex:
        listed = stage(words.select("word").where("word <> ''").distinct(), "listed")
        places = listed.select(
            "word", F.posexplode(word_grams(F.col("word"), q)).alias("place", "gram")
        )
        shared_by = places.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
        rarest = places.join(shared_by, "gram").groupBy("word").agg(
            F.min(F.struct("n", "gram", "place")).alias("m")
        )
        rows = stage(rarest.select("word", "m.gram", "m.place"), "qgrams")
        size = F.least(F.length("word"), F.lit(q))
        after = F.length("word") - F.col("place") - size
        reach = {
            r["n"]: (r["before"], r["after"])
            for r in rows.groupBy(size.alias("n"))
            .agg(F.max("place").alias("before"), F.max(after).alias("after"))
            .collect()
        }
        bit = bit_of(F.col("gram"), bits)
        filled = (
            rows.select(F.floor(bit / ROW_BITS).alias("row"), (bit % ROW_BITS).alias("at"))
            .groupBy("row")
            .agg(F.call_function("bitmap_construct_agg", F.col("at")).alias("bitmap"))
            .collect()
        )
        bitmap = bytearray(bits // 8)
        for r in filled:
            at = r["row"] * ROW_BITS // 8
            bitmap[at : at + len(r["bitmap"])] = r["bitmap"]
        held = {"bitmap": bytes(bitmap), "bits": bits, "reach": reach}
        shared = words.sparkSession.sparkContext.broadcast(held)
        return cls(listed, rows.select("gram", "word"), shared, q)

    def places(self, text: Column) -> Column:
        """Array of (gram, around): grams of a text that the index may hold, with their text."""
        shared, hashes = self.shared, _gram_hashes()

        @F.pandas_udf("array<struct<gram: long, around: string>>")
        def found(texts: pd.Series) -> pd.Series:
            import numpy as np

            held = shared.value
            bitmap = np.frombuffer(held["bitmap"], dtype=np.uint8)
            lengths = sorted(held["reach"])

            def of(text):
                places = set()
                if text:
                    for n, grams in hashes(text, lengths).items():
                        before, after = held["reach"][n]
                        # As pmod: the hash is a signed number there, and bits a power of two.
                        bit = grams & np.uint64(held["bits"] - 1)
                        may = bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)
                        for i in np.flatnonzero(may & 1).tolist():
                            around = text[max(0, i - before) : i + n + after]
                            places.add((int(grams[i].view("int64")), around))
                return [{"gram": g, "around": t} for g, t in sorted(places)]

            return texts.map(of)

        return found(text)

    def pairs(self, texts: DataFrame, key: str, text: str) -> DataFrame:
        """Distinct (key, word) where the text contains the word."""
        places = texts.select(key, F.explode(self.places(F.col(text))).alias("p")).select(
            key,
            "p.gram",
            "p.around",
            F.pmod(F.xxhash64(key, "p.around"), F.lit(SALTS)).cast("int").alias("salt"),
        )
        salted = self.rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = places.join(salted, ["gram", "salt"]).where(F.contains("around", "word"))
        return met.select(key, "word").distinct()

    def hits(self, texts: DataFrame, text: Column) -> DataFrame:
        """(digest) of the texts that contain a word, staged."""
        digested = texts.select(digest(text).alias("digest"), text.alias("text")).where(
            "text IS NOT NULL"
        )
        return stage(self.pairs(digested, "digest", "text").select("digest").distinct(), "hits")


def digest(text: Column) -> Column:
    """The key of a text among the hits: a hash of its bytes."""
    return F.md5(text.cast("binary"))


def with_hit(df: DataFrame, text: Column, index: GramIndex, name: str = "_hit") -> DataFrame:
    """All rows and columns, with a flag for texts that contain a listed word.

    The table is read twice, for the texts with hits and for its rows; only hashes of
    texts with hits are joined, and the planner, which knows their size, broadcasts few.
    """
    hits = index.hits(df, text).select(F.col("digest").alias("_digest"), F.lit(True).alias(name))
    own = df.withColumn("_own", digest(text))
    joined = own.join(hits, F.col("_own") == F.col("_digest"), "left").drop("_own", "_digest")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(False)))
