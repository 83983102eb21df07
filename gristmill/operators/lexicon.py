"""Word-list operators: load order, reduction, matching.

Entries match as plain substrings of the lower-cased text, without word
boundaries. A list comes as a Python list or as a DataFrame with a ``word``
column. One within a bound travels to the tasks, and texts are searched in their
row. A longer one becomes an index of q-grams that texts are joined with
(``qgrams``), with the same result. Only a Column, and a stream, cannot be joined:
there a longer list is folded over the text in shards of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.text import holds_any, let, strip
from gristmill.operators.qgrams import GramIndex, with_hit
from gristmill.sources.staging import stage

# Entries put before every list.
LITERALS = ("{", "}", "javascript", "lorem ipsum")
# Languages whose lists come first, and files that are no lists.
HEAD_LANGUAGES = ("en", "zh", "de", "ja", "fr", "it", "es", "ar", "th", "ru", "eo")
DOC_FILES = ("README.md", "LICENSE", "USERS.md")

# A list stays a literal chain up to this many entries; beyond, a shard of it
# travels as a broadcast within the next bounds.
CHAIN_ENTRIES = 24
BROADCAST_ENTRIES = 200_000
BROADCAST_CHARS = 8_000_000


def load_lexicon(spark: SparkSession, path: str, name: int = -1) -> DataFrame:
    """Word files, one entry per line, as (lang, line_no, word).

    ``lang`` is the last part of the path, or with ``name=-2`` the folder of the file, and
    so on; of a folder ``column=value``, as a partitioned write leaves them, the value.

    ``line_no`` keeps the order inside a file. Blank lines are left out: as a
    substring they would match every text. A missing path raises.
    """
    raw = spark.read.option("recursiveFileLookup", "true").text(path)
    part = F.element_at(F.split(F.col("_metadata.file_path"), "/"), name)
    return (
        raw.select(
            (part if name == -1 else F.substring_index(part, "=", -1)).alias("lang"),
            F.monotonically_increasing_id().alias("line_no"),
            strip(F.col("value")).alias("word"),
        )
        .where(~F.col("lang").isin(*DOC_FILES))
        .where(F.col("word") != "")
    )


def with_load_order(lexicon: DataFrame, head: Sequence[str] = HEAD_LANGUAGES) -> DataFrame:
    """Add ``lang_rank``: place in ``head``, or one past it for all other lists."""
    place = F.array_position(F.array(*[F.lit(h) for h in head]), F.col("lang"))
    return lexicon.withColumn(
        "lang_rank", F.when(place == 0, len(head) + 1).otherwise(place).cast("int")
    )


def drop_unmatchable(lexicon: DataFrame) -> DataFrame:
    """Leave out entries with capitals: they cannot occur in a lower-cased text."""
    return lexicon.where(F.col("word") == F.lower("word"))


def substring_pairs(
    texts: DataFrame,
    key: str,
    text: str,
    words: DataFrame,
    chunk: int = 4_096,
    step: int = 64,
    salts: int = 16,
) -> DataFrame:
    """Distinct (key, word) where the text contains the word, by equi-join.

    Each text gives its substrings of just the lengths that occur in the list,
    so nothing is compared pairwise and no false candidate leaves the join. The
    word side is distinct, hence a frequent substring meets one row; salts spread
    its occurrences over several tasks. Texts are cut in overlapping chunks, which
    bounds the memory per row, and each chunk gives a substring once.
    """
    listed = words.select("word").where("word <> ''").distinct()
    lengths = listed.agg(F.sort_array(F.collect_set(F.length("word")))).scalar()
    overlap = F.array_max("_lengths") - 1
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(chunk))
    chunks = (
        texts.withColumn("_lengths", lengths)
        .where("_lengths[0] IS NOT NULL")
        .select(
            key,
            "_lengths",
            F.explode(
                F.transform(starts, lambda i: F.substring(F.col(text), i, overlap + chunk))
            ).alias("_chunk"),
        )
    )

    def pieces(c: Column) -> Column:
        """All substrings of a listed length that start in one of ``step`` places."""
        return F.flatten(
            F.transform(
                F.filter("_lengths", lambda n: n <= F.length(c)),
                lambda n: F.transform(
                    F.sequence(F.lit(1), F.least(F.length(c) - n + 1, F.lit(step))),
                    lambda i: F.substring(c, i, n),
                ),
            )
        )

    # Finding the i-th character takes i steps, so substrings come from short parts.
    parts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.length("_chunk"), F.lit(1)), F.lit(step)),
        lambda i: let(F.substring("_chunk", i, overlap + step), pieces),
    )
    unique = F.array_distinct(F.flatten(parts))
    found = chunks.select(
        key,
        F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("_salt"),
        F.explode(unique).alias("word"),
    )
    salted = listed.select("word", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    return found.join(salted, ["word", "_salt"]).select(key, "word").distinct()


def shortest_listed(lexicon: DataFrame) -> DataFrame:
    """For each entry the shortest listed entry inside it, as (word, shortest)."""
    index = GramIndex.of(lexicon)
    inside = index.pairs(index.words.withColumnRenamed("word", "entry"), "entry", "entry")
    return inside.groupBy("entry").agg(
        F.min(F.struct(F.length("word").alias("n"), F.col("word").alias("w"))).alias("m")
    ).select(F.col("entry").alias("word"), F.col("m.w").alias("shortest"))


def minimal_substrings(lexicon: DataFrame) -> DataFrame:
    """The reduced list: texts it matches are exactly those the full list matches."""
    return shortest_listed(lexicon).select(F.col("shortest").alias("word")).distinct()


def with_literals(lexicon: DataFrame, literals: Sequence[str] = LITERALS) -> DataFrame:
    spark = lexicon.sparkSession
    extra = spark.createDataFrame([(w,) for w in literals], "word string")
    return extra.unionByName(lexicon.select("word"))


def bounded_words(
    lexicon: DataFrame,
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> list[str]:
    """The entries of a list that fits the bound; a longer one raises.

    The size is checked before anything but one row of counts reaches the driver.
    ``word_shards`` takes lists of any length.
    """
    words = _entries(lexicon)
    n, chars = _size(words)
    if n > max_entries or chars > max_chars:
        raise ValueError(f"{n} entries of {chars} characters are over the bound; pass the DataFrame")
    return _sorted_words(words)


def _entries(lexicon: DataFrame) -> DataFrame:
    return lexicon.select("word").where("word <> ''").distinct()


def _size(words: DataFrame) -> tuple[int, int]:
    row = words.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("word")), F.lit(0)).alias("chars")
    ).first()
    return row["n"], row["chars"]


def _sorted_words(words: DataFrame) -> list[str]:
    return sorted((r["word"] for r in words.collect()), key=lambda w: (len(w), w))


def word_shards(
    words: Sequence[str] | DataFrame,
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> Iterator[list[str]]:
    """The list in parts that fit the bound, one on the driver at a time; none without entries."""
    if words is None:
        raise TypeError("a word list is needed; pass an empty one for no words")
    if not isinstance(words, DataFrame):
        listed = [w for w in dict.fromkeys(words) if w]
        parts, size = [[]], 0
        for w in listed:
            if parts[-1] and (len(parts[-1]) >= max_entries or size + len(w) > max_chars):
                parts.append([])
                size = 0
            parts[-1].append(w)
            size += len(w)
        yield from (p for p in parts if p)
        return
    listed = _entries(words)
    n, chars = _size(listed)
    if n <= max_entries and chars <= max_chars:
        if n:
            yield _sorted_words(listed)
        return
    # Half the bound on average, so that uneven hashing stays within it; a shard that
    # does not is cut again.
    listed = stage(listed, "lexicon")
    n_shards = max(-(-2 * n // max_entries), -(-2 * chars // max_chars))
    for i in range(n_shards):
        yield from word_shards_of(
            listed.where(F.pmod(F.xxhash64("word"), F.lit(n_shards)) == i), max_entries, max_chars
        )


def settled(
    words: Sequence[str] | DataFrame | GramIndex,
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> Sequence[str] | GramIndex:
    """For repeated use: a list that fits the bound as such, a longer one as an index."""
    if words is None:
        raise TypeError("a word list is needed; pass an empty one for no words")
    if isinstance(words, GramIndex):
        return words
    if isinstance(words, DataFrame):
        n, chars = _size(_entries(words))
        if n <= max_entries and chars <= max_chars:
            return _sorted_words(_entries(words))
        return GramIndex.of(words)
    listed = [w for w in dict.fromkeys(words) if w]
    if len(listed) <= max_entries and sum(map(len, listed)) <= max_chars:
        return listed
    return GramIndex.of(SparkSession.active().createDataFrame([(w,) for w in listed], "word string"))


def word_shards_of(part: DataFrame, max_entries: int, max_chars: int) -> Iterator[list[str]]:
    """Rows of one hash range in lists within the bound, read row by row."""
    shard, size = [], 0
    for row in part.toLocalIterator():
        if shard and (len(shard) >= max_entries or size + len(row["word"]) > max_chars):
            yield sorted(shard, key=lambda w: (len(w), w))
            shard, size = [], 0
        shard.append(row["word"])
        size += len(row["word"])
    if shard:
        yield sorted(shard, key=lambda w: (len(w), w))


def _finder():
    """Builder of an automaton out of a broadcast.

    It is a closure, hence pickled whole: tasks need not import this package. Worker
    processes keep a broadcast from task to task, and with it the automaton.
    """

    def build(held: dict):
        if "automaton" not in held:
            automaton = ahocorasick.Automaton()
            for w in held["words"]:
                automaton.add_word(w, w)
            automaton.make_automaton()
            held["automaton"] = automaton
        return held["automaton"]

    return build


def _broadcast(words: Sequence[str]):
    return SparkSession.active().sparkContext.broadcast({"words": list(words)})


def _automaton_hit(text: Column, words: Sequence[str]) -> Column:
    shared, build = _broadcast(words), _finder()

    @F.pandas_udf("boolean")
    def hit(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = build(shared.value)
        for texts in batches:
            yield texts.map(
                lambda t: t is not None and next(automaton.iter(t), None) is not None
            ).astype(bool)

    return hit(text)


def lexicon_hit(
    text: Column,
    words: Sequence[str] | DataFrame,
    method: str = "auto",
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> Column:
    """True when the (lower-cased) text contains any of the words; NULL text is no hit.

    ``chain`` stays in the JVM and suits a handful of words; ``automaton`` finds all
    words of a shard in one pass over the text. A text that hits one shard is not
    searched for the next. ``None`` for a list raises. Each shard is a node of the plan
    with workers of its own: ``flag_hits`` takes long lists better, by a join.
    """
    if isinstance(words, GramIndex):
        words = words.words
    if method not in ("auto", "chain", "automaton"):
        raise ValueError(f"unknown method {method!r}")
    hit = F.lit(False)
    for i, shard in enumerate(word_shards(words, max_entries, max_chars)):
        if method == "chain" or (method == "auto" and len(shard) <= CHAIN_ENTRIES):
            found = F.coalesce(holds_any(text, shard), F.lit(False))
        else:
            found = _automaton_hit(F.when(~hit, text) if i else text, shard)
        hit = hit | found if i else found
    return hit


def words_found(
    text: Column,
    words: Sequence[str] | DataFrame,
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> Column:
    """Array of the distinct listed words the text contains, sorted within each shard."""

    def in_shard(shard: list[str]) -> Column:
        shared, build = _broadcast(shard), _finder()

        @F.pandas_udf("array<string>")
        def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            automaton = build(shared.value)
            for texts in batches:
                yield texts.map(
                    lambda t: [] if t is None else sorted({w for _, w in automaton.iter(t)})
                )

        return found(text)

    parts = [in_shard(s) for s in word_shards(words, max_entries, max_chars)]
    if not parts:
        return F.array().cast("array<string>")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def lexicon_pairs(
    df: DataFrame,
    key: str,
    text: str,
    lexicon: Sequence[str] | DataFrame | GramIndex,
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """(key, word) for every listed word in every text; a list beyond the bound is joined."""
    listed = settled(lexicon, max_entries, max_chars)
    if isinstance(listed, GramIndex):
        lowered = df.select(key, F.lower(F.col(text)).alias("_lowered"))
        return listed.pairs(lowered, key, "_lowered")
    found = words_found(F.lower(F.col(text)), listed, max_entries, max_chars)
    return df.select(key, F.explode(found).alias("word"))


def flag_hits(
    df: DataFrame,
    text: Column,
    lexicon: Sequence[str] | DataFrame | GramIndex,
    method: str = "auto",
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
    name: str = "_hit",
) -> DataFrame:
    """All rows and columns, with a flag: the (lower-cased) text contains a listed word.

    Within the bound, and in streams, the flag is worked out in the row; else by a join.
    """
    listed = settled(lexicon, max_entries, max_chars)
    if isinstance(listed, GramIndex) and not df.isStreaming:
        return with_hit(df, text, listed, name)
    return df.withColumn(name, lexicon_hit(text, listed, method, max_entries, max_chars))


def drop_hits(
    df: DataFrame,
    text: str,
    lexicon: Sequence[str] | DataFrame | GramIndex,
    max_entries: int = BROADCAST_ENTRIES,
    max_chars: int = BROADCAST_CHARS,
) -> DataFrame:
    """Rows whose text contains no entry of the list."""
    lowered = F.lower(F.col(text))
    flagged = flag_hits(df, lowered, lexicon, "auto", max_entries, max_chars)
    return flagged.where(~F.col("_hit")).drop("_hit")
