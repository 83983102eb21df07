"""Phrase collocations: frequent n-grams by mergeable Misra-Gries summaries, then exact scores.

First pass. Each task cuts texts at punctuation, hashes the n-grams of each language and
sums equal hashes; what it has gathered goes out as one summary for each hash partition.
A partition merges its summaries one after another: counters add up, and beyond the
partition's capacity the next largest count is taken off all. The capacity is ``SHARPNESS``
times the partition's occurrences over the threshold, so less than a ``SHARPNESS``-th of
the threshold is ever taken off in total, and each n-gram that reaches the threshold has a
counter left. Hashes may collide: that adds survivors, and loses none.

Second pass. Texts are read again, and the n-grams whose hash survived are counted by their
words, exactly; those below the threshold go. Up to ``SENT_SURVIVORS`` surviving hashes are
sent to the tasks (8 bytes each, whatever the data); beyond, the tasks send all their
n-grams, and a join by hash keeps the survivors.

A phrase's occurrences hold one of each of its parts, so the parts of a frequent phrase are
frequent, and all that scores need is in the table of frequent n-grams. Scores and the
removal of phrases inside longer ones are joins on it; the best of each language come from
a window that is limited before its rows meet.

A phrase in a third of all texts is one counter in a task, and one row that a task sends.

Defined results: NULL and empty texts have no words; a NULL language is ``und``; repeated
rows count each; without rows or frequent phrases the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gristmill.llm.common import freed
from gristmill.sources.staging import stage

UNKNOWN = "und"
MAX_WORDS = 5
THRESHOLD = 100
BEST = 2000
#: How many times the capacity that the guarantee asks for; more leave fewer false survivors.
SHARPNESS = 4
#: Characters of text per hash partition, some 40 MB of summaries.
PARTITION_CHARS = 1 << 24
#: Surviving hashes sent to the tasks at most.
SENT_SURVIVORS = 4_000_000
#: Bytes of text hashed at a time, and distinct hashes a task gathers before it sends them.
CHUNK_BYTES = 4_000_000
GATHERED = 2_000_000
#: Phrases a task of the second pass gathers before it sends them.
GATHERED_PHRASES = 300_000
#: Counters that wait for a merge besides twice the capacity.
LEAST_MERGED = 200_000
#: Bits of a hash in the first pass.
BITS = 48

# Where pieces end, and what lies between words.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b"\xff"  # no byte of UTF-8
CLEAN = bytes(10 if c in PIECE_ENDS else 32 if c == 9 else c for c in range(256))


class Words:
    """The words of some texts of one language, as numbers, with a break after each piece."""

    def __init__(self, texts: list[bytes]):
        plain = b"\n".join(texts).lower().translate(CLEAN)  # bytes: A-Z only
        found = plain.replace(b"\n", b" " + BREAK + b" ").split()
        self.names = list(set(found))
        index = dict(zip(self.names, range(len(self.names)), strict=True))
        self.ids = np.fromiter(map(index.__getitem__, found), np.int64, len(found))
        self.is_word = self.ids != index.get(BREAK, -1)

    def hashes(self, lang: str) -> np.ndarray:
        """A hash of the word at each position."""
        import xxhash

        seed = xxhash.xxh3_64_intdigest(lang.encode())
        of_name = [xxhash.xxh3_64_intdigest(name, seed) for name in self.names]
        return np.array(of_name, dtype=np.uint64)[self.ids]


def longer(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hashes of n-grams with one word more."""
    mixed = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    return mixed + words


def keys(hashes: np.ndarray) -> np.ndarray:
    """The hash under which an n-gram is counted, of BITS bits."""
    mixed = (hashes ^ (hashes >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))) >> np.uint64(64 - BITS)


def summed(found: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, ascending, with the sum of its counts."""
    key, count = np.concatenate(found), np.concatenate(counts)
    order = np.argsort(key)
    key, count = key[order], count[order]
    if not len(key):
        return key, count
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[first], np.add.reduceat(count, first)


def all_grams(texts: list[bytes], lang: str, max_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of some texts, with their counts."""
    words = Words(texts)
    of_word = words.hashes(lang)
    hashes, whole = of_word, words.is_word
    found = []
    for n in range(1, max_words + 1):
        if n > 1:
            hashes = longer(hashes[:-1], of_word[n - 1 :])
            whole = whole[:-1] & words.is_word[n - 1 :]
        found.append(np.sort(keys(hashes[whole])))
    key = np.sort(np.concatenate(found))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else []
    return key[first], np.diff(np.append(first, len(key))).astype(np.int64)


def exact_grams(
    texts: list[bytes], lang: str, max_words: int, survivors: np.ndarray | None
) -> Iterator[tuple[bytes, int, int, int]]:
    """(phrase, number of words, key, count) of n-grams, and (b"", 0, 0, count of all words).

    With ``survivors`` only n-grams whose key is among them, and whose first words'
    keys are too. Two n-grams are one if their words are.
    """
    words = Words(texts)
    yield b"", 0, 0, int(words.is_word.sum())
    of_word = words.hashes(lang)
    at = np.flatnonzero(words.is_word)
    hashes, codes = of_word[at], words.ids[at]
    for n in range(1, max_words + 1):
        if n > 1:
            more = at + n - 1 < len(words.ids)
            at, hashes, codes = at[more], hashes[more], codes[more]
            more = words.is_word[at + n - 1]
            at, hashes, codes = at[more], hashes[more], codes[more]
            hashes = longer(hashes, of_word[at + n - 1])
            codes = codes * np.int64(len(words.names)) + words.ids[at + n - 1]
        key = keys(hashes)
        if survivors is not None:
            place = np.searchsorted(survivors, key)
            place[place == len(survivors)] = 0
            stays = survivors[place] == key if len(survivors) else np.zeros(len(key), bool)
            at, hashes, codes, key = at[stays], hashes[stays], codes[stays], key[stays]
        _, first, codes, counts = np.unique(
            codes, return_index=True, return_inverse=True, return_counts=True
        )
        for i, k, c in zip(at[first].tolist(), key[first].tolist(), counts.tolist(), strict=True):
            yield b" ".join([words.names[w] for w in words.ids[i : i + n]]), n, k, c


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language together, in lists of bounded size."""
    waiting: dict[str, list[bytes]] = {}
    size: dict[str, int] = {}
    for batch in freed(batches):
        for lang, text in zip(batch.column(0), batch.column(1), strict=True):
            lang, text = lang.as_py(), text.as_py()
            waiting.setdefault(lang, []).append(text)
            size[lang] = size.get(lang, 0) + len(text) + 1
            if size[lang] >= CHUNK_BYTES or sum(size.values()) >= 4 * CHUNK_BYTES:
                lang = max(size, key=size.get)
                size.pop(lang)
                yield lang, waiting.pop(lang)
    yield from waiting.items()


def packed(key: np.ndarray, count: np.ndarray) -> bytes:
    """Ascending keys and counts, small: distances by byte planes, compressed."""
    import zstandard

    steps = np.diff(key, prepend=np.uint64(0))
    planes = [x.astype("<u8").view(np.uint8).reshape(-1, 8).T for x in (steps, count)]
    return zstandard.compress(np.ascontiguousarray(np.stack(planes)).tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(2, 8, -1)
    steps, count = (np.ascontiguousarray(p.T).view("<u8")[:, 0] for p in planes)
    return np.cumsum(steps, dtype=np.uint64), count.astype(np.int64)


def summaries(parts: int, max_words: int):
    """Task of the first pass: rows (part, mass, summary)."""
    limits = np.array([-(-(p << BITS) // parts) for p in range(1, parts)], dtype=np.uint64)

    def sent(found, counts) -> pa.RecordBatch:
        key, count = summed(found, counts)
        cuts = [0, *np.searchsorted(key, limits).tolist(), len(key)]
        full = [p for p in range(parts) if cuts[p] < cuts[p + 1]]
        slices = [slice(cuts[p], cuts[p + 1]) for p in full]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(full, pa.int32()),
                pa.array([int(count[s].sum()) for s in slices], pa.int64()),
                pa.array([packed(key[s], count[s]) for s in slices], pa.binary()),
            ],
            ["part", "mass", "summary"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, counts = [], []
        for lang, texts in chunks(batches):
            key, count = all_grams(texts, lang, max_words)
            found.append(key)
            counts.append(count)
            if sum(map(len, found)) >= GATHERED:
                yield sent(found, counts)
                found, counts = [], []
        if found:
            yield sent(found, counts)

    return work


def merged(parts: Iterable[bytes], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counters left of all summaries, at most ``capacity``, and what was taken off each."""
    found, counts, taken = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0

    def merge() -> None:
        nonlocal found, counts, taken
        key, count = summed(found, counts)
        if len(key) > capacity:
            off = int(np.partition(count, len(count) - capacity - 1)[len(count) - capacity - 1])
            taken += off
            left = count > off
            key, count = key[left], count[left] - off
        found, counts = [key], [count]

    for part in parts:
        key, count = unpacked(part)
        found.append(key)
        counts.append(count)
        if sum(map(len, found)) >= 2 * capacity + LEAST_MERGED:
            merge()
    merge()
    return found[0], counts[0], taken


def survivors(docs: DataFrame, parts: int, threshold: int, max_words: int) -> DataFrame:
    """Keys of all n-grams that may reach the threshold: none that does is missing."""

    def merge(summaries: pa.Table) -> pa.Table:
        mass = sum(summaries.column("mass").to_pylist())
        capacity = SHARPNESS * mass // threshold + 1
        # Iterated as values, so that one summary at a time is a Python object.
        key, count, taken = merged((s.as_py() for s in summaries.column("summary")), capacity)
        return pa.table({"key": key[count + taken >= threshold].astype(np.int64)})

    sent = docs.mapInArrow(summaries(parts, max_words), "part int, mass long, summary binary")
    return sent.groupBy("part").applyInArrow(merge, "key long")


def part_of(key: int, parts: int) -> int:
    return key * parts >> BITS


def count_survivors(parts: int, max_words: int, shared):
    """Task of the second pass: rows (part, phrases, counts) of what it has counted.

    ``phrases`` has a line for each n-gram: language, number of words, words.
    """

    def sent(rows: list[tuple[int, bytes, int]]) -> pa.RecordBatch:
        import zstandard

        rows.sort()
        cuts = [i for i in range(len(rows)) if not i or rows[i][0] != rows[i - 1][0]]
        groups = [rows[a:b] for a, b in zip(cuts, [*cuts[1:], len(rows)], strict=True)]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([g[0][0] for g in groups], pa.int32()),
                pa.array(
                    [zstandard.compress(b"\n".join(r[1] for r in g), 1) for g in groups], pa.binary()
                ),
                pa.array([[r[2] for r in g] for g in groups], pa.list_(pa.int64())),
            ],
            ["part", "phrases", "counts"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[int, bytes], int] = {}
        for lang, texts in chunks(batches):
            name = lang.encode().hex().encode()  # may hold tabs and line feeds itself
            for phrase, size, key, f in exact_grams(texts, lang, max_words, shared.value):
                at = part_of(key, parts), b"%s\t%d\t%s" % (name, size, phrase)
                counts[at] = counts.get(at, 0) + f
            if len(counts) >= GATHERED_PHRASES:
                yield sent([(*at, f) for at, f in counts.items()])
                counts = {}
        if counts:
            yield sent([(*at, f) for at, f in counts.items()])

    return work


def add_counts(given: pa.Table) -> pa.Table:
    """(lang, phrase, size, f) of one part: what all tasks have counted."""
    import zstandard

    total: dict[bytes, int] = {}
    for phrases, counts in zip(given.column("phrases"), given.column("counts"), strict=True):
        lines = zstandard.decompress(phrases.as_py()).split(b"\n")
        for line, f in zip(lines, counts.as_py(), strict=True):
            total[line] = total.get(line, 0) + f
    split = [line.split(b"\t", 2) for line in total]
    return pa.table(
        {
            "lang": pa.array([bytes.fromhex(x[0].decode()).decode() for x in split], pa.string()),
            "phrase": pa.array([x[2] for x in split], pa.binary()),
            "size": pa.array([int(x[1]) for x in split], pa.int32()),
            "f": pa.array(list(total.values()), pa.int64()),
        }
    )


def counted_in_tasks(docs: DataFrame, max_words: int, parts: int, keys: np.ndarray) -> DataFrame:
    """Counts by tasks that know the surviving keys; they meet in the key's hash partition."""
    shared = docs.sparkSession.sparkContext.broadcast(keys)
    work = count_survivors(parts, max_words, shared)
    sent = docs.mapInArrow(work, "part int, phrases binary, counts array<long>")
    return sent.groupBy("part").applyInArrow(
        add_counts, "lang string, phrase binary, size int, f long"
    )


def counted_by_join(docs: DataFrame, max_words: int, kept: DataFrame) -> DataFrame:
    """Counts of all n-grams, joined with the surviving keys, then added up."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in chunks(batches):
            phrase, size, key, f = zip(*exact_grams(texts, lang, max_words, None), strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(f), pa.string()),
                    pa.array(phrase, pa.binary()),
                    pa.array(size, pa.int32()),
                    pa.array(key, pa.int64()),
                    pa.array(f, pa.int64()),
                ],
                ["lang", "phrase", "size", "key", "f"],
            )

    rows = docs.mapInArrow(work, "lang string, phrase binary, size int, key long, f long")
    rows = rows.where("size = 0").unionByName(rows.join(kept, "key", "left_semi"))
    return rows.groupBy("lang", "phrase", "size").agg(F.sum("f").alias("f"))


def counted(docs: DataFrame, max_words: int, parts: int, kept: DataFrame, sent: int) -> DataFrame:
    """(lang, phrase, size, f) of the n-grams with a surviving key; size 0 counts all words."""
    if kept.count() <= sent:
        column = kept.toArrow().column("key").to_numpy().astype(np.uint64)
        rows = counted_in_tasks(docs, max_words, parts, np.sort(column))
    else:
        rows = counted_by_join(docs, max_words, kept)
    return rows.withColumn("phrase", F.col("phrase").cast("string"))


def frequent_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    threshold: int = THRESHOLD,
    max_words: int = MAX_WORDS,
    sent: int = SENT_SURVIVORS,
) -> DataFrame:
    """(lang, phrase, size, f) of all n-grams with ``threshold`` occurrences or more.

    The row of size 0 has the number of all words of a language, however few.
    """
    texts = docs.select(
        F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"),
    )
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + chars // PARTITION_CHARS
    kept = stage(survivors(texts, parts, threshold, max_words), "phrase-keys")
    found = counted(texts, max_words, parts, kept, sent)
    return stage(found.where(f"f >= {threshold} OR size = 0"), "phrases")


def scored(frequent: DataFrame) -> DataFrame:
    """Phrases of two words or more with the parts of their lowest-scoring cut.

    Score: 1000 * a * n / (l * r), rounded down, in decimals of 38 digits.
    """
    parts = frequent.where("size > 0").select("lang", "phrase", "f")
    first = parts.select("lang", F.col("phrase").alias("_first"), F.col("f").alias("l"))
    rest = parts.select("lang", F.col("phrase").alias("_rest"), F.col("f").alias("r"))
    totals = frequent.where("size = 0").select("lang", F.col("f").alias("n"))
    if totals.count() <= 10_000:
        totals = F.broadcast(totals)
    cuts = (
        frequent.where("size > 1")
        .withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
        .withColumn("_first", F.expr("substring_index(phrase, ' ', k)"))
        .withColumn("_rest", F.expr("substring(phrase, length(_first) + 2)"))
        .join(first, ["lang", "_first"])
        .join(rest, ["lang", "_rest"])
        .join(totals, "lang")
    )
    score = F.expr(
        "(1000 * cast(f AS decimal(15,0)) * cast(n AS decimal(18,0)))"
        " div (cast(l AS decimal(18,0)) * cast(r AS decimal(18,0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n"))
    return (
        cuts.groupBy("lang", "phrase", "size", F.col("f").alias("a"))
        .agg(lowest.alias("cut"))
        .select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.n", "cut.score")
    )


def not_inside(phrases: DataFrame, share: int) -> DataFrame:
    """Without phrases inside a longer one that has ``share`` percent of their occurrences.

    A phrase between the two has as many, so one word more on either side is enough.
    """
    longer = phrases.where("size > 2").select(
        "lang",
        F.col("a").alias("_a"),
        F.explode(
            F.array(
                F.expr("substring(phrase, length(substring_index(phrase, ' ', 1)) + 2)"),
                F.expr("substring_index(phrase, ' ', size - 1)"),
            )
        ).alias("phrase"),
    )
    most = longer.groupBy("lang", "phrase").agg(F.max("_a").alias("_a"))
    covered = F.coalesce(100 * F.col("_a") >= share * F.col("a"), F.lit(False))
    return phrases.join(most, ["lang", "phrase"], "left").where(~covered).drop("_a")


def best(phrases: DataFrame, limit: int) -> DataFrame:
    """The first of each language by score, then occurrences, then the phrase itself.

    Rows are limited by language and hash first, so a language's last window gets a
    bounded number.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    shard = F.pmod(F.xxhash64("phrase"), F.lit(32))
    some = Window.partitionBy("lang", "_shard").orderBy(*order)
    every = Window.partitionBy("lang").orderBy(*order)
    return (
        phrases.withColumn("_shard", shard)
        .withColumn("rank", F.row_number().over(some))
        .where(F.col("rank") <= limit)
        .withColumn("rank", F.row_number().over(every))
        .where(F.col("rank") <= limit)
        .withColumn("rank", F.col("rank").cast("long"))
        .drop("_shard")
    )


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    threshold: int = THRESHOLD,
    max_words: int = MAX_WORDS,
    share: int = 100,
    limit: int = BEST,
    sent: int = SENT_SURVIVORS,
) -> DataFrame:
    """The best-scoring frequent phrases of each language, those inside others left out."""
    frequent = frequent_phrases(docs, text, lang, threshold, max_words, sent)
    phrases = scored(frequent)
    return best(not_inside(phrases, share), limit).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
