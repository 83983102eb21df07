"""Benchmark items in documents, with edits, by pigeonhole pieces.

An item may appear with up to ``RATE`` of its characters edited. It is cut into one
piece more than the edits allowed, so at least one piece survives any such edits
unchanged. One automaton finds all pieces of all items in a single pass over the
whole text. A hit is verified with the bit-parallel edit distance of Myers, first in
growing neighbourhoods: of m pieces with fewer than m edits one half has fewer edits
than pieces again, so some surviving piece passes at every size up to the whole item,
and a chance hit fails at the first, small one. Texts are compared in lower case with runs of blanks as one.

Documents stay where they are: the pass is one column, without a shuffle. The items
travel to the tasks in blocks of ``BLOCK_CHARS`` characters at most, whose size is
counted before anything is collected; a benchmark of several blocks takes as many
passes.

Defined results: NULL and blank texts and items match nothing; a NULL item id stays
NULL; repeated items match each for itself. Items under ``SHORT`` characters must occur
unchanged and between word boundaries. Overlapping occurrences of an item count as one,
the one with the least distance, then the first.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import freed
from gristmill.sources.staging import stage

RATE = 0.1
SHORT = 24
#: Characters of items one automaton may hold.
BLOCK_CHARS = 2_000_000

MATCHES = "array<struct<item_id:string,distance:int,start:int,end:int>>"


def normal(text: str) -> str:
    return " ".join(text.lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length with their offsets."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def paths(n_pieces: int) -> list[list[tuple[int, int]]]:
    """For each piece the growing runs of pieces around it, the whole left out.

    Runs are the nodes of a binary tree over the pieces, smallest first.
    """
    found: list[list[tuple[int, int]]] = [[] for _ in range(n_pieces)]

    def split(a: int, b: int) -> None:
        if b - a < n_pieces and b - a > 1:
            for i in range(a, b):
                found[i].insert(0, (a, b))
        if b - a > 1:
            split(a, (a + b) // 2)
            split((a + b) // 2, b)

    split(0, n_pieces)
    return found


def masks(item: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for i, c in enumerate(item):
        found[c] = found.get(c, 0) | (1 << i)
    return found


def best_end(mask: dict[str, int], n: int, text: str) -> tuple[int, int]:
    """(distance, end) of the best approximate occurrence of a pattern in a text.

    Myers' recurrence: differences of a column of the edit matrix as two bit vectors.
    """
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score = full, 0, n
    best, end = n, 0
    for at, c in enumerate(text, 1):
        eq = mask.get(c, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(xh | plus))
        down = plus & xh
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus, minus = down | (full & ~(xv | up)), up & xv
        if score < best:
            best, end = score, at
    return best, end


class Finder:
    """All items of a block: automaton of their pieces, masks for the verification."""

    def __init__(self, items: list[tuple[str | None, str]], rate: float):
        import ahocorasick

        self.items = [(i, t) for i, t in ((i, normal(t)) for i, t in items) if t]
        self.budget = [int(rate * len(t)) if len(t) >= SHORT else 0 for _, t in self.items]
        self.mask = [masks(t) for _, t in self.items]
        self.back = [masks(t[::-1]) for _, t in self.items]
        self.cuts: list[list[int]] = []
        self.paths = [paths(b + 1) for b in self.budget]
        self.parts: dict[tuple[int, int, int], dict[str, int]] = {}
        self.halves: dict[tuple[int, int], list[str]] = {}
        held: dict[str, list[tuple[int, int]]] = {}
        for n, (_, item) in enumerate(self.items):
            cut = pieces(item, self.budget[n])
            self.cuts.append([offset for offset, _ in cut] + [len(item)])
            for i, (_, piece) in enumerate(cut):
                held.setdefault(piece, []).append((n, i))
        self.automaton = ahocorasick.Automaton()
        for piece, places in held.items():
            self.automaton.add_word(piece, places)
        if held:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) in the normalised text."""
        if not self.items or not text:
            return []
        starts: dict[int, list[int]] = {}
        for end, places in self.automaton.iter(text):
            for n, i in places:
                start = end + 1 - self.cuts[n][i + 1]
                if self.likely(n, i, start, text):
                    starts.setdefault(n, []).append(start)
        found = []
        for n, at in sorted(starts.items()):
            found += self.verified(n, sorted(set(at)), text)
        return found

    def likely(self, n: int, i: int, start: int, text: str) -> bool:
        """Do the runs around a piece fit, with fewer edits than pieces each?"""
        item = self.items[n][1]
        if start >= 0 and text.startswith(item, start):
            return True
        cut = self.cuts[n]
        for a, b in self.paths[n][i]:
            budget, low, high = b - a - 1, cut[a], cut[b]
            region = text[max(0, start + low - budget) : max(0, start + high + budget)]
            if b - a <= 3 and not any(h in region for h in self.halves_around(n, i, a, b)):
                return False
            if (n, a, b) not in self.parts:
                self.parts[n, a, b] = masks(item[low:high])
            if best_end(self.parts[n, a, b], high - low, region)[0] > budget:
                return False
        return True

    def halves_around(self, n: int, i: int, a: int, b: int) -> list[str]:
        """Halves of the other pieces of a run; one at least is unchanged, as edits are fewer."""
        if (n, i) not in self.halves:
            cut, item = self.cuts[n], self.items[n][1]
            found = []
            for j in range(a, b):
                if j != i:
                    middle = (cut[j] + cut[j + 1]) // 2
                    found += [item[cut[j] : middle], item[middle : cut[j + 1]]]
            self.halves[n, i] = found
        return self.halves[n, i]

    def verified(self, n: int, starts: list[int], text: str) -> list[tuple[int | None, int, int, int]]:
        name, item = self.items[n]
        budget, size = self.budget[n], len(item)
        if budget == 0:
            return [
                (name, 0, s, s + size)
                for s in starts
                if size >= SHORT or self.whole_word(text, s, s + size)
            ]
        hits, i = [], 0
        while i < len(starts):
            # Hits of one occurrence imply starts that differ by the edits at most.
            j = i
            while j + 1 < len(starts) and starts[j + 1] - starts[j] <= budget:
                j += 1
            exact = next((s for s in starts[i : j + 1] if s >= 0 and text.startswith(item, s)), None)
            if exact is not None:
                hits.append((0, exact, exact + size))
                i = j + 1
                continue
            low = max(0, starts[i] - budget)
            region = text[low : starts[j] + size + budget]
            distance, end = best_end(self.mask[n], size, region)
            if distance <= budget:
                # The same recurrence backwards from the end finds the start.
                reverse = region[max(0, end - size - budget) : end][::-1]
                _, length = best_end(self.back[n], size, reverse)
                hits.append((distance, low + end - length, low + end))
            i = j + 1
        kept: list[tuple[int, int, int]] = []
        for hit in sorted(hits):
            if all(hit[2] <= k[1] or k[2] <= hit[1] for k in kept):
                kept.append(hit)
        return [(name, d, s, e) for d, s, e in sorted(kept, key=lambda k: k[1])]

    @staticmethod
    def whole_word(text: str, start: int, end: int) -> bool:
        before, after = text[start - 1 : start], text[end : end + 1]
        return not before.isalnum() and not after.isalnum()


def item_blocks(
    items: DataFrame, key: str, text: str, block_chars: int = BLOCK_CHARS
) -> Iterator[list[tuple[str | None, str]]]:
    """Lists of items, each within the bound; sizes are counted before rows are collected."""
    # Staged, so that every block reads the same rows.
    rows = items.where(F.col(text).isNotNull()).select(
        F.col(key).cast("string").alias("k"), F.col(text).alias("t")
    )
    total = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-2 * total // block_chars)) if total > block_chars else 1
    for b in range(n_blocks):
        block = rows.where(F.pmod(F.xxhash64("t", "k"), F.lit(n_blocks)) == b) if n_blocks > 1 else rows
        size = block.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0] if n_blocks > 1 else total
        if size > block_chars:
            # Uneven hashing or one very long item: the block goes on by itself, still bounded
            # by the longest item.
            yield from item_blocks_of(block, block_chars)
        else:
            yield sorted(((r["k"], r["t"]) for r in block.collect()), key=str)


def item_blocks_of(block: DataFrame, block_chars: int) -> Iterator[list[tuple[str | None, str]]]:
    """A block over the bound in smaller lists, read row by row."""
    part, size = [], 0
    for r in block.toLocalIterator():
        if part and size + len(r["t"]) > block_chars:
            yield part
            part, size = [], 0
        part.append((r["k"], r["t"]))
        size += len(r["t"])
    if part:
        yield part


def block_passes(
    text: Column, items: DataFrame, key: str = "item_id", item_text: str = "text",
    rate: float = RATE, block_chars: int = BLOCK_CHARS,
) -> Iterator[tuple[Column, bool]]:
    """For each block of items an array of (item_id, distance, start, end), and whether it is
    the last one.

    Blocks go one after another: the driver holds two at most, and a worker one, if what
    comes of a block is staged before the next one is asked for.
    """
    spark, kind = items.sparkSession, items.schema[key].dataType.simpleString()

    def found(block) -> Column:
        shared = spark.sparkContext.broadcast({"items": block, "rate": rate})
        return _block_matches(text, shared).cast(MATCHES.replace("item_id:string", f"item_id:{kind}"))

    blocks = item_blocks(items, key, item_text, block_chars)
    block = next(blocks)
    while block is not None:
        after = next(blocks, None)
        yield found(block), after is None
        block = after


def _block_matches(text: Column, shared) -> Column:
    @F.arrow_udf(MATCHES)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        # A worker keeps the broadcast, and with it the automaton, from task to task.
        if "finder" not in held:
            held["finder"] = Finder(held["items"], held["rate"])
        kind = pa.list_(
            pa.struct(
                [("item_id", pa.string()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]
            )
        )
        names = ("item_id", "distance", "start", "end")
        for texts in freed(batches):
            rows = [
                [dict(zip(names, m, strict=True)) for m in held["finder"].find(normal(t.as_py() or ""))]
                for t in texts
            ]
            yield pa.array(rows, kind)

    return found(text)


def contaminated(
    docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """(doc_id, item_id, distance, start, end): one row per occurrence.

    Items beyond one block take a pass over the documents for each block.
    """
    rows = None
    for found, last in block_passes(F.col(text), items, **options):
        own = docs.select(F.col(doc_key).alias("doc_id"), F.explode(found).alias("m")).select("doc_id", "m.*")
        if not last:
            own = stage(own, "benchmark-hits")
        rows = own if rows is None else rows.unionByName(own)
    return rows


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without those that hold an item; each further block sees what is left."""
    for found, last in block_passes(F.col(text), items, **options):
        docs = docs.where(F.size(found) == 0)
        if not last:
            docs = stage(docs, "without-items")
    return docs
