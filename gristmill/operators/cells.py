"""Trigrams as compressed arrays, dealt to cells by their middle word.

What a task has read goes to each cell as one array of bytes, sorted and compressed. Known words
are small numbers, others go by their 64-bit hash, once for each array. A cell holds all trigrams
(u, v, w) of its words v, so the counts after (u, v) and v are complete there. A word v with more
trigrams than a cell should hold is dealt to several cells by w; then only the sums over w are not.

Everything here runs in tasks. It is pickled by value, as tasks need not import this package.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Stands before the first word of a text; words are never empty.
START = ""
#: Bytes of text a task deals at once.
CHUNK = 8_000_000
#: The hash of words takes 16 characters.
HASH_KEY = "0123456789abcdef"


def packed(*arrays: np.ndarray) -> bytes:
    """Integers as bytes: those of each place in a row, compressed."""
    codec = pa.Codec("zstd", compression_level=1)
    head, body = [len(arrays)], []
    for array in arrays:
        array = np.ascontiguousarray(array, np.int64)
        top = int(array.view(np.uint64).max()) if len(array) else 0
        width = (top.bit_length() + 7) // 8
        head += [len(array), width]
        for plane in array.view(np.uint8).reshape(-1, 8).T[:width]:
            plane = plane.tobytes()
            short = codec.compress(plane, asbytes=True)
            body.append(short if len(short) < len(plane) else plane)
            head.append(len(body[-1]))
    head = np.array(head, np.int64)
    return b"".join([len(head).to_bytes(4, "little"), head.astype(np.uint32).tobytes(), *body])


def unpacked(data: bytes) -> list[np.ndarray]:
    size = int.from_bytes(data[:4], "little")
    head = iter(np.frombuffer(data, np.uint32, size, 4).tolist())
    at, codec, found = 4 + 4 * size, pa.Codec("zstd"), []
    for _ in range(next(head)):
        n, width = next(head), next(head)
        planes = np.zeros((n, 8), np.uint8)
        for place in range(width):
            length = next(head)
            plane = data[at : at + length]
            at += length
            plane = plane if length == n else codec.decompress(plane, n, asbytes=True)
            planes[:, place] = np.frombuffer(plane, np.uint8)
        found.append(planes.view(np.int64).reshape(-1))
    return found


def starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows begin that differ from the one before."""
    if not len(columns[0]):
        return np.zeros(0, bool)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def order(*columns: np.ndarray) -> np.ndarray:
    """The order of the rows by these columns; their numbers are packed where they fit."""
    bits = [max(int(c.max()).bit_length(), 1) if len(c) else 1 for c in columns]
    if sum(bits) > 63:
        return np.lexsort(columns[::-1])
    key = columns[0].astype(np.int64)
    for c, b in zip(columns[1:], bits[1:], strict=True):
        key = (key << b) | c
    return np.argsort(key)


def find(table: np.ndarray, needles: np.ndarray) -> np.ndarray:
    """Places in a sorted table of different numbers, -1 for none."""
    if not len(table):
        return np.full(len(needles), -1, np.int64)
    at = np.searchsorted(table, needles)
    at[at == len(table)] = 0
    return np.where(table[at] == needles, at, -1)


class Known:
    """The known words by their hash and by their code, and the cells."""

    def __init__(self, shared: dict):
        self.sorted, self.code, self.group = shared["sorted"], shared["code"], shared["group"]
        self.groups, self.size = shared["groups"], len(self.sorted)
        self.cells, self.hot, self.deals = shared["cells"], shared["hot"], shared["deals"]

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        at = find(self.sorted, hashes)
        return np.where(at >= 0, self.code[at] if self.size else -1, -1).astype(np.int64)

    def group_of(self, codes: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Groups of words, where those of unknown ones are given."""
        found = np.zeros(len(codes), np.int64)
        known = codes < self.size
        found[known], found[~known] = self.group[codes[known]], groups[codes[~known] - self.size]
        return found

    def dealt(self, codes: np.ndarray) -> np.ndarray:
        """To how many cells the trigrams of a word go."""
        hot, n = find(self.hot, codes), np.ones(len(codes), np.int64)
        n[hot >= 0] = self.deals[hot[hot >= 0]]
        return n

    def cells_of(self, hot: int) -> list[int]:
        base = int(self.sorted[self.code == self.hot[hot]][0]) % 2**64 % self.cells
        return [(base + i) % self.cells for i in range(int(self.deals[hot]))]


def encoded(size: int, v, u, w, hashes, groups, *more) -> bytes:
    """Rows sorted by (v, u, w) with more columns. Numbers from ``size`` on are places in
    ``hashes`` and ``groups``; those are renumbered, in the same order, for these rows."""
    used = np.zeros(len(hashes), bool)
    rare = [np.flatnonzero(c >= size) for c in (v, u, w)]
    for c, r in zip((v, u, w), rare, strict=True):
        used[c[r] - size] = True
    used = np.flatnonzero(used)
    if len(used):
        to = np.zeros(len(hashes), np.int64)
        to[used] = size + np.arange(len(used))
        v, u, w = v.copy(), u.copy(), w.copy()
        for c, r in zip((v, u, w), rare, strict=True):
            c[r] = to[c[r] - size]
    new_v, new_u = starts(v), starts(v, u)
    steps = [np.diff(c, prepend=0) for c in (v, u, w)]
    steps[1] = np.where(new_v, u, steps[1])
    steps[2] = np.where(new_u, w, steps[2])
    return packed(*steps, hashes[used], groups[used], *more)


def _summed(steps: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Running sums that begin anew at each start."""
    total = np.cumsum(steps)
    first = np.flatnonzero(new)
    return total - np.repeat(total[first] - steps[first], np.diff(first, append=len(steps)))


def decoded(data: bytes) -> list[np.ndarray]:
    """(v, u, w, hashes, groups, more...) of ``encoded``."""
    v, u, w, hashes, groups, *more = unpacked(data)
    new = v > 0
    new[:1] = True
    new_u = new | (u > 0)
    return [np.cumsum(v), _summed(u, new), _summed(w, new_u), hashes, groups, *more]


def merged(blobs: list[bytes], size: int) -> list[np.ndarray]:
    """Encoded rows of several arrays as one: equal ones once, their other columns summed.
    Hashes are sorted."""
    parts = [decoded(b) for b in blobs]
    hashes, at = np.unique(np.concatenate([p[3] for p in parts]), return_index=True)
    groups = np.concatenate([p[4] for p in parts])[at]
    columns = []
    for i in range(3):
        column = []
        for p in parts:
            c, rare = p[i], np.flatnonzero(p[i] >= size)
            c[rare] = size + np.searchsorted(hashes, p[3])[c[rare] - size]
            column.append(c)
        columns.append(np.concatenate(column))
    more = [np.concatenate(c) for c in zip(*(p[5:] for p in parts), strict=True)]
    del parts
    by = order(*columns)
    columns = [c[by] for c in columns]
    first = np.flatnonzero(starts(*columns))
    more = [np.add.reduceat(c[by], first) if len(first) else c for c in more]
    return [*(c[first] for c in columns), hashes, groups, *more]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of keys below ``most``, and the different keys."""
    if most > 8 * len(keys) + 1000:
        found = pa.array(keys).dictionary_encode()
        return found.indices.to_numpy().astype(np.int64), found.dictionary.to_numpy()
    used = np.zeros(most, bool)
    used[keys] = True
    return (np.cumsum(used) - 1)[keys], np.flatnonzero(used)


class Chunk:
    """Words of texts by numbers. ``hash`` and ``group`` are those of the numbers, ``w`` the words
    one after another, ``v`` and ``u`` the words before, ``sizes`` the number in each text."""

    def __init__(self, groups: np.ndarray, texts: list[pa.Array]):
        n = len(groups)
        if len(texts) == 1:
            lists = pc.utf8_split_whitespace(texts[0])
            words = lists.flatten()
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        else:
            words, sizes = pa.concat_arrays(texts), np.ones(3 * n, np.int64)
        if pa.types.is_dictionary(words.type) or not len(words):
            words = words.cast(pa.string())
        words = words.dictionary_encode()
        names = words.dictionary.to_numpy(zero_copy_only=False)
        at = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        different, group = np.unique(groups, return_inverse=True)
        row = np.repeat(np.arange(len(sizes)), sizes)
        if len(texts) == 1:
            # What stands at the ends of a text is split off as an empty word.
            empty = names == ""
            if empty.any():
                full = ~empty[at]
                row, at = row[full], at[full]
                sizes = np.bincount(row, minlength=n)
        # Words of several groups are numbered by both.
        m = len(names)
        of = np.repeat(group, sizes) if len(texts) == 1 else np.tile(group, 3)
        at, by = numbered(of * m + at, len(different) * m)
        hashes = pd.util.hash_array(names.astype(object), hash_key=HASH_KEY, categorize=False)
        begin = pd.util.hash_array(np.array([START], object), hash_key=HASH_KEY, categorize=False)
        hashes = np.concatenate([hashes[by % m] if m else hashes, np.repeat(begin, len(different))])
        place = np.concatenate([by // m if m else by, np.arange(len(different))])
        self.group = different[place]
        self.hash = mixed(hashes + mixed(self.group.view(np.uint64))).view(np.int64)
        if len(texts) == 1:
            # Each group's start comes after its words.
            first = np.flatnonzero(starts(row))
            before = len(by) + group[row[first]]
            self.w, self.v, self.u = at, np.roll(at, 1), None
            self.v[first] = before
            self.u = np.roll(self.v, 1)
            self.u[first] = before
        else:
            self.u, self.v, self.w = at.reshape(3, n)
            sizes = np.ones(n, np.int64)
        self.sizes = sizes
        self.begins = np.bincount(len(by) + group[sizes > 0], minlength=len(self.hash))

    def dealt(self, known: Known, count: bool) -> Iterator[tuple[int, bytes]]:
        """(cell, rows): trigrams with their counts, or each with the place of its text."""
        if not len(self.w):
            return
        codes = known.codes(self.hash)
        rare = np.flatnonzero(codes < 0)
        codes[rare] = known.size + np.arange(len(rare))
        hashes, groups = self.hash[rare], np.searchsorted(known.groups, self.group[rare])
        # Words are numbered anew, densely and in the order of their codes.
        by = np.argsort(codes)
        codes, by_hash, rank = codes[by], self.hash[by].view(np.uint64), np.empty(len(by), np.int64)
        rank[by] = np.arange(len(by))
        # A word takes a place for each cell it goes to; places are in the order of the cells.
        n = known.dealt(codes)
        last = np.cumsum(n)
        word = np.repeat(np.arange(len(n)), n)
        other = np.arange(len(word)) - (last - n)[word]
        cell = (by_hash[word] % np.uint64(known.cells)).astype(np.int64) + other
        cell %= known.cells
        places = np.lexsort((word, cell))
        word, cell, to = word[places], cell[places], np.empty(len(places), np.int64)
        to[places] = np.arange(len(places))
        first, v, w = (last - n)[rank], self.v, rank[self.w]
        place = first[v]
        hot = np.flatnonzero((n > 1)[rank][v])
        place[hot] += ((by_hash[w[hot]] >> np.uint64(20)) % n[rank[v[hot]]].astype(np.uint64)).astype(np.int64)
        place, u = to[place], rank[self.u]
        if count:
            place, u, w, more = _counted(place, u, w)
        else:
            by = order(place, u, w)
            place, u, w = place[by], u[by], w[by]
            more = np.repeat(np.arange(len(self.sizes)), self.sizes)[by]
        v, u, w, at = codes[word[place]], codes[u], codes[w], cell[place]
        first = np.flatnonzero(starts(at))
        for a, b in zip(first, np.append(first[1:], len(at)), strict=True):
            yield int(at[a]), encoded(known.size, v[a:b], u[a:b], w[a:b], hashes, groups, more[a:b])


def _counted(*columns: np.ndarray) -> list[np.ndarray]:
    """Different rows in order, and the number of each."""
    bits = [max(int(c.max()).bit_length(), 1) if len(c) else 1 for c in columns]
    if sum(bits) > 63:
        by = order(*columns)
        columns = [c[by] for c in columns]
        first = np.flatnonzero(starts(*columns))
        return [*(c[first] for c in columns), np.diff(first, append=len(by))]
    key = columns[0]
    for c, b in zip(columns[1:], bits[1:], strict=True):
        key = (key << b) | c
    key = np.sort(key)
    first = np.flatnonzero(starts(key))
    n, key, found = np.diff(first, append=len(key)), key[first], []
    for b in bits[:0:-1]:
        found.append(key & ((1 << b) - 1))
        key = key >> b
    return [key, *found[::-1], n]


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
    """Columns of rows with texts of some size in all; the first is the group, the second a text."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) + size
        cuts = [*np.flatnonzero(starts(sizes // CHUNK))[1:].tolist(), batch.num_rows]
        # What was held, with the rows up to the first cut; then the rows between cuts.
        if sizes[0] >= CHUNK and held:
            yield _joined(held)
            held = []
        at = 0
        for cut in cuts:
            held.append(batch.slice(at, cut - at))
            if cut < batch.num_rows:
                yield _joined(held)
                held = []
            at = cut
        size = int(sizes[-1] % CHUNK)
    if held:
        yield _joined(held)


def _joined(batches: list[pa.RecordBatch]) -> list[pa.Array]:
    return [pa.concat_arrays([b.column(i) for b in batches]) for i in range(batches[0].num_columns)]


def batch_of(kind: str, *columns) -> pa.RecordBatch:
    """Columns as the batch of a schema, one of those below."""
    schema = SCHEMAS[kind]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_int, _long, _bytes = pa.int32(), pa.int64(), pa.binary()
SCHEMAS = {
    "part": pa.schema([("part", _int), ("blob", _bytes)]),
    "counts": pa.schema([("g", _long), ("h", _long), ("n", _long)]),
    "cell": pa.schema(
        [("cell", _int), ("model", _bytes), ("contexts", pa.list_(_bytes)), ("words", pa.list_(_bytes)), ("sums", _bytes)]
    ),
    "words": pa.schema([("code", _int), ("w", _long), ("g", _int), ("c", _long), ("part", _int), ("blob", _bytes)]),
    "dealt": pa.schema([("cell", _int), ("kind", _int), ("chunk", _long), ("blob", _bytes)]),
    "scored": pa.schema(
        [("chunk", _long), ("keys", _bytes), ("sums", _bytes), ("w", _long), ("text", _int)]
        + [(c, pa.float64()) for c in "abd"]
    ),
}


def by_key(total: Callable, shared=None) -> Callable:
    """Hands ``total`` a value of the first column and its blobs, and the known words where they
    are given; the rows are sorted."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, known = None, [], () if shared is None else (Known(shared.value),)
        for batch in batches:
            for k, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if k != key and held:
                    yield from total(key, held, *known)
                    held = []
                key = k
                held.append(blob.as_py())
        if held:
            yield from total(key, held, *known)

    return work


def count_words(parts: int) -> Callable:
    """(group, text) -> (part, words with their counts); what starts a text counts as a word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, text in chunks(batches):
            chunk = Chunk(groups.to_numpy(), [text])
            n = np.bincount(chunk.w, minlength=len(chunk.hash)) + chunk.begins
            part = (chunk.hash.view(np.uint64) % np.uint64(parts)).astype(np.int64)
            rows = np.flatnonzero(n)
            rows = rows[np.argsort(chunk.hash[rows])]
            rows = rows[np.argsort(part[rows].astype(np.int16), kind="stable")]
            first = np.flatnonzero(starts(part[rows]))
            for p in np.split(rows, first[1:]) if len(rows) else []:
                # Of hashes in order the steps are shorter; running sums wrap around as they do.
                steps = np.diff(chunk.hash[p], prepend=0)
                blob = packed(steps, *np.unique(chunk.group[p], return_inverse=True), n[p])
                yield batch_of("part", [int(part[p[0]])], [blob])

    return work


def sum_words() -> Callable:
    """(part, words) -> (g, h, n) of each word."""

    def total(_, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = [unpacked(b) for b in blobs]
        hashes = np.concatenate([np.cumsum(f[0]) for f in found])
        groups = np.concatenate([f[1][f[2]] for f in found])
        different, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        n = np.bincount(at, np.concatenate([f[3] for f in found]), len(different)).astype(np.int64)
        yield batch_of("counts", groups[first], different, n)

    return by_key(total)


def deal_counts(shared) -> Callable:
    """(group, text) -> (part, trigrams with their counts), the part being a cell."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        for groups, text in chunks(batches):
            for cell, rows in Chunk(groups.to_numpy(), [text]).dealt(known, count=True):
                yield batch_of("part", [cell], [rows])

    return work


def _part(size: int, codes: np.ndarray, hashes: np.ndarray, parts: int) -> np.ndarray:
    """The part of each word."""
    part, rare = codes % parts, np.flatnonzero(codes >= size)
    part[rare] = (hashes[codes[rare] - size].view(np.uint64) % np.uint64(parts)).astype(np.int64)
    return part


def fit_cells(shared, parts: int) -> Callable:
    """(cell, trigrams) -> a cell: all its trigrams, and what other tasks add up."""

    def total(cell: int, blobs: list[bytes], known: Known) -> Iterator[pa.RecordBatch]:
        v, u, w, hashes, groups, c = merged(blobs, known.size)
        model = encoded(known.size, v, u, w, hashes, groups, c)
        bv, bw, c2 = _counted(v, w)
        first = np.flatnonzero(starts(v))
        hot = np.flatnonzero(find(known.hot, v[first]) >= 0)
        total2, types2 = np.diff(first, append=len(v)), np.diff(np.flatnonzero(starts(bv)), append=len(bv))
        # Counts of counts by group.
        sums = []
        for of, counts in ((v, c), (bv, c2)):
            group = known.group_of(of, groups)
            sums += [np.bincount(group[counts == n], minlength=len(known.groups)) for n in (1, 2)]
        sums = packed(*sums, v[first][hot], total2[hot], types2[hot])
        # Contexts of words in several cells.
        first = np.flatnonzero(starts(v, u))
        cv, cu = v[first], u[first]
        contexts, total3, types3 = [], np.add.reduceat(c, first), np.diff(first, append=len(v))
        rows = np.flatnonzero(find(known.hot, cv) >= 0)
        if len(rows):
            part = _part(known.size, cu[rows], hashes, parts)
            for p in range(parts):
                r = rows[part == p]
                contexts.append(encoded(known.size, cv[r], cu[r], np.zeros(len(r), np.int64), hashes, groups, total3[r], types3[r]))
        # In how many contexts of one word a word is.
        codes, n = _counted(bw)
        part = _part(known.size, codes, hashes, parts)
        by = np.argsort(part, kind="stable")
        words = []
        for rows in np.split(by, np.searchsorted(part[by], np.arange(1, parts))):
            c, m = codes[rows], n[rows]
            some, other = c < known.size, c[c >= known.size] - known.size
            steps = np.diff(c[some], prepend=0), np.diff(hashes[other], prepend=0)
            words.append(packed(np.array([cell]), steps[0], m[some], steps[1], groups[other], m[~some]))
        yield batch_of("cell", [cell], [model], [contexts], [words], [sums])

    return by_key(total, shared)


def sum_types(shared) -> Callable:
    """(part, counts of words) -> the words (code, w, g, c), and (part, blob) for each cell: the
    sums of its words that are not known."""

    def total(_, blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        found = [unpacked(b) for b in blobs]
        codes, at = np.unique(np.concatenate([np.cumsum(f[1]) for f in found]), return_inverse=True)
        n = np.bincount(at, np.concatenate([f[2] for f in found]), len(codes)).astype(np.int64)
        none = [None] * len(codes)
        yield batch_of("words", codes, np.zeros(len(codes), np.int64), shared.value["group"][codes], n, none, none)
        rare = [np.cumsum(f[3]) for f in found]
        hashes, first, at = np.unique(np.concatenate(rare), return_index=True, return_inverse=True)
        if not len(hashes):
            return
        n = np.bincount(at, np.concatenate([f[5] for f in found]), len(hashes)).astype(np.int64)
        none = [None] * len(hashes)
        yield batch_of("words", np.full(len(hashes), -1), hashes, np.concatenate([f[4] for f in found])[first], n, none, none)
        for f, own, of in zip(found, rare, np.split(n[at], np.cumsum([len(r) for r in rare])[:-1]), strict=True):
            if len(own):
                yield batch_of("words", [None], [None], [None], [None], [int(f[0][0])], [packed(f[3], of)])

    return by_key(total)


def merge_contexts(shared) -> Callable:
    """(part, contexts) -> the sums of their words' cells, for each of these cells."""

    def total(_, blobs: list[bytes], known: Known) -> Iterator[pa.RecordBatch]:
        v, u, w, hashes, groups, *more = merged(blobs, known.size)
        hot = find(known.hot, v)
        by_cell = defaultdict(list)
        for h in np.unique(hot):
            for cell in known.cells_of(h):
                by_cell[cell].append(h)
        for cell, some in by_cell.items():
            r = np.flatnonzero(np.isin(hot, some))
            yield batch_of("part", [cell], [encoded(known.size, v[r], u[r], w[r], hashes, groups, *(c[r] for c in more))])

    return by_key(total, shared)


def deal_texts(shared, trigrams: bool) -> Callable:
    """(group, text, key), or (group, u, v, w, key), -> rows for the cells, with the places of
    their texts in a chunk, and the keys and sizes of these texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(shared.value)
        task = TaskContext.get().partitionId()

        for number, (groups, *texts, key) in enumerate(chunks(batches)):
            groups, texts = groups.to_numpy(), texts if trigrams else texts[:1]
            some = np.flatnonzero(find(known.groups, groups) >= 0)
            if not len(some):
                continue
            groups, some = groups[some], pa.array(some)
            found = Chunk(groups, [x.take(some) for x in texts])
            full = np.flatnonzero(found.sizes)
            if not len(full):
                continue
            chunk = task << 32 | number
            keys = pa.RecordBatch.from_arrays([key.take(some).take(pa.array(full)), pa.array(found.sizes[full])], ["key", "n"])
            found.sizes = found.sizes[full]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, keys.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(keys)
            yield batch_of("dealt", [chunk % known.cells], [KEYS], [chunk], [sink.getvalue().to_pybytes()])
            for cell, rows in found.dealt(known, count=False):
                yield batch_of("dealt", [cell], [TEXTS], [chunk], [rows])

    return work


#: Kinds of rows in a cell, in the order they are read.
MODEL, CONTEXTS, COUNTS, KEYS, TEXTS = range(5)


def _at(at: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    """The counts at these places, 0 at -1."""
    return [np.where(at >= 0, c[at] if len(c) else 0, 0) for c in counts]


def _seen(table: np.ndarray, keys: np.ndarray, *counts: np.ndarray) -> list[np.ndarray]:
    return _at(find(table, keys), *counts)


class Cell:
    """The counts of a cell, to look trigrams up."""

    def __init__(self, known: Known, fit: dict, model: bytes | None, contexts: list[bytes], counts: list[bytes]):
        self.known, self.fit = known, fit
        none = np.zeros(0, np.int64)
        v, u, w, self.hashes, _, self.c3 = decoded(model) if model else [none] * 6
        new = starts(v, u)
        first = np.flatnonzero(new)
        self.uv = (v << 32 | u)[first]
        # The pair (v, u) of each trigram.
        self.context = np.cumsum(new) - 1
        self.total3 = np.add.reduceat(self.c3, first) if len(first) else none
        self.types3 = np.diff(first, append=len(v)) if len(first) else none
        by = order(v, w)
        new = starts(v[by], w[by])
        self.vw, self.c2 = (v << 32 | w)[by][new], np.diff(np.flatnonzero(new), append=len(v))
        # The pair (v, w) of each trigram.
        self.pair = np.empty(len(v), np.int64)
        self.pair[by] = np.cumsum(new) - 1
        first = np.flatnonzero(starts(v))
        self.v, self.total2 = v[first], np.diff(first, append=len(v))
        bits = (known.size + len(self.hashes)).bit_length()
        # Trigrams are one number where it fits, else one with that of the pair.
        self.bits = bits if len(first).bit_length() + 2 * bits <= 63 else None
        if self.bits is None:
            self.uvw = self.context << 32 | w
        else:
            self.uvw = ((np.cumsum(starts(v)) - 1) << bits | u) << bits | w
        self.types2 = np.diff(np.flatnonzero(starts(self.vw >> 32)), append=len(self.vw))
        found = [unpacked(c) for c in counts]
        self.others, self.c1 = none, none
        if found:
            self.others, c1 = np.concatenate([np.cumsum(f[0]) for f in found]), np.concatenate([f[1] for f in found])
            by = np.argsort(self.others)
            self.others, self.c1 = self.others[by], c1[by]
        self.hot_uv = None
        if contexts:
            v, u, _, self.hot_hashes, _, self.hot_total, self.hot_types = merged(contexts, known.size)
            self.hot_uv = v << 32 | u

    def numbers(self, hashes: np.ndarray, table: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
        """Codes of other rows by those of a sorted table of unknown words; -1 for none."""
        size, at, found = self.known.size, find(table, hashes), []
        at[at >= 0] += size
        for codes in columns:
            rare = np.flatnonzero(codes >= size)
            codes = codes.copy()
            codes[rare] = at[codes[rare] - size]
            found.append(codes)
        return found

    def look(self, data: bytes):
        """(text, a, b, d, counted, w): the probability is a where that is counted, else it is
        a + b * max(c - d, 0), where c counts the different words before the hash w."""
        known, fit = self.known, self.fit
        v, u, w, hashes, groups, text = decoded(data)
        group = known.group_of(v, groups)
        mv, mu, mw = self.numbers(hashes, self.hashes, v, u, w)
        first = np.flatnonzero(starts(v))
        times = np.diff(first, append=len(v))
        at, hot = (np.repeat(x, times) for x in (find(self.v, mv[first]), find(known.hot, v[first])))
        total2, types2 = _at(at, self.total2, self.types2)
        uv = np.where((mv >= 0) & (mu >= 0), mv << 32 | mu, -1)
        if self.bits is None:
            context = find(self.uv, uv)
            at = find(self.uvw, np.where((context >= 0) & (mw >= 0), context << 32 | mw, -1))
        else:
            key = (at << self.bits | mu) << self.bits | mw
            at = find(self.uvw, np.where((at >= 0) & (uv >= 0) & (mw >= 0), key, -1))
            (context,) = _at(at, self.context)
            rest = np.flatnonzero(at < 0)
            context[rest] = find(self.uv, uv[rest])
        total3, types3 = _at(context, self.total3, self.types3)
        c3, pair = _at(at, self.c3, self.pair)
        # A trigram that was seen has its pair; of others it is looked up.
        rest = np.flatnonzero(at < 0)
        pair[rest] = find(self.vw, np.where((mv[rest] >= 0) & (mw[rest] >= 0), mv[rest] << 32 | mw[rest], -1))
        (c2,) = _at(pair, self.c2)
        rows = np.flatnonzero(hot >= 0)
        if len(rows):
            total2[rows], types2[rows] = fit["hot_total"][hot[rows]], fit["hot_types"][hot[rows]]
            total3[rows] = types3[rows] = 0
            if self.hot_uv is not None:
                (hu,) = self.numbers(hashes, self.hot_hashes, u[rows])
                total3[rows], types3[rows] = _seen(
                    self.hot_uv, np.where(hu >= 0, v[rows] << 32 | hu, -1), self.hot_total, self.hot_types
                )
        d1, d2, d3, total1, types1 = (fit[x][group] for x in ("d1", "d2", "d3", "total1", "types1"))
        # Of each order the share of the count, and that of the lower order.
        a, b = np.zeros(len(v)), np.ones(len(v))
        for c, d, total, types in ((c3, d3, total3, types3), (c2, d2, total2, types2)):
            kept, some = np.maximum(c - d, 0.0), total > 0
            # A context that was never seen leaves all to the lower order.
            a = np.where(some, a + b * kept / np.maximum(total, 1), a)
            b = np.where(some, b * (d * types) / np.maximum(total, 1), b)
        a, b = a + b * (d1 * types1 / (types1 + 1)) / total1, b / total1
        counted = w < known.size
        # The last count, of a word that is not known, is 0.
        c1 = fit["c1"][np.minimum(w, known.size)].astype(np.int64)
        other = np.flatnonzero(~counted)
        at = find(self.others, hashes)[w[other] - known.size]
        (c1[other],) = _at(at, self.c1)
        counted[other] = (at >= 0) | fit["complete"]
        a = np.where(counted, a + b * np.maximum(c1 - d1, 0.0), a)
        w_hash = np.zeros(len(w), np.int64)
        w_hash[~counted] = hashes[w[~counted] - known.size]
        return text, a, b, d1, counted, w_hash


def score_cells(shared, fitted) -> Callable:
    """(cell, kind, chunk, blob), sorted by cell and kind, -> the sums of logarithms of the texts
    of each chunk. A trigram comes by itself if neither the cell nor all know its last word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, at, cell = Known(shared.value), None, None
        for batch in batches:
            for c, kind, chunk, blob in zip(*(x.to_pylist() for x in batch.columns[:3]), batch.column(3), strict=True):
                if c != at:
                    at, cell, model, contexts, counts = c, None, None, [], []
                blob = blob.as_py()
                if kind == MODEL:
                    model = blob
                elif kind == CONTEXTS:
                    contexts.append(blob)
                elif kind == COUNTS:
                    counts.append(blob)
                elif kind == KEYS:
                    yield batch_of("scored", [chunk], [blob], *([None] for _ in range(6)))
                else:
                    cell = cell or Cell(known, fitted.value, model, contexts, counts)
                    text, a, b, d, counted, w = cell.look(blob)
                    texts, to = np.unique(text[counted], return_inverse=True)
                    logs, some = _logs(a[counted])
                    sums, n = np.bincount(to, logs, len(texts)), np.bincount(to, ~some, len(texts))
                    data = packed(np.diff(texts, prepend=0), sums.view(np.int64), n.astype(np.int64))
                    yield batch_of("scored", [chunk], [None], [data], *([None] for _ in range(5)))
                    rest = np.flatnonzero(~counted)
                    if len(rest):
                        n = len(rest)
                        yield batch_of("scored", np.full(n, chunk), [None] * n, [None] * n, w[rest], text[rest], a[rest], b[rest], d[rest])

    return work


def _logs(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logarithms, and which there are; a zero, as of discounts that are zero, has none."""
    some = p > 0
    return np.log(p, out=np.zeros(len(p)), where=some), some


def sum_texts() -> Callable:
    """(chunk, keys, sums, text, p), sorted by chunk, -> (key, sum, n) of each text."""

    def total(keys: bytes, sums: list) -> pa.RecordBatch:
        table = pa.ipc.open_stream(keys).read_all().combine_chunks()
        key, n = (table.column(i).combine_chunks() for i in range(2))
        s, n = np.zeros(len(key)), n.to_numpy(zero_copy_only=False).copy()
        for texts, logs, none in sums:
            s += np.bincount(texts, logs, len(s))
            n -= np.bincount(texts, none, len(s)).astype(np.int64)
        return pa.RecordBatch.from_arrays([key, pa.array(s), pa.array(n)], ["key", "s", "n"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, keys, sums = None, None, []
        for batch in batches:
            chunks, texts, p = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3, 4))
            first = np.flatnonzero(starts(chunks))
            for a, b in zip(first, np.append(first[1:], len(chunks)), strict=True):
                if chunks[a] != at:
                    if at is not None:
                        yield total(keys, sums)
                    at, keys, sums = chunks[a], None, []
                for i in range(a, b):
                    if batch.column(1)[i].is_valid:
                        keys = batch.column(1)[i].as_py()
                    elif batch.column(2)[i].is_valid:
                        steps, logs, none = unpacked(batch.column(2)[i].as_py())
                        sums.append((np.cumsum(steps), logs.view(np.float64), none))
                rows = a + np.flatnonzero(~np.isnan(p[a:b]))
                if len(rows):
                    logs, some = _logs(p[rows])
                    sums.append((texts[rows].astype(np.int64), logs, ~some))
        if at is not None:
            yield total(keys, sums)

    return work
