"""Byte-level BPE encoding and decoding with recursive queries per partition.

The pre-tokens of a batch that this worker has not met yet go to DuckDB as rows
(word, position, token). A recursive query joins neighbouring tokens with the
merge table, contracts the leftmost pair of minimum rank of each word, and ends
when no word has a pair left. Decoding joins ids with the vocabulary and
concatenates the bytes by an ordered aggregation. Rows stay in their partition:
there is no shuffle.

Defined results: NULL text is the empty text and has no tokens; ids outside the
vocabulary raise; repeated rows and NULL keys give one result each.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gristmill.llm.common import freed

#: Words per recursive query, and a bound for the rows that one query may keep.
BLOCK_WORDS = 20_000
BLOCK_ROWS = 800_000
#: Memory of the queries; a block of the sizes above takes a fifth of it.
QUERY_MEMORY = "400MB"
#: The recursion keeps a row per byte and merge, so it is quadratic in the length of
#: a word. Longer pre-tokens (none in prose) are contracted with a heap instead.
LONG_WORD = 512
#: Characters a worker cuts into pre-tokens at a time.
PART_CHARS = 1_000_000
#: Entries and bytes a worker remembers, of words and of runs each, and about what an
#: entry takes besides its key and value.
MEMO_ENTRIES = 500_000
MEMO_BYTES = 120_000_000
ENTRY_BYTES = 200
#: The position takes so many bits of a pair's sort key.
POS_BITS = 20
#: Ids are below this; a pair of them is one number.
ID_SPACE = 1 << 20

#: Letters of the first 256 code points, for which the standard library's expressions,
#: twice as fast, find the same pre-tokens as the pattern; other texts take the pattern.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
ODD = re.compile(f"[^ -~\n{LETTERS}]")

CONTRACT = f"""
WITH RECURSIVE step(it, w, pos, tok, nxt, npos, k) AS (
  SELECT 0, w, pos, tok, nxt, npos, (merged::BIGINT << {POS_BITS}) | pos
  FROM start_rows LEFT JOIN merges ON tok::BIGINT * {ID_SPACE} + nxt = pair
  UNION ALL
  SELECT it, w, pos, tok, nxt, npos,
         CASE WHEN changed THEN (merged::BIGINT << {POS_BITS}) | pos ELSE k END
  FROM (
    SELECT s.it + 1 AS it, s.w, s.pos, s.k,
           CASE WHEN s.pos = h.p THEN h.m ELSE s.tok END AS tok,
           CASE WHEN s.pos = h.p THEN h.gnxt WHEN s.npos = h.p THEN h.m ELSE s.nxt END AS nxt,
           CASE WHEN s.pos = h.p THEN h.gnpos ELSE s.npos END AS npos,
           (s.pos = h.p OR s.npos IS NOT DISTINCT FROM h.p) AS changed
    FROM step s JOIN (
      SELECT best.w, (best.k & {(1 << POS_BITS) - 1})::INT AS p, (best.k >> {POS_BITS})::INT AS m,
             best.gone, g.nxt AS gnxt, g.npos AS gnpos
      FROM (SELECT w, min(k) AS k, arg_min(npos, k) AS gone
            FROM step WHERE k IS NOT NULL GROUP BY w) best
      JOIN step g ON g.w = best.w AND g.pos = best.gone
    ) h ON s.w = h.w
    WHERE s.pos <> h.gone
  ) LEFT JOIN merges ON CASE WHEN changed THEN tok::BIGINT * {ID_SPACE} + nxt END = pair
)
SELECT w, list(tok ORDER BY pos) AS ids
FROM step JOIN (SELECT w, max(it) AS it FROM step GROUP BY w) USING (w, it)
GROUP BY w ORDER BY w
"""

DECODE = """
SELECT w, from_hex(string_agg(hex, '' ORDER BY pos)) AS plain FROM id_rows JOIN vocab ON tok = id
GROUP BY w ORDER BY w
"""


def read_ranks(path: str) -> list[bytes]:
    """Token bytes by rank out of a rank file (base64 token, rank per line)."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    tokens = sorted(ranks, key=ranks.get)
    if [ranks[t] for t in tokens] != list(range(len(tokens))):
        raise ValueError("ranks are not 0..n-1")
    if missing := [i for i in range(256) if bytes([i]) not in ranks]:
        raise ValueError(f"bytes without a token: {missing[:5]}")
    return tokens


def merge_table(tokens: list[bytes]) -> np.ndarray:
    """(left, right, merged) ids of every pair of tokens whose joined bytes are a token."""
    rank = {t: i for i, t in enumerate(tokens)}
    return np.array(
        [
            (rank[t[:i]], rank[t[i:]], m)
            for m, t in enumerate(tokens)
            for i in range(1, len(t))
            if t[:i] in rank and t[i:] in rank
        ],
        dtype=np.int32,
    ).reshape(-1, 3)


def contract_long(word: bytes, tokens: list[bytes], rank: dict[bytes, int]) -> list[int]:
    """The same rule for one long word: a heap of (rank, position) over linked positions."""
    import heapq

    part = [bytes([c]) for c in word]
    after = list(range(1, len(part))) + [-1]
    before = list(range(-1, len(part) - 1))
    heap = []

    def push(i):
        if i >= 0 and after[i] >= 0 and (r := rank.get(part[i] + part[after[i]])) is not None:
            heapq.heappush(heap, (r, i))

    for i in range(len(part)):
        push(i)
    while heap:
        r, i = heapq.heappop(heap)
        if part[i] is None or (j := after[i]) < 0 or part[i] + part[j] != tokens[r]:
            continue
        part[i], part[j] = tokens[r], None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        push(i)
        push(before[i])
    return [rank[p] for p in part if p is not None]


class Memory:
    """What a worker has found, in two generations of bounded size.

    An entry that is used moves to the young one. When that is full it becomes the old
    one, and what only the old one held is forgotten.
    """

    def __init__(self, entries: int):
        self.entries = entries
        self.young: dict = {}
        self.old: dict = {}
        self.size = 0

    def look_up(self, lists: list[list], find) -> dict:
        """Entries of all that is in the lists; ``find`` works out the ones not known."""
        used = set().union(*lists)
        if len(self.young) + len(used) > self.entries // 2 or self.size > MEMO_BYTES // 2:
            self.old, self.young, self.size = self.young, {}, 0
        rest = used - self.young.keys()
        known = rest & self.old.keys()
        more = {x: self.old[x] for x in known} | find(sorted(rest - known))
        self.young |= more
        self.size += sum(map(len, more)) + sum(map(len, more.values())) + ENTRY_BYTES * len(more)
        return self.young


class Coder:
    """DuckDB tables of one vocabulary, and what one worker has met so far."""

    def __init__(self, tokens: list[bytes], merges: np.ndarray, pattern: str, memo: int):
        import duckdb
        import regex

        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.find = regex.compile(pattern).findall
        latin = pattern.replace(r"^\s\p{L}\p{N}", rf"^\s{LETTERS}0-9")
        latin = latin.replace(r"\p{L}", f"[{LETTERS}]").replace(r"\p{N}", "[0-9]")
        self.quick = re.compile(latin).findall if "\\p" not in latin else None
        self.of_byte = np.array([self.rank[bytes([i])] for i in range(256)], dtype=np.int32)
        self.opens = np.array([t[:1] in (b" ", b"\n") for t in tokens])
        self.ids = Memory(memo)
        self.plain = Memory(memo)
        self.db = duckdb.connect(config={"threads": 1, "temp_directory": "", "memory_limit": QUERY_MEMORY})
        pairs = merges[:, 0].astype(np.int64) * ID_SPACE + merges[:, 1]
        self.load("merges", pair=pairs, merged=merges[:, 2])
        self.load("vocab", id=np.arange(len(tokens)), hex=[t.hex() for t in tokens])

    def load(self, name: str, **columns) -> None:
        rows = pa.table(columns)
        self.db.register("given", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def rows(self, name: str, flat: np.ndarray, lengths: np.ndarray, pairs: bool) -> None:
        """Rows (w, pos, tok) of all words; with ``pairs`` also the next token and its place."""
        first = np.repeat(np.cumsum(lengths) - lengths, lengths)
        columns = {
            "w": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths),
            "pos": (np.arange(len(flat)) - first).astype(np.int32),
            "tok": flat,
        }
        if pairs:
            last = np.zeros(len(flat), dtype=bool)
            last[np.cumsum(lengths) - 1] = True
            columns["nxt"] = pa.array(np.append(flat[1:], flat[:1]), mask=last)
            columns["npos"] = pa.array(columns["pos"] + np.int32(1), mask=last)
        self.load(name, **columns)

    def encode_words(self, words: list[str]) -> dict[str, bytes]:
        """Each pre-token with its ids as little-endian 32-bit integers."""
        raw = [w.encode() for w in words]
        found = {}
        block, size = [], 0
        for i in sorted(range(len(raw)), key=lambda i: len(raw[i])):
            if len(raw[i]) > LONG_WORD:
                ids = contract_long(raw[i], self.tokens, self.rank)
                found[words[i]] = np.array(ids, dtype="<i4").tobytes()
                continue
            rows = len(raw[i]) * (len(raw[i]) + 1) // 2
            if block and (len(block) >= BLOCK_WORDS or size + rows > BLOCK_ROWS):
                found |= self.contract(block, words, raw)
                block, size = [], 0
            block.append(i)
            size += rows
        if block:
            found |= self.contract(block, words, raw)
        return found

    def contract(self, block: list[int], words: list[str], raw: list[bytes]) -> dict[str, bytes]:
        lengths = np.array([len(raw[i]) for i in block])
        flat = np.frombuffer(b"".join(raw[i] for i in block), dtype=np.uint8)
        self.rows("start_rows", self.of_byte[flat], lengths, True)
        ids = self.db.sql(CONTRACT).to_arrow_table()["ids"].combine_chunks()
        data = ids.flatten().to_numpy().astype("<i4").tobytes()
        ends = ids.offsets.to_numpy() * 4
        return {
            words[i]: data[a:b] for i, a, b in zip(block, ends[:-1], ends[1:], strict=True)
        }

    def decode_runs(self, runs: list[bytes]) -> dict[bytes, bytes]:
        """Bytes of each run of ids."""
        found = {b"": b""}
        runs = [r for r in runs if r]
        for at in range(0, len(runs), BLOCK_WORDS):
            part = runs[at : at + BLOCK_WORDS]
            flat = np.frombuffer(b"".join(part), dtype="<i4")
            if len(flat) and (flat.min() < 0 or flat.max() >= len(self.tokens)):
                raise ValueError("id outside the vocabulary")
            self.rows("id_rows", flat, np.array([len(r) // 4 for r in part]), False)
            plain = self.db.sql(DECODE).to_arrow_table()["plain"].to_pylist()
            found |= zip(part, plain, strict=True)
        return found

    def words(self, text: str) -> list[str]:
        """Pre-tokens of a text."""
        return self.find(text) if self.quick is None or ODD.search(text) else self.quick(text)

    def encode(self, texts: list[str]) -> list[list[bytes]]:
        """Runs of ids of each text, one for each pre-token."""
        cut = [self.words(t) for t in texts]
        found = self.ids.look_up(cut, self.encode_words)
        return [list(map(found.__getitem__, words)) for words in cut]

    def decode(self, runs: list[list[bytes]]) -> list[bytes]:
        """Bytes of each list of runs."""
        found = self.plain.look_up(runs, self.decode_runs)
        return [b"".join(map(found.__getitem__, parts)) for parts in runs]

    def runs_of(self, ids: np.ndarray) -> list[bytes]:
        """Ids cut before each token that starts with a blank: runs that come again."""
        if not len(ids):
            return []
        if ids.min() < 0 or ids.max() >= len(self.tokens):
            raise ValueError("id outside the vocabulary")
        cuts = np.flatnonzero(self.opens[ids])
        cuts = cuts[cuts > 0] * 4
        data = ids.astype("<i4").tobytes()
        return [data[a:b] for a, b in zip([0, *cuts], [*cuts, len(data)], strict=True)]


def parts(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in order, cut in lists of bounded length; NULL is the empty text."""
    part, size = [], 0
    for text in texts:
        part.append(text.as_py() or "")
        size += len(part[-1])
        if size >= PART_CHARS:
            yield part
            part, size = [], 0
    if part:
        yield part


def id_lists(runs: list[list[bytes]]) -> pa.ListArray:
    """One list of ids for each list of runs."""
    data = [b"".join(r) for r in runs]
    offsets = np.cumsum([0] + [len(d) // 4 for d in data]).astype(np.int32)
    flat = pa.array(np.frombuffer(b"".join(data), dtype="<i4"))
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def _joined(arrays: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(arrays) if arrays else pa.array([], kind)


class Vocabulary:
    """A rank file, read once on the driver and sent to the workers.

    Its size is that of the file, whatever the data; more than 2**20 tokens are refused.
    ``memo`` is the number of pre-tokens a worker remembers: more take memory (some 260
    bytes each, from task to task), fewer take time, and none changes a result.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str, memo: int = MEMO_ENTRIES):
        tokens = read_ranks(path)
        if len(tokens) > ID_SPACE:
            raise ValueError("the vocabulary is over the bound of a broadcast")
        self.shared = spark.sparkContext.broadcast(
            {"tokens": tokens, "merges": merge_table(tokens), "pattern": pattern, "memo": memo}
        )

    def _coder(self):
        shared = self.shared

        def coder() -> Coder:
            # Worker processes keep a broadcast, and with it the coder, from task to task.
            held = shared.value
            if "coder" not in held:
                held["coder"] = Coder(
                    held["tokens"], held["merges"], held["pattern"], held["memo"]
                )
            return held["coder"]

        return coder

    def encode(self, text: Column) -> Column:
        """Ids of a text as array<int>."""
        coder = self._coder()

        @F.arrow_udf("array<int>")
        def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for texts in freed(batches):
                found = [id_lists(coder().encode(part)) for part in parts(texts)]
                yield _joined(found, pa.list_(pa.int32()))

        return ids(text)

    def decode(self, ids: Column) -> Column:
        """Bytes of an array of ids; NULL gives none."""
        coder = self._coder()

        @F.arrow_udf("binary")
        def plain(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for arrays in freed(batches):
                rows = [np.array(a.as_py() or [], dtype=np.int64) for a in arrays]
                runs = [coder().runs_of(a) for a in rows]
                yield pa.array(coder().decode(runs), pa.binary())

        return plain(ids)


#: The column that ``round_trip`` adds.
BPE = "ids array<int>, decoded binary"


def round_trip(
    docs: DataFrame, vocabulary: Vocabulary, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """All rows and columns, with ids and decoded bytes of the text as struct ``bpe``.

    ``keep`` names the columns to go on with, if not all.

    The decoder gets the ids in the runs the encoder made, which spares finding runs
    again. Results leave a task in batches of some ``PART_CHARS`` of text, so that neither
    side of it holds those of a whole batch it was given.
    """
    coder = vocabulary._coder()
    given = docs.drop("bpe") if text != "bpe" else docs
    names = set(given.columns if keep is None else keep) - {"bpe"}
    others = [f for f in given.schema.fields if f.name in names]
    at = given.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            done = 0
            for part in parts(batch.column(at)):
                rows = batch.slice(done, len(part))
                done += len(part)
                runs = coder().encode(part)
                plain = pa.array(coder().decode(runs), pa.binary())
                both = pa.StructArray.from_arrays([id_lists(runs), plain], ["ids", "decoded"])
                kept = {f.name: rows.column(f.name) for f in others}
                yield pa.RecordBatch.from_pydict(kept | {"bpe": both})

    schema = StructType([*others]).add("bpe", StructType.fromDDL(BPE))
    return given.mapInArrow(work, schema)
