"""Near-duplicate documents by a chosen-path set similarity join.

Each text is a set of hashed word shingles. Texts with equal sets form a class, and
one row per class goes on. A class has ``TOKENS`` minwise tokens. Every tree starts
with all classes in its root; a node picks a few token positions by a hash of its
own, and a class moves to one child for each picked position, named by the value it
has there, so classes of similarity 0.8 or more meet in one child on average in
every level, and different texts part. Nodes of up to ``SMALL_NODE`` classes are
compared exhaustively: by their minwise tokens first, which tells classes that have
no partner at all, then on full sets. Larger nodes branch again. Those still large
at the last level are cut into blocks, and all pairs of blocks are compared, so no
candidate is given up. Full sets are compared in groups of bounded size: one of too
many shingles is cut likewise. Links of a node leave it as a spanning forest, never as
all pairs. ``TREES`` independent trees are searched.

Recall: a root picks 1.5 tokens on average and never none, and roots share no position.
The ten roots branch at 15 different positions, so a pair of similarity 0.8 meets in no
child of any with probability 0.2 to the 15th, one in 30 billion; each level more that a
large node branches costs some of that (0.72 per tree after three levels, one in some
340,000 for all), and groups that large have many paths.

Components come from alternating star contractions over tables in the shared folder;
nothing is collected to the driver but counts.

Defined results: a text without words, or NULL, has an empty set and links with
nothing; with fewer words than a shingle the whole sequence is one. Rows with a NULL
key are not linked: they get no component and stay. Rows that share a key are
documents of their own with the same name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import freed
from gristmill.sources.staging import stage

WORDS = 5
PERCENT = 80
TREES = 10
TOKENS = 64
#: Share of a node's token positions that branch: one over the similarity sought.
PICK = 100 / (PERCENT * TOKENS)
SMALL_NODE = 2_000
LEVELS = 6
#: Estimated similarity under which two classes are not compared on full sets. With 64
#: tokens a pair of 0.8 falls below it once in ten million.
ESTIMATE = 0.5
#: Copies of the minimum's side in star joins, for vertices with very many links.
SALTS = 16
#: Shingles compared in one task: groups with more are cut in pairs of blocks.
GROUP_SHINGLES = 2_000_000
MEMO_WORDS = 500_000

_GOLD = 0x9E3779B97F4A7C15
_SETS = "n_shingles long, digest binary, tokens binary"


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_ascii(text: str) -> bytes:
    # On bytes, lower() changes A-Z only, and split() cuts at the six ASCII blanks.
    return text.encode("utf-8", "surrogatepass").lower()


class Shingler:
    """Sets of hashed shingles; remembers hashes of words."""

    def __init__(self, words: int):
        import xxhash

        self.words = words
        self.of = xxhash.xxh64_intdigest
        self.memo: dict[bytes, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        words = lower_ascii(text).split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        memo, of = self.memo, self.of
        hashes = list(map(memo.get, words))
        if None in hashes:
            for w in words:
                if w not in memo:
                    memo[w] = of(w)
            hashes = [memo[w] for w in words]
        h = np.array(hashes, dtype=np.uint64)
        n = len(h) - self.words + 1
        if n <= 0:
            # A shorter sequence must not look like a shingle of full length.
            total = np.uint64(len(h))
            for x in h:
                total = mix(total * np.uint64(_GOLD) + x)
            return np.array([total], dtype=np.uint64)
        s = np.zeros(n, dtype=np.uint64)
        for k in range(self.words):
            s = s * np.uint64(_GOLD) + h[k : k + n]
        return np.unique(mix(s))


def factors() -> np.ndarray:
    return mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(_GOLD)) | np.uint64(1)


def minwise(shingles: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The smallest hash of the set under each of ``TOKENS`` functions, as 32 bits."""
    low = np.full(len(by), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        low = np.minimum(low, ((part[None, :] ^ (part[None, :] >> np.uint64(29))) * by[:, None]).min(1))
    return (low >> np.uint64(32)).astype(np.uint32)


def sketch(text: Column, words: int) -> Column:
    """Struct (n_shingles, digest, tokens) of a text; no digest for an empty set."""

    @F.arrow_udf(_SETS)
    def sketched(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import xxhash

        shingler, by = Shingler(words), factors()
        for texts in freed(batches):
            n, digest, tokens = [], [], []
            for text in texts:
                s = shingler(text.as_py() or "")
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                tokens.append(minwise(s, by).tobytes() if len(s) else None)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(tokens, pa.binary())],
                ["n_shingles", "digest", "tokens"],
            )

    return sketched(text)


def full_sets(text: Column, digest: Column, words: int) -> Column:
    """The hashed shingles of a text as bytes, NULL where they have another digest.

    The digest comes from the other side of a join, so sets are made of joined rows only.
    """

    @F.arrow_udf("binary")
    def sets(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        import xxhash

        shingler = Shingler(words)
        for texts, digests in freed(batches):
            found = []
            for text, own in zip(texts, digests, strict=True):
                data = shingler(text.as_py() or "").tobytes()
                found.append(data if xxhash.xxh3_128_digest(data) == own.as_py() else None)
            yield pa.array(found, pa.binary())

    return sets(text, digest)


def picked(nodes: np.ndarray, used: np.ndarray) -> np.ndarray:
    """For each node the positions at which it branches: at least one, none of the used."""
    place = np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(_GOLD)
    u = (mix(nodes[:, None] ^ place[None, :]) >> np.uint64(11)).astype(float) / 2.0**53
    bits = np.uint64(1) << np.arange(TOKENS, dtype=np.uint64)
    u[(used[:, None] & bits[None, :]) != 0] = 2.0
    pick = u < PICK
    pick[np.arange(len(nodes)), u.argmin(1)] = True
    return pick & (u < 2.0)


def root_positions(trees: int) -> list[np.ndarray]:
    """The positions at which each root branches: as many as ``picked`` says, dealt from a
    permutation of all, so roots share none before all have been used."""
    order = np.argsort(mix(np.arange(1, TOKENS + 1, dtype=np.uint64) * np.uint64(_GOLD)), kind="stable")
    root = mix(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(_GOLD))
    ends = np.cumsum(picked(root, np.zeros(trees, np.uint64)).sum(1))
    starts = np.concatenate([[0], ends[:-1]])
    return [order[np.arange(a, b) % TOKENS] for a, b in zip(starts, ends, strict=True)]


def child(nodes: np.ndarray, position: np.ndarray, value: np.ndarray) -> np.ndarray:
    key = (position.astype(np.uint64) << np.uint64(32)) | value.astype(np.uint64)
    return mix(mix(nodes + np.uint64(_GOLD)) ^ mix(key + np.uint64(1)))


def _longs(column: pa.Array) -> np.ndarray:
    return np.array(column.to_numpy(zero_copy_only=False), dtype=np.int64).view(np.uint64)


def _token_matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, TOKENS)


_MEMBER = "node long, used long, digest binary"


def _children(nodes, used, digests: list[bytes], tokens: np.ndarray, pick=None) -> pa.RecordBatch:
    row, position = np.nonzero(picked(nodes, used) if pick is None else pick)
    after = used[row] | (np.uint64(1) << position.astype(np.uint64))
    to = child(nodes[row], position, tokens[row, position])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(to.view(np.int64)),
            pa.array(after.view(np.int64)),
            pa.array([digests[i] for i in row], pa.binary()),
        ],
        ["node", "used", "digest"],
    )


def roots(classes: DataFrame, trees: int) -> DataFrame:
    """Members of the first level of all trees."""

    positions = root_positions(trees)

    def plant(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            if not batch.num_rows:
                continue
            digests, tokens = batch.column(0).to_pylist(), _token_matrix(batch.column(1))
            for tree in range(trees):
                root = mix(np.full(len(digests), tree + 1, dtype=np.uint64) * np.uint64(_GOLD))
                pick = np.zeros((len(digests), TOKENS), dtype=bool)
                pick[:, positions[tree]] = True
                yield _children(root, np.zeros(len(digests), np.uint64), digests, tokens, pick)

    return classes.select("digest", "tokens").mapInArrow(plant, _MEMBER)


def branch(members: DataFrame) -> DataFrame:
    """Members (node, used, digest, tokens) of the level below."""

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in freed(batches):
            if batch.num_rows:
                yield _children(
                    _longs(batch.column(0)),
                    _longs(batch.column(1)),
                    batch.column(2).to_pylist(),
                    _token_matrix(batch.column(3)),
                )

    return members.select("node", "used", "digest", "tokens").mapInArrow(down, _MEMBER)


def with_size(members: DataFrame) -> DataFrame:
    """Members of nodes of two or more, with ``n``; counts are combined before the shuffle."""
    sizes = members.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return members.join(sizes, "node")


def in_blocks(members: DataFrame) -> DataFrame:
    """Large nodes as pairs of blocks: each pair of members is in one of the new nodes."""
    n_blocks = F.ceil(F.col("n") * 2 / SMALL_NODE).cast("int")
    block = F.pmod(F.xxhash64("digest"), n_blocks.cast("long")).cast("int")
    return members.withColumns({"b": block, "o": F.explode(F.sequence(F.lit(0), n_blocks - 1))}).select(
        F.xxhash64("node", F.least("b", "o"), F.greatest("b", "o")).alias("node"), "digest"
    )


def small_nodes(classes: DataFrame, trees: int = TREES, levels: int = LEVELS) -> DataFrame:
    """(node, digest) of all nodes that are compared exhaustively."""
    level = stage(with_size(roots(classes, trees)), "nodes")
    ready = level.where(F.col("n") <= SMALL_NODE).select("node", "digest")
    for _ in range(levels - 1):
        large = level.where(F.col("n") > SMALL_NODE)
        if large.isEmpty():
            return ready
        below = branch(large.join(classes.select("digest", "tokens"), "digest"))
        level = stage(with_size(below.dropDuplicates(["node", "digest"])), "nodes")
        ready = ready.unionByName(level.where(F.col("n") <= SMALL_NODE).select("node", "digest"))
    return ready.unionByName(in_blocks(level.where(F.col("n") > SMALL_NODE)))


def by_node(
    rows: DataFrame, work: Callable[[list[bytes], list[bytes]], list[tuple]], schema: str, names: list[str]
) -> DataFrame:
    """Apply ``work`` to the digests and values of each node. Rows are (node, digest, value).

    Rows of a node stand together in a partition and nodes are small, so a task holds one
    node at a time; there is no call per group from the JVM.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digests, values, out = None, [], [], []
        for batch in freed(batches):
            for n, d, v in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True
            ):
                if n != node:
                    out += work(digests, values)
                    node, digests, values = n, [], []
                digests.append(d)
                values.append(v)
            if len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
                out = []
        out += work(digests, values)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)

    return (
        rows.select("node", "digest", "value")
        .repartition("node")
        .sortWithinPartitions("node")
        .mapInArrow(each, schema)
    )


def pairs_of_blocks(names: list[bytes], sizes: list[int], most: int) -> list[list[bytes]]:
    """Lists of names of which each pair is in one; no more than ``most`` by size, if possible.

    A block is over half of that only if one member is.
    """
    blocks, size = [[]], 0
    for name, n in zip(names, sizes, strict=True):
        if blocks[-1] and size + n > most // 2:
            blocks.append([])
            size = 0
        blocks[-1].append(name)
        size += n
    if sum(sizes) <= most or len(blocks) < 2:
        return [names]
    return [a + b for i, a in enumerate(blocks) for b in blocks[:i]]


def alike_groups(
    digests: list[bytes], values: list[bytes], most: int = GROUP_SHINGLES
) -> list[tuple[bytes, bytes]]:
    """(group, digest): members joined by estimated similarity; loners are left out.

    A value holds the tokens and the number of shingles (see ``sized``). A group is named
    by a hash of its members, so that one found in several trees or nodes is compared on
    full sets once.
    """
    import xxhash

    digests, first = np.unique(np.array(digests, dtype=object), return_index=True)
    if len(digests) < 2:
        return []
    tokens = b"".join([values[i][:-8] for i in first])
    matrix = np.frombuffer(tokens, dtype=np.uint32).reshape(-1, TOKENS)
    sizes = [int.from_bytes(values[i][-8:], "big") for i in first]
    left = set(range(len(digests)))
    groups = []
    while left:
        group, todo = [], [left.pop()]
        while todo:
            i = todo.pop()
            group.append(i)
            if left:
                rest = np.fromiter(left, int, len(left))
                near = rest[(matrix[rest] == matrix[i]).sum(1) >= ESTIMATE * TOKENS].tolist()
                left.difference_update(near)
                todo += near
        if len(group) > 1:
            group.sort()
            parts = pairs_of_blocks([digests[i] for i in group], [sizes[i] for i in group], most)
            for names in parts:
                groups += [(xxhash.xxh3_128_digest(b"".join(names)), d) for d in names]
    return groups


def sized(tokens: Column, n_shingles: Column) -> Column:
    """Tokens, and behind them the number of shingles in eight bytes."""
    return F.concat(tokens, F.unhex(F.lpad(F.hex(n_shingles), 16, "0")))


def links(digests: list[bytes], sets: list[bytes], percent: int = PERCENT) -> list[tuple[bytes, bytes]]:
    """A spanning forest of the links between full sets.

    Each member asks once which of those not reached yet it is linked with, so a tight
    group takes few steps and no link between different components can be missed.
    """
    if len(digests) < 2:
        return []
    shingles = [np.frombuffer(s, dtype=np.uint64) for s in sets]
    sizes = np.array([len(s) for s in shingles])
    distinct, at = np.unique(np.concatenate(shingles), return_inverse=True)
    ends = np.cumsum(sizes)
    parts = np.split(at, ends[:-1])
    # The member whose shingles are the most common reaches most others.
    common = np.bincount(at, minlength=len(distinct))
    order = np.argsort([-common[p].mean() for p in parts], kind="stable")
    left = np.ones(len(digests), dtype=bool)
    found, mark = [], np.zeros(len(distinct), dtype=np.int32)
    for start in order:
        if not left[start]:
            continue
        left[start] = False
        todo = [start]
        while todo and left.any():
            i = todo.pop()
            rest = np.flatnonzero(left)
            rest = rest[
                (100 * sizes[rest] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[rest])
            ]
            if not len(rest):
                continue
            mark[parts[i]] = 1
            flat = mark[np.concatenate([parts[j] for j in rest])]
            both = np.add.reduceat(flat, np.cumsum(sizes[rest]) - sizes[rest])
            mark[parts[i]] = 0
            near = rest[100 * both >= percent * (sizes[rest] + sizes[i] - both)]
            left[near] = False
            found += [(digests[i], digests[j]) for j in near]
            todo += near.tolist()
    return found


def confirmed_links(
    docs: DataFrame, classes: DataFrame, groups: DataFrame, key: str, text: str, words: int, percent: int
) -> DataFrame:
    """(a, b) keys of classes linked on full sets."""
    needed = groups.select("digest").distinct().join(classes.select("digest", "rep"), "digest")
    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("_text"))
    # A class is compared on the text of its representative; a key that stands for
    # several texts is told apart by the digest.
    value = full_sets(F.col("_text"), F.col("digest"), words)
    sets = texts.join(needed, "rep").select("rep", "digest", value.alias("value"))
    sets = sets.where("value IS NOT NULL").dropDuplicates(["digest"])
    rows = groups.join(sets, "digest").select(F.col("group").alias("node"), F.col("rep"), "value")

    def compare(reps, values):
        return links(reps, values, percent)

    return by_node(
        rows.withColumnRenamed("rep", "digest"), compare, "a long, b long", ["a", "b"]
    )


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (u, v): each vertex hands its neighbours to the least of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("u > v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    salt = F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")
    salted = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = both.withColumn("salt", salt).join(salted, ["u", "salt"])
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    moved = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, component): the least vertex each linked vertex reaches, itself left out.

    Rounds of large and small stars end when nothing changes; each round is a table in
    the shared folder, so a lost executor costs one round.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select("u", F.col("v").alias("component"))
        before = now
        edges = stage(_star(_star(edges, True), False), "links")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    trees: int = TREES,
) -> DataFrame:
    """(key, n_shingles, component_id, kept) for every row of ``docs``."""
    rows = stage(
        docs.select(F.col(key).alias("_key"), sketch(F.col(text), words).alias("s")).select("_key", "s.*"),
        "sketches",
    )
    named = rows.where("digest IS NOT NULL AND _key IS NOT NULL")
    classes = stage(
        named.groupBy("digest").agg(
            F.min("_key").alias("rep"),
            F.min("tokens").alias("tokens"),
            F.min("n_shingles").alias("n_shingles"),
        ),
        "classes",
    )
    members = small_nodes(classes, trees).join(
        classes.select("digest", sized(F.col("tokens"), F.col("n_shingles")).alias("value")), "digest"
    )
    most = GROUP_SHINGLES

    def alike(digests, values):
        return alike_groups(digests, values, most)

    groups = stage(
        by_node(members, alike, "group binary, digest binary", ["group", "digest"]).distinct(),
        "groups",
    )
    found = components(confirmed_links(docs, classes, groups, key, text, words, percent))
    labels = stage(
        classes.select("digest", "rep")
        .join(found, F.col("rep") == F.col("u"), "left")
        .select("digest", F.coalesce("component", "rep").alias("component_id")),
        "labels",
    )
    # Rows without a set or a name get join keys of their own and stay alone.
    own = F.when(
        F.col("digest").isNotNull() & F.col("_key").isNotNull(), F.col("digest")
    ).otherwise(F.uuid().cast("binary"))
    joined = rows.withColumn("_own", own).join(
        labels.withColumnRenamed("digest", "_digest"), F.col("_own") == F.col("_digest"), "left"
    )
    component = F.coalesce("component_id", "_key")
    return joined.select(
        F.col("_key").alias(key),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(component == F.col("_key"), F.lit(True)).alias("kept"),
    )
