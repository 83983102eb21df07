"""Balanced shards by label propagation.

Documents are linked with their copies: those of one group, by default an equal text.
Shards keep the law ``rows``: their numbers of documents differ by one at most, from the
first deal to the result. Documents are dealt round-robin, which cuts nearly every link.
Then, round after round, documents ask to move to the shard that holds most of their
group, and quotas decide how many may: moves go in cycles of shards, which leave all as
full as they were, or end in room that documents without links leave, as these go anywhere.
Rounds end when no move is granted. Documents without links fill up what is left.

Copies are interchangeable, so a round works on counts by (group, shard): at most a row
for each shard of a group, however many copies it has, and a count may move in part. Which
copy goes where is settled once, at the end, by the copy's place in its group. Only loads,
requests and quotas by shard or pair of shards come to the driver; their number does not
depend on the data.

Positions come from row numbers and sums inside hash buckets, shifted by the buckets before;
a group's copies are numbered in parts of their own, so that a group of a third of all rows
is many tasks' work.

Defined results: NULL is the empty text, of size 16; repeated rows and NULL keys are
documents of their own, and rows equal in key and text may change places among
themselves; with fewer documents than shards, the last shards stay empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.operators.numbering import number_rows
from gristmill.sources.staging import stage

SHARDS = 40
#: A document's bytes besides its text.
OVERHEAD = 16
#: Rounds at most; a group of many shards takes one for each shard it fills.
ROUNDS = 60
#: Rounds without a move before the end.
TRIES = 3
#: Buckets of groups for positions and sums: three digits of the group's hash.
BUCKET_DIGITS = 3
#: The same where sums are by pairs of shards.
PAIR_DIGITS = 1
#: Rows of a group that are numbered together on average, if it is a large one.
PART_ROWS = 1_000
MAX_PARTS = 4096


def group_of(text: Column) -> Column:
    """The group of a document: its text, by a hash of 128 bits."""
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def bucket(group: str, digits: int = BUCKET_DIGITS) -> Column:
    return F.substring(group, 1, digits)


def sums_before(
    df: DataFrame, by: list[str], value: str, name: str, digits: int = BUCKET_DIGITS
) -> DataFrame:
    """Add the sum of ``value`` over the rows before, per ``by``, in the order of ``group``.

    The sums by bucket are broadcast: 16 ** ``digits`` rows at most for each value of ``by``.
    """
    b = df.withColumn("_bucket", bucket("group", digits))
    sizes = b.groupBy(*by, "_bucket").agg(F.sum(value).alias("_size"))
    inside = Window.partitionBy(*by, "_bucket").orderBy("group")
    to_here = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *by, "_bucket", F.coalesce(F.sum("_size").over(to_here), F.lit(0)).alias("_start")
    )
    before = F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    return (
        b.withColumn(name, F.coalesce(before, F.lit(0)))
        .join(F.broadcast(starts), [*by, "_bucket"])
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_bucket", "_start")
    )


def capacities(n: int, shards: int) -> list[int]:
    """Documents of each shard: as even as can be."""
    return [n // shards + (s < n % shards) for s in range(shards)]


def dealt(linked: DataFrame, shards: int) -> DataFrame:
    """(group, shard, c) of all groups, their documents dealt round-robin one after another."""
    at = sums_before(linked, [], "n", "pos")
    j = F.sequence(F.lit(0).cast("long"), F.least(F.col("n"), F.lit(shards)) - 1)
    return at.select("group", "n", "pos", F.explode(j).alias("j")).select(
        "group",
        F.pmod(F.col("pos") + F.col("j"), F.lit(shards)).cast("int").alias("shard"),
        (1 + F.floor((F.col("n") - 1 - F.col("j")) / shards)).alias("c"),
    )


def loads(blocks: DataFrame, shards: int) -> list[int]:
    """Linked documents of each shard."""
    found = {r["shard"]: r["c"] for r in blocks.groupBy("shard").agg(F.sum("c").alias("c")).collect()}
    return [found.get(s, 0) for s in range(shards)]


def requests(blocks: DataFrame, open_shards: list[int]) -> DataFrame:
    """(group, shard, c, target): blocks that would join a larger one of their group.

    The target is the group's largest block in a shard of ``open_shards``; ties go by a
    hash of group and shard, so that they favour no shard.
    """
    weight = F.struct(F.col("c"), F.xxhash64("group", "shard").alias("tie"), F.col("shard"))
    ranked = blocks.withColumn("weight", weight)
    top = (
        ranked.where(F.col("shard").isin(open_shards))
        .groupBy("group")
        .agg(F.max("weight").alias("top"))
    )
    return (
        ranked.join(top, "group")
        .where(F.col("weight") < F.col("top"))
        .select("group", "shard", "c", F.col("top.shard").alias("target"))
    )


def quotas(asked: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """Documents that may move between each pair of shards, so that none gets too full.

    Moves are granted along cycles of requests, shortest first, found by search. Room is a
    node of its own: a shard with room leads to it, and it leads to every shard, so a path
    of moves that ends in room is a cycle too.
    """
    free = len(room)
    left: dict[int, dict[int, float]] = {s: {} for s in range(free + 1)}
    for (s, t), n in asked.items():
        left[s][t] = n
    for s, n in enumerate(room):
        left[s][free] = max(n, 0)
        left[free][s] = float("inf")
    granted: dict[tuple[int, int], int] = {}
    for (s, t), _ in sorted(asked.items(), key=lambda x: (-x[1], x[0])):
        while left[s][t] > 0 and (path := shortest(left, t, s)):
            steps = list(zip([s, *path[:-1]], path, strict=True))
            n = min(left[a][b] for a, b in steps)
            for a, b in steps:
                left[a][b] -= n
                if free not in (a, b):
                    granted[a, b] = granted.get((a, b), 0) + int(n)
    return granted


def shortest(left: dict[int, dict[int, float]], start: int, goal: int) -> list[int]:
    """A shortest path over what is left, start and goal included; empty if there is none."""
    came: dict[int, int | None] = {start: None}
    line = [start]
    for at in line:
        if at == goal:
            path = [at]
            while (at := came[at]) is not None:
                path.append(at)
            return path[::-1]
        for to in sorted(left[at]):
            if left[at][to] > 0 and to not in came:
                came[to] = at
                line.append(to)
    return []


def one_round(blocks: DataFrame, room: list[int], stuck: int) -> DataFrame | None:
    """The blocks after the moves that quotas grant; None if there are none.

    Targets are the shards with room, or all if there is none; once stuck, groups look for
    targets among another half of all shards each time, which makes for other cycles.
    """
    spark = blocks.sparkSession
    open_shards = [s for s, n in enumerate(room) if n > 0] or list(range(len(room)))
    if stuck:
        open_shards = [s for s in range(len(room)) if s >> (stuck - 1) & 1]
    asked = stage(requests(blocks, open_shards), "shard-requests")
    pairs = asked.groupBy("shard", "target").agg(F.sum("c").alias("c")).collect()
    granted = quotas({(r["shard"], r["target"]): r["c"] for r in pairs}, room)
    if not granted:
        return None
    quota = spark.createDataFrame(
        [(s, t, n) for (s, t), n in granted.items()], "shard int, target int, quota long"
    )
    placed = sums_before(
        asked.join(F.broadcast(quota), ["shard", "target"]),
        ["shard", "target"],
        "c",
        "before",
        PAIR_DIGITS,
    )
    moves = placed.select(
        "group", "shard", "target", F.least("c", F.col("quota") - F.col("before")).alias("c")
    ).where("c > 0")
    return stage(
        blocks.unionByName(moves.select("group", "shard", (-F.col("c")).alias("c")))
        .unionByName(moves.select("group", F.col("target").alias("shard"), "c"))
        .groupBy("group", "shard")
        .agg(F.sum("c").alias("c"))
        .where("c > 0"),
        "shard-blocks",
    )


def propagate(linked: DataFrame, room_of: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(group, shard, c) of linked groups (group, n), with at most ``room_of`` a shard."""
    blocks, stuck = stage(dealt(linked, len(room_of)), "shard-blocks"), 0
    for _ in range(rounds):
        room = [a - b for a, b in zip(room_of, loads(blocks, len(room_of)), strict=True)]
        moved = one_round(blocks, room, stuck)
        if moved is None and (stuck := stuck + 1) > TRIES:
            break
        if moved is not None:
            blocks, stuck = moved, 0
    return blocks


def places(blocks: DataFrame) -> DataFrame:
    """(group, blocks): the blocks of each group by shard, with the rank of their first
    document in the group and its slot in the shard."""
    at = sums_before(blocks, ["shard"], "c", "slot")
    in_group = Window.partitionBy("group").orderBy("shard")
    before = F.sum("c").over(in_group.rowsBetween(Window.unboundedPreceding, -1))
    return (
        at.withColumn("first", F.coalesce(before, F.lit(0)))
        .groupBy("group")
        .agg(F.sort_array(F.collect_list(F.struct("first", "shard", "slot"))).alias("blocks"))
    )


def fill(single: DataFrame, taken: list[int], room_of: list[int]) -> DataFrame:
    """(group, blocks) of groups of one document, in the order of their hash."""
    need = [a - b for a, b in zip(room_of, taken, strict=True)]
    starts = [sum(need[:s]) for s in range(len(need))]
    at = number_rows(single, bucket("group"), [F.col("group")])
    ranges = F.array(
        *[
            F.struct(
                F.lit(a).cast("long").alias("start"),
                F.lit(s).alias("shard"),
                F.lit(t - a).cast("long").alias("shift"),
            )
            for s, (a, n, t) in enumerate(zip(starts, need, taken, strict=True))
            if n
        ]
    )
    own = F.element_at(F.filter(ranges, lambda r: r["start"] <= F.col("pos")), -1)
    return at.withColumn("own", own).select(
        "group",
        F.array(
            F.struct(
                F.lit(0).cast("long").alias("first"),
                F.col("own.shard").alias("shard"),
                (F.col("pos") + F.col("own.shift")).alias("slot"),
            )
        ).alias("blocks"),
    )


def shard_rows(
    docs: DataFrame, group: str, order: list[str], shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """All rows and columns, with ``shard`` and ``slot``: few groups cut, rows even.

    ``group`` names a column of hexadecimal hashes; rows are numbered inside their group
    by ``order``, which should leave no ties but between rows that are equal.
    """
    n = docs.count()
    parts = max(1, min(MAX_PARTS, n // PART_ROWS))
    rows = docs.withColumnRenamed(group, "group").withColumn(
        "_part", F.pmod(F.xxhash64(*order), F.lit(parts)).cast("int")
    )
    parts_of = stage(rows.groupBy("group", "_part").agg(F.count("*").alias("c")), "shard-parts")
    groups = stage(parts_of.groupBy("group").agg(F.sum("c").alias("n")), "shard-groups")
    room_of = capacities(n, shards)
    blocks = propagate(groups.where("n > 1"), room_of, rounds)
    single = groups.where("n = 1").select("group")
    placed = places(blocks)
    taken = loads(blocks, shards)
    if taken != room_of:
        placed = placed.unionByName(fill(single, taken, room_of))
    of_group = Window.partitionBy("group").orderBy("_part")
    before = F.sum("c").over(of_group.rowsBetween(Window.unboundedPreceding, -1))
    starts = (
        parts_of.withColumn("_start", F.coalesce(before, F.lit(0)))
        .join(placed, "group")
        .select("group", "_part", "_start", "blocks")
    )
    in_part = Window.partitionBy("group", "_part").orderBy(*order)
    rank = F.col("_start") + F.row_number().over(in_part) - 1
    own = F.element_at(F.filter("blocks", lambda b: b["first"] <= F.col("_rank")), -1)
    return (
        rows.join(starts, ["group", "_part"])
        .withColumn("_rank", rank)
        .withColumn("_own", own)
        .withColumn("shard", F.col("_own.shard"))
        .withColumn("slot", F.col("_own.slot") + F.col("_rank") - F.col("_own.first"))
        .drop("_part", "_start", "blocks", "_rank", "_own")
        .withColumnRenamed("group", group)
    )


def shard_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = SHARDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) of every document.

    Texts are read once; what goes on is a key, a hash and a size.
    """
    plain = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = stage(
        docs.select(
            F.col(key).alias("key"),
            (F.octet_length(plain) + F.lit(OVERHEAD)).cast("long").alias("size"),
            F.crc32(plain).alias("text_crc32"),
            group_of(F.col(text)).alias("copies"),
        ),
        "shard-rows",
    )
    return shard_rows(narrow, "copies", ["key"], shards, rounds).select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
