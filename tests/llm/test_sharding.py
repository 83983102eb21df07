from collections import Counter, defaultdict
from zlib import crc32

import pytest

from gristmill.llm import queries, sharding

SMALL = "/root/testdata/sf0.01"


def check(rows, texts, shards):
    """The law and all columns; returns how many shards each text is in."""
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts)
    by_id = defaultdict(list)
    for i, t in texts:
        by_id[i].append((t or "").encode())
    slots, where = defaultdict(list), defaultdict(set)
    for r in rows:
        own = [t for t in by_id[r["doc_id"]] if crc32(t) == r["text_crc32"] and len(t) + 16 == r["size"]]
        assert own and r["law"] == "rows" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        where[own[0]].add(r["shard"])
    sizes = [len(slots[s]) for s in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return {t: len(s) for t, s in where.items()}


def test_query_keeps_copies_together(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    spread = check(queries.op11_sharding(spark, SMALL).collect(), texts, 40)
    assert max(spread.values()) == 1


@pytest.mark.parametrize(
    "texts, most",
    [
        # A group of half of all rows fills shards, and takes part of one more.
        ([(i, "same") for i in range(60)] + [(100 + i, f"t{i}") for i in range(60)], 6),
        # Only copies: moves are exchanges.
        ([(i, f"t{i % 20}") for i in range(100)], 4),
        # NULL is the empty text; keys and rows repeat, or are NULL.
        ([(1, None), (2, ""), (None, None), (3, "a"), (3, "a"), (None, "b"), (4, "ü")] * 3, 8),
        ([(1, "a")], 1),
    ],
)
def test_even_shards(spark, texts, most):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in texts], "doc_id long, text string, shard int, slot string")
    spread = check(sharding.shard_documents(docs, shards=10).collect(), texts, 10)
    assert max(spread.values()) <= most


def test_fewer_cuts_than_the_deal(spark):
    texts = [(i, f"t{i % 20}") for i in range(100)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    spread = check(sharding.shard_documents(docs, shards=10).collect(), texts, 10)
    assert sum(spread.values()) <= 50  # 100 when dealt, 20 at best


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.shard_documents(docs).collect() == []


def test_quotas_balance():
    asked = {(0, 1): 10, (1, 0): 4, (2, 1): 5, (0, 2): 1, (1, 3): 2, (3, 0): 9}
    room = [0, 3, 0, 0]
    got = sharding.quotas(asked, room)
    load = [0] * 4
    for (s, t), n in got.items():
        assert 0 < n <= asked[s, t]
        load[s] -= n
        load[t] += n
    assert all(a <= b for a, b in zip(load, room))
    assert got[1, 3] == 2 and got[3, 0] >= 2  # a cycle of three shards
    assert sharding.quotas({(0, 1): 5}, [0, 0]) == {}


def test_same_result_each_time(spark):
    docs = spark.createDataFrame([(i, f"t{i % 7}") for i in range(50)], "doc_id long, text string")
    one = sharding.shard_documents(docs, shards=4).collect()
    two = sharding.shard_documents(docs.repartition(5), shards=4).collect()
    assert sorted(one) == sorted(two)
