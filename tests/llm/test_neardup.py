import random
import re

import pytest

from gristmill.llm import neardup, queries

SMALL = "/root/testdata/sf0.01"


def shingles(text, k):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, percent=80):
    sets = [shingles(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j < i}:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[root(i)] = min(key, least.get(root(i), key))
    return {key: (len(s), least[root(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets, strict=True))}


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        assert (r["n_shingles"], r["component_id"]) == want[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] == r["component_id"])


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    check(queries.op4_near_duplicates(spark, SMALL).collect(), brute(rows, 4))


@pytest.fixture(scope="module")
def copies():
    """Large groups of near copies, a passage many texts share, exact copies."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    base = [word() for _ in range(150)]
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(160):
        edited = list(base)
        for _ in range(rng.randrange(5)):
            edited[rng.randrange(150)] = word()
        texts.append(" ".join(edited))
    for _ in range(120):
        texts.append(" ".join(word() for _ in range(rng.randrange(5, 120))) + " " + passage)
    texts += ["The Same text as ever, again"] * 30 + ["the same TEXT as ever, again"] * 5
    texts += ["one", "one", "ONE", "two words", "two  words", "a b c d", "", " \n", None]
    rng.shuffle(texts)
    return [(1000 - i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small", [400, 30])
def test_large_groups_match_brute_force(spark, copies, monkeypatch, small):
    # With nodes of 30 the group of copies branches to the last level and is cut in blocks.
    monkeypatch.setattr(neardup, "SMALL_NODE", small)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in copies], "doc_id long, text string, digest string, u int")
    check(neardup.near_duplicates(docs, words=4).collect(), brute(copies, 4))


def test_edge_cases(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (2, None), (4, "w " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, neardup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(3, 2, 3, True)] * 2 + [(2, 0, 2, True), (4, 1, 4, True)], key=str)
    assert neardup.near_duplicates(docs.limit(0)).collect() == []


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501)], "a long, b long")
    got = {r["u"]: r["component"] for r in neardup.components(edges).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {501: 500}


def test_heavy_groups_are_compared_in_parts(spark, copies, monkeypatch):
    names = [bytes([i]) for i in range(40)]
    values = [b"\1" * 4 * neardup.TOKENS + (50 + i).to_bytes(8, "big") for i in range(40)]
    parts = {}
    for group, name in neardup.alike_groups(names, values, 600):
        parts.setdefault(group, set()).add(name)
    assert max(sum(50 + x[0] for x in p) for p in parts.values()) <= 600
    assert all(any({a, b} <= p for p in parts.values()) for a in names for b in names)
    monkeypatch.setattr(neardup, "GROUP_SHINGLES", 3000)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    check(neardup.near_duplicates(docs, words=4).collect(), brute(copies, 4))


def test_ten_trees():
    assert neardup.TREES >= 10


def test_roots_share_no_position(spark):
    classes = spark.createDataFrame([(b"a", bytearray(4 * neardup.TOKENS))], "digest binary, tokens binary")
    used = [r["used"] for r in neardup.roots(classes, neardup.TREES).collect()]
    assert len(used) >= neardup.TREES and len(set(used)) == len(used)
