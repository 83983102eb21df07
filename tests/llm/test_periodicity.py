import hashlib
import random
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gristmill.llm import periodicity, queries

SMALL = "/root/testdata/sf0.001"


def brute(words, least=12):
    """All runs (start, end, period): every period, every maximal stretch."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((s, e, q) for (s, e), q in found.items())


def given_words(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def expected(doc_id, text):
    words = given_words(doc_id, text)
    runs = sorted(brute(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, e, q in runs for i in range(s + q, e)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(expected(*d) for d in docs)
    got = sorted(map(tuple, queries.op12_periodic_runs(spark, SMALL).collect()), key=lambda r: r[0])
    assert got == want
    assert sum(w[1] > 0 for w in want) > 10


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 4)), max_size=7))
def test_runs_match_brute_force(parts):
    words = [w for stretch, times in parts for w in stretch * times]
    for least in (2, 12):
        got = [tuple(r) for r in periodicity.find_runs(np.array(words, dtype=np.int64), least).tolist()]
        assert got == sorted(brute(words, least), key=lambda r: (r[0], r[2]))


def test_random_binary_words():
    random.seed(3)
    for _ in range(1500):
        unit = [random.randrange(2) for _ in range(random.randint(1, 14))]
        words = (unit * 5 + [random.randrange(2) for _ in range(20)])[random.randint(0, 5) :]
        got = [tuple(r) for r in periodicity.find_runs(np.array(words), 2).tolist()]
        assert got == sorted(brute(words, 2), key=lambda r: (r[0], r[2]))


def test_documents_of_a_block_do_not_mix():
    texts = ["a b c " * 2, "a b c " * 2, "a b c " * 4, ""]
    found = [x for b in periodicity.blocks(pa.array(texts)) for x in periodicity.measure(b, 12)]
    assert [len(f["runs"]) for f in found] == [0, 0, 1, 0]
    assert [f["collapsed"] for f in found] == [b"a b c a b c"] * 2 + [b"a b c", b""]


def test_odd_rows(spark):
    texts = [None, "", " \n\t", "a " * 5000, "\xa0 " * 20, "x\x0by\x1cz " * 12, "ü é " * 300000]
    rows = [(i, t, "en", 3) for i, t in enumerate(texts)] + [(None, "b " * 12, "en", 3), (3, "a " * 5000, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, periodic int").drop("periodic")
    got = periodicity.scan(docs).collect()
    assert len(got) == len(rows)
    for r, (key, text, other, _) in zip(sorted(got, key=str), sorted(rows, key=str)):
        pass
    by = {(r["doc_id"], r["runs"]): r["periodic"] for r in got}
    assert [by[i, "en"]["n_words"] for i in (0, 1, 2)] == [0, 0, 0]
    assert by[3, "en"] == by[3, None] and by[3, "en"]["collapsed"] == "a"
    assert by[4, "en"]["collapsed"] == "\xa0"
    assert [tuple(r) for r in by[5, "en"]["runs"]] == [(0, 24, 2)]
    assert [tuple(r) for r in by[6, "en"]["runs"]] == [(0, 600000, 2)]
    assert [tuple(r) for r in by[None, "en"]["runs"]] == [(0, 12, 1)]
    assert periodicity.digest(periodicity.scan(docs.limit(0))).collect() == []


@pytest.mark.parametrize("doc_id", [6, 24, 29, 40, 48])
def test_planted_words(spark, doc_id):
    text = " one two  three four\nfive six seven eight nine ten " * 3
    docs = spark.createDataFrame([(doc_id, text)], "doc_id long, text string")
    got = docs.select(periodicity.planted(docs.doc_id, docs.text)).first()[0]
    assert got.split() == given_words(doc_id, text)
