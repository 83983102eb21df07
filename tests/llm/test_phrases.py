import re
from collections import Counter
from fractions import Fraction
from math import floor

import numpy as np
from pyspark.sql import functions as F

from gristmill.llm import phrases, queries

SMALL = "/root/testdata/sf0.001"
FEW = 20


def brute(rows, threshold, limit=2000):
    count, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for n in range(1, 6):
                    if i + n <= len(words):
                        count[lang, tuple(words[i : i + n])] += 1
    often = {k: f for k, f in count.items() if len(k[1]) > 1 and f >= threshold}
    inside = Counter()
    for (lang, p), f in often.items():
        for s in range(len(p)):
            for e in range(s + 1, len(p) + 1):
                if e - s < len(p):
                    inside[lang, p[s:e]] = max(inside[lang, p[s:e]], f)
    best = []
    for (lang, p), a in often.items():
        if 100 * inside[lang, p] >= 100 * a:
            continue
        cuts = []
        for k in range(1, len(p)):
            l, r = count[lang, p[:k]], count[lang, p[k:]]
            cuts.append((floor(Fraction(1000 * a * total[lang], l * r)), k, l, r))
        score, _, l, r = min(cuts)
        best.append((lang, -score, -a, " ".join(p).encode(), l, r))
    rows, rank = [], Counter()
    for lang, score, a, p, l, r in sorted(best):
        rank[lang] += 1
        if rank[lang] <= limit:
            rows.append((lang, rank[lang], p.decode(), -a, l, r, total[lang], -score))
    return rows


def read(spark):
    return [(r["lang"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]


def test_collocations_match_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = brute(read(spark), FEW)
    assert len(want) > 50
    for sent in (phrases.SENT_SURVIVORS, 0):  # survivors sent to the tasks, or joined
        got = phrases.collocations(docs, threshold=FEW, sent=sent).collect()
        assert sorted(map(tuple, got)) == sorted(want)


def test_query_and_limit(spark):
    assert sorted(map(tuple, queries.op13_collocations(spark, SMALL).collect())) == sorted(brute(read(spark), 100))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = phrases.collocations(docs, threshold=FEW, limit=3).collect()
    assert sorted(map(tuple, got)) == sorted(brute(read(spark), FEW, 3))


def test_many_parts_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "PARTITION_CHARS", 20_000)
    monkeypatch.setattr(phrases, "GATHERED", 5_000)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 9_000)
    monkeypatch.setattr(phrases, "LEAST_MERGED", 100)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5)
    got = phrases.collocations(docs, threshold=FEW).collect()
    assert sorted(map(tuple, got)) == sorted(brute(read(spark), FEW))


def test_summaries_lose_no_frequent_key():
    """Merged summaries hold each frequent key, with an error below the bound."""
    rng = np.random.default_rng(5)
    keys = rng.zipf(1.3, 200_000) % 50_000
    want = Counter(keys.tolist())
    parts = []
    for part in np.array_split(keys, 23):
        key, count = np.unique(part.astype(np.uint64), return_counts=True)
        parts.append(phrases.packed(key, count.astype(np.int64)))
    threshold, old = 100, phrases.LEAST_MERGED
    phrases.LEAST_MERGED = 0
    try:
        capacity = phrases.SHARPNESS * len(keys) // threshold + 1
        key, count, taken = phrases.merged(parts, capacity)
        small_key, small_count, small_taken = phrases.merged(parts, len(keys) // threshold + 1)
    finally:
        phrases.LEAST_MERGED = old
    for k, c, t, most in ((key, count, taken, 25), (small_key, small_count, small_taken, 100)):
        assert t < most
        left = dict(zip(k.tolist(), c.tolist()))
        for x, f in want.items():
            if f >= threshold:
                assert f - t <= left[x] <= f


def test_summary_round_trip():
    key = np.array([0, 1, 5, 2**48 - 1], dtype=np.uint64)
    count = np.array([1, 2, 300, 2**40], dtype=np.int64)
    got = phrases.unpacked(phrases.packed(key, count))
    assert got[0].tolist() == key.tolist() and got[1].tolist() == count.tolist()


def test_odd_rows(spark):
    rows = [(None, "A b. A b, a B\ta b"), (None, None), ("und", "a b"), ("xx", ""), ("xx", "ÄB äb ÄB"), ("yy", "a" * 300_000), ("yy", " \n\t.;")]
    rows += [("odd\n\tlang", "p q " * 9)]
    rows += [("en", "the cat sat on the mat the cat sat")] * 9 + [("en", "x\x0by \xa0 z")]
    docs = spark.createDataFrame([(t, l, 1, "p") for l, t in rows], "text string, lang string, n int, phrase string")
    got = phrases.collocations(docs, threshold=5).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows, 5))
    assert {r["lang"] for r in got} == {"und", "en", "odd\n\tlang"}
    assert phrases.collocations(docs.limit(0)).collect() == []
    assert phrases.collocations(docs.where(F.col("text") == "")).collect() == []


def test_products_beyond_64_bits(spark):
    big = 10**13
    rows = [("en", "", 0, 3 * big), ("en", "a", 1, big), ("en", "b", 1, 2 * big + 1), ("en", "a b", 2, big - 7)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    row = phrases.scored(frequent).first()
    assert row["score"] == 1000 * (big - 7) * 3 * big // (big * (2 * big + 1))
