from collections import Counter

import numpy as np
import pytest

from gristmill.llm import langid, queries

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op1_language_id(spark, SMALL).collect()
    assert len(rows) == 1000
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100 and np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def brute(text, size):
    clean = "".join(c if c.isalpha() else " " for c in text.lower())
    clean = " " + " ".join(clean.split()) + " "
    n = Counter()
    for k in (1, 2, 3):
        for i in range(len(clean) - k + 1):
            g = clean[i : i + k]
            if " " not in g[1:-1] and g != " ":
                n[g] += 1
    key = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    return [key(g) for g in sorted(n, key=lambda g: (-n[g], key(g)))][:size]


def test_profiles_match_a_plain_count(spark):
    rows = [("the cat sat on the mat, the end", "en"), ("le chat était là-bas", "fr"), ("und der hund", "de"), (None, "en"), ("x", None)]
    got = langid.profiles(spark.createDataFrame(rows, "text string, lang string"), size=20)
    assert list(got) == ["de", "en", "fr"]
    for text, name in rows[:3]:
        assert got[name].tolist() == brute(text, 20)


def test_edge_cases(spark):
    rows = [(None, 1), ("", 2), ("123 !? ²", 3), ("the " * 50_000, 4), ("der", 5), ("der", 5)]
    docs = spark.createDataFrame(rows, "text string, score int")
    train = spark.createDataFrame([("the cat and the hat", "en"), ("der hund und das", "de")], "text string, lang string")
    column = langid.predict(docs.text, langid.profiles(train))
    got = [tuple(r["p"]) for r in docs.select(column.alias("p")).collect()]
    assert [g[0] for g in got] == ["und", "und", "und", "en", "de", "de"] and got[0][1] == 0
    assert docs.limit(0).select(column).collect() == []
    none = langid.predict(docs.text, langid.profiles(train.limit(0)))
    assert {r["p"]["lang_pred"] for r in docs.select(none.alias("p")).collect()} == {"und"}


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 1)
    train = spark.createDataFrame([("a b", "x"), ("c d", "y")], "text string, lang string")
    with pytest.raises(ValueError):
        langid.profiles(train)
