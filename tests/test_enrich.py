import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gristmill.operators import enrich

DOCS = [
    (1, "en", "the cat and the dog"),
    (2, "en", "the the of of"),
    (3, "de", "der hund und die katze und der"),
    (4, "de", ""),
    (5, "xx", None),
    (6, "de", "zzz yyy"),
]


@pytest.mark.parametrize("bound", [enrich.IN_ROW_WORDS, 0])
def test_scores_in_the_row_and_by_join(spark, monkeypatch, bound):
    monkeypatch.setattr(enrich, "IN_ROW_WORDS", bound)
    docs = spark.createDataFrame(DOCS, "doc_id int, lang string, text string")
    profiles = spark.createDataFrame([("en", "the"), ("en", "of"), ("de", "der"), ("de", "und"), ("aa", "zzz"), ("bb", "zzz")], "lang string, word string")
    got = {r["doc_id"]: (r["language"], r["language_score"]) for r in enrich.language_score(docs, profiles).collect()}
    assert got == {1: ("en", 0.4), 2: ("en", 1.0), 3: ("de", 4 / 7), 4: (None, 0.0), 5: (None, 0.0), 6: ("aa", 0.5)}
    none = enrich.language_score(docs, profiles.limit(0)).select("language_score").distinct().collect()
    assert [r[0] for r in none] == [0.0]


def test_increments_equal_one_run(spark, tmp_path):
    rows = [(i, "\n".join([f"line {i % 3}", "Common ", f"own {i}", "", "common"])) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id int, raw_content string")
    whole = sorted(map(tuple, enrich.dedup_paragraphs(docs).collect()))
    state, got = str(tmp_path / "state"), []
    for n, (a, b) in enumerate([(0, 5), (5, 6), (6, 6), (6, 12)]):
        part = docs.where((F.col("doc_id") >= a) & (F.col("doc_id") < b))
        first = sorted(map(tuple, enrich.dedup_increment(part, state, f"{n}").collect()))
        again = sorted(map(tuple, enrich.dedup_increment(part, state, f"{n}").collect()))
        assert first == again
        got += first
    assert sorted(got) == whole


def test_unigram_perplexity_of_frequent_and_rare_words(spark, monkeypatch):
    rows = [(1, "en", "a a a a b c"), (2, "en", "a a b"), (3, "de", "a x"), (4, "en", " "), (5, None, "a"), (None, "en", "z c"), (2, "en", "a q")]
    docs = spark.createDataFrame(rows, "doc_id int, lang string, text string")
    counts = Counter((lang, w) for _, lang, t in rows if lang for w in t.split())
    size = {lang: sum(c + 1 for (by, _), c in counts.items() if by == lang) for lang in ("en", "de")}
    logs = defaultdict(list)
    for i, lang, t in rows:
        if lang:
            logs[i] += [math.log((counts[lang, w] + 1) / size[lang]) for w in t.split()]
    want = {i: math.exp(-sum(x) / len(x)) for i, x in logs.items() if x}
    for bound in (0, 2, 100):
        monkeypatch.setattr(enrich, "BROADCAST_WORDS", bound)
        got = enrich.unigram_perplexity(docs).collect()
        assert {r[0]: pytest.approx(r[1], rel=1e-9) for r in got} == want and len(got) == len(want)
