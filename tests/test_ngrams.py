import glob
import math
import random
import tempfile
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gristmill.functions.text import WHITESPACE
from gristmill.operators import ngrams

TEXTS = [
    (1, "en", "the cat sat on the mat the cat sat"),
    (2, "en", "The dog sat on the log"),
    (3, "en", "a cat and a dog and a cat"),
    (4, "de", "der hund und der hund"),
    (5, "de", "und"),
    (6, None, "nobody knows"),
    (7, "en", None),
    (8, "en", " \t\n"),
    (9, "en", "the cat sat on the mat the cat sat"),
]


class Plain:
    """The model in plain code, for one group."""

    def __init__(self, texts):
        self.c3 = Counter(t for text in texts for t in self.trigrams(text))
        self.c2 = Counter(t[1:] for t in self.c3)
        self.c1 = Counter(t[1:] for t in self.c2)
        self.d = [self.discount(c) for c in (self.c1, self.c2, self.c3)]

    @staticmethod
    def trigrams(text):
        ws = ["", "", *(text or "").lower().split()]
        return list(zip(ws, ws[1:], ws[2:]))

    @staticmethod
    def discount(counts):
        n1, n2 = (sum(c == n for c in counts.values()) for n in (1, 2))
        return n1 / (n1 + 2 * n2) if n1 + 2 * n2 else 0.0

    def p(self, u, v, w):
        total, types = sum(self.c1.values()), len(self.c1)
        p = (max(self.c1[(w,)] - self.d[0], 0) + self.d[0] * types / (types + 1)) / total
        for counts, gram, d in ((self.c2, (v, w), self.d[1]), (self.c3, (u, v, w), self.d[2])):
            after = [c for g, c in counts.items() if g[:-1] == gram[:-1]]
            if after:
                p = (max(counts[gram] - d, 0) + d * len(after) * p) / sum(after)
        return p

    def perplexity(self, text):
        ps = [math.log(self.p(*t)) for t in self.trigrams(text)]
        return math.exp(-sum(ps) / len(ps)) if ps else None


def by_group():
    texts = defaultdict(list)
    for _, lang, text in TEXTS:
        if lang:
            texts[lang].append(text)
    return {lang: Plain(ts) for lang, ts in texts.items()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id int, lang string, text string")


def check(got, rows, models):
    want = {i: models[lang].perplexity(t) for i, lang, t in rows if lang in models}
    want = {i: p for i, p in want.items() if p is not None}
    assert set(got) == set(want)
    for i, p in want.items():
        assert got[i] == pytest.approx(p, rel=1e-9)


def test_perplexity_matches_plain_code(spark):
    docs = frame(spark, TEXTS)
    got = ngrams.ngram_perplexity(docs, ngrams.fit_ngrams(docs)).collect()
    check({r["doc_id"]: r["perplexity"] for r in got}, TEXTS, by_group())


def test_unseen_words_contexts_and_groups(spark):
    others = [(1, "en", "the zebra sat on a zebra"), (2, "de", "der zug"), (3, "xx", "der hund"), (4, "en", "zebra")]
    model = ngrams.fit_ngrams(frame(spark, TEXTS))
    got = ngrams.ngram_perplexity(frame(spark, others), model).collect()
    check({r["doc_id"]: r["perplexity"] for r in got}, others, by_group())


def test_probabilities_sum_to_one(spark):
    model = ngrams.fit_ngrams(frame(spark, TEXTS))
    words = sorted({w for _, lang, t in TEXTS if lang == "en" for w in (t or "").lower().split()} | {"unseen"})
    contexts = [("", ""), ("the", "cat"), ("cat", "the"), ("unseen", "the"), ("x", "y")]
    needed = [("en", u, v, w) for u, v in contexts for w in words]
    rows = spark.createDataFrame(needed, "by string, u string, v string, w string")
    sums = ngrams.probabilities(rows, model).groupBy("u", "v").agg(F.sum("p").alias("s")).collect()
    assert len(sums) == len(contexts)
    assert all(r["s"] == pytest.approx(1.0, rel=1e-9) for r in sums)


def test_no_rows(spark):
    docs = frame(spark, TEXTS)
    empty = ngrams.fit_ngrams(docs.limit(0))
    assert ngrams.ngram_perplexity(docs, empty).collect() == []
    assert ngrams.ngram_perplexity(docs.limit(0), ngrams.fit_ngrams(docs)).collect() == []


def test_tables_and_shuffles_hold_no_words(spark, monkeypatch):
    staged = []
    keep = ngrams.stage
    monkeypatch.setattr(ngrams, "stage", lambda df, label: staged.append(df) or keep(df, label))
    docs = frame(spark, TEXTS)
    scored = ngrams.ngram_perplexity(docs, ngrams.fit_ngrams(docs))
    for table in staged:
        assert [c for c, kind in table.dtypes if kind == "string" and c != "by"] == []
    # Texts give rows once: nothing of a document is staged, and no trigram looked up twice.
    assert all("doc_id" not in table.columns for table in staged)
    assert scored._jdf.queryExecution().executedPlan().toString().count("Generate") <= 2


def test_broadcast_bound_of_words(spark, monkeypatch):
    monkeypatch.setattr(ngrams, "BROADCAST_WORDS", 3)
    docs = frame(spark, TEXTS)
    got = ngrams.ngram_perplexity(docs, ngrams.fit_ngrams(docs)).collect()
    check({r["doc_id"]: r["perplexity"] for r in got}, TEXTS, by_group())


def test_one_group_by_a_literal(spark):
    docs = frame(spark, TEXTS)
    model = ngrams.fit_ngrams(docs)
    scored = ngrams.ngram_perplexity(docs.withColumn("lang", F.lit("en")), model)
    assert "NestedLoop" not in scored._jdf.queryExecution().executedPlan().toString()
    rows = [(i, "en", t) for i, _, t in TEXTS]
    check({r["doc_id"]: r["perplexity"] for r in scored.collect()}, rows, by_group())


OTHERS = [
    (1, "en", "the zebra sat on a zebra the cat sat on a mat"),
    (2, "de", "der zug und der hund"),
    (3, "xx", "der hund"),
    (4, "en", "zebra"),
]


@pytest.mark.parametrize("known", [0, 3, 1000])
@pytest.mark.parametrize("text_bytes", [1, 8_000_000])
def test_many_cells_and_words_in_several(spark, monkeypatch, known, text_bytes):
    """Frequent words go to several cells, rare words are not known, tasks deal often."""
    monkeypatch.setattr(ngrams, "BROADCAST_WORDS", known)
    monkeypatch.setattr(ngrams, "CELL_TRIGRAMS", 4)
    monkeypatch.setattr(ngrams.cells, "CHUNK", text_bytes)
    docs = frame(spark, TEXTS)
    model = ngrams.fit_ngrams(docs)
    assert model.count > 4 and (model.contexts is not None) == (known > 0) and (model.words is None) == (known == 1000)
    for rows in (TEXTS, OTHERS):
        got = ngrams.ngram_perplexity(frame(spark, rows), model).collect()
        check({r["doc_id"]: r["perplexity"] for r in got}, rows, by_group())


def test_trigrams_are_shuffled_as_few_bytes(spark):
    """Neither rows for each trigram nor joins; a trigram of random words takes some bytes."""
    rng = random.Random(1)
    docs = frame(spark, [(i, "en", " ".join(f"w{int(rng.paretovariate(0.5)) % 5000}" for _ in range(400))) for i in range(200)])
    model = ngrams.fit_ngrams(docs)
    size = model.cells.agg(F.sum(F.length("model"))).first()[0]
    assert size < 8 * 80_000
    plan = ngrams.ngram_perplexity(docs, model)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_shuffles_end_with_the_fit(spark):
    def files():
        return {f for d in glob.glob(f"{root}/**/blockmgr-*", recursive=True) for f in glob.glob(f"{d}/**/shuffle_*", recursive=True)}

    root = spark.conf.get("spark.local.dir", None) or tempfile.gettempdir()
    setting = spark.conf.get(ngrams.CLEANUP)
    docs = frame(spark, TEXTS)
    before = files()
    ngrams.fit_ngrams(docs)
    assert not any(f.endswith(".data") for f in files() - before)
    assert spark.conf.get(ngrams.CLEANUP) == setting


def test_all_whitespace_parts_words(spark):
    rows = [(1, "en", "".join(f"{c}a{c}{c}b" for c in WHITESPACE)), (2, "en", " ".join(["a b"] * len(WHITESPACE)))]
    docs = frame(spark, rows)
    got = {r["doc_id"]: r["perplexity"] for r in ngrams.ngram_perplexity(docs, ngrams.fit_ngrams(docs)).collect()}
    check(got, rows, {"en": Plain([t for _, _, t in rows])})
    assert got[1] == pytest.approx(got[2], rel=1e-12)


def test_probabilities_of_zero_do_not_count(spark):
    """Where all trigrams come twice the discount is zero, and unseen ones after a seen context have no logarithm."""
    model = ngrams.fit_ngrams(frame(spark, [(i, "en", "a b c a b d") for i in range(2)]))
    plain = Plain(["a b c a b d"] * 2)
    assert plain.d[2] == 0
    rows = [(1, "en", "a b"), (2, "en", "a b b"), (3, "en", "d"), (4, "en", "a c")]
    got = {r["doc_id"]: r["perplexity"] for r in ngrams.ngram_perplexity(frame(spark, rows), model).collect()}
    assert plain.p("a", "b", "b") == 0 and plain.p("", "", "d") == 0
    assert set(got) == {1, 2, 3, 4} and got[3] is None
    for i, _, text in rows[:2] + rows[3:]:
        ps = [p for p in (plain.p(*t) for t in plain.trigrams(text)) if p > 0]
        assert got[i] == pytest.approx(math.exp(-sum(map(math.log, ps)) / len(ps)), rel=1e-9)


def test_keys_of_any_kind_repeated_or_null(spark):
    rows = [("x", "en", TEXTS[0][2]), ("x", "de", TEXTS[3][2]), (None, "en", TEXTS[1][2])]
    model = ngrams.fit_ngrams(frame(spark, TEXTS))
    docs = spark.createDataFrame(rows, "doc_id string, lang string, text string")
    got = {r["doc_id"]: r["perplexity"] for r in ngrams.ngram_perplexity(docs, model).collect()}
    plain = by_group()
    logs = [math.log(plain[g].p(*t)) for _, g, text in rows[:2] for t in plain[g].trigrams(text)]
    assert got["x"] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-9)
    assert got[None] == pytest.approx(plain["en"].perplexity(rows[2][2]), rel=1e-9)
