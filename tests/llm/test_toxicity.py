import numpy as np

from gristmill.llm import queries, toxicity

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    rows = queries.op10_toxicity(spark, SMALL).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    graded = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["doc_id"] in labels]
    assert np.mean([p == y for p, y in graded]) > 0.85


def test_held_out_precision_and_recall(spark):
    """Of labelled documents no fit may learn from; a constant finds none, or marks most wrongly."""
    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in queries.op10_toxicity(spark, sf_dir).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    right = sum(r["predicted"] and labels[r["doc_id"]] for r in rows)
    marked, toxic = sum(r["predicted"] for r in rows), sum(labels[r["doc_id"]] for r in rows)
    assert len(rows) > 500 and toxic > 50
    assert right / marked > 0.75 and right / toxic > 0.5


def test_savings_match_plain_compression():
    shared = toxicity.compressor(b"the quiet river runs past the old mill " * 20)
    other = toxicity.compressor(b"snorfle blargh zworble " * 20)
    texts = [toxicity.plain(t) for t in ("", "a", "snorfle the quiet river blargh", "x " * 40 + "zworble " * 30, "é" * 50)]
    got = toxicity.savings(other, shared, texts)
    for text, saved in zip(texts, got, strict=True):
        starts = range(0, max(1, len(text) - toxicity.WINDOW + toxicity.STRIDE), toxicity.STRIDE)
        windows = [text[i : i + toxicity.WINDOW] for i in starts]
        assert saved.tolist() == [len(shared.compress(w)) - len(other.compress(w)) for w in windows]


def test_ties_and_copies_score_alike(spark):
    docs = frame(spark, [(1, "same words here", "a"), (2, "same words here", "b"), (3, " same words here ", "c")])
    model = toxicity.Model(b"same words", b"other text", np.zeros(7), np.ones(7), np.array([0.1] * 7 + [0.0]))
    scores = [r["s"] for r in docs.select(model.score(docs.text).alias("s")).collect()]
    assert scores[0] == scores[1]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, score string")


def test_separates_planted_words(spark):
    clean = [(i, f"the quiet river number {i} runs past the old mill and the garden {i * 7}", "x") for i in range(600)]
    rude = [(i, f"the quiet river {i} blargh runs past snorfle the old mill {i * 3} zworble", "x") for i in range(600, 900)]
    docs = frame(spark, clean + rude)
    labels = spark.createDataFrame([(i, int(i >= 600)) for i in range(900)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["s"] for r in docs.select("doc_id", model.score(docs.text).alias("s")).collect()}
    right = [(got[i] >= 0.5) == (i >= 600) for i in range(900)]
    assert np.mean(right) > 0.97


def test_edge_cases(spark):
    odd = frame(spark, [(1, None, "x"), (None, "", "x"), (2, "word " * 60_000, None), (2, "same", None), (2, "same", None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(odd, none)
    assert [r["s"] for r in odd.select(model.score(odd.text).alias("s")).collect()] == [0.0] * 5
    only = spark.createDataFrame([(1, 1), (2, 1), (None, 0), (3, None)], "doc_id long, toxic int")
    assert toxicity.fit(odd, only).constant in (0.0, 1.0)
    rows = [(i, f"plain words {i} here", "x") for i in range(60)] + [(i, f"grumblex {i} here", "x") for i in range(60, 120)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i >= 60)) for i in range(120)] + [(0, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    scores = [r["s"] for r in odd.select(model.score(odd.text).alias("s")).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores) and scores[3] == scores[4]
    assert odd.limit(0).select(model.score(odd.text)).collect() == []


def test_typical_words_are_not_cut():
    plain = [toxicity.plain(f"the quiet river number {i} runs past the old mill {i * 7}") for i in range(2000)]
    # Each of 400 words is in 15 texts of 1,500, which is 1 %, and one word has three letters.
    rude = [
        toxicity.plain(f"the river {i} " + " ".join(f"{'abcdefghijklmnopqrst'[k // 20]}zworp{'abcdefghijklmnopqrst'[k % 20]}" for k in range(i % 100, 400, 100)) + (" zek" if i % 40 == 0 else ""))
        for i in range(1500)
    ]
    words = toxicity.typical_words(rude, plain)
    assert len(words) > 390 and b"zek" in words and b"river" not in words
