import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import lexicon as lex
from gristmill.operators import qgrams

ALPHABET = "abé😀ß "


def random_text(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


@pytest.fixture(scope="module")
def sample():
    rng = random.Random(7)
    words = sorted({random_text(rng, rng.randint(1, 6)).strip() for _ in range(60)} - {""})
    texts = [(i, random_text(rng, rng.randint(0, 40))) for i in range(80)]
    texts += [(80, None), (81, "ab" * 9_000 + "ßß😀"), (82, "")]
    return words, texts


@pytest.fixture(scope="module")
def frames(spark, sample):
    words, texts = sample
    return (
        spark.createDataFrame([(w,) for w in words], "word string"),
        spark.createDataFrame(texts, "id int, text string"),
    )


def expected_pairs(words, texts):
    return {(i, w) for i, t in texts if t for w in words if w in t}


def test_all_forms_find_the_same_pairs(frames, sample):
    listed, docs = frames
    want = expected_pairs(*sample)
    small = lex.lexicon_pairs(docs, "id", "text", listed)
    beyond = lex.lexicon_pairs(docs, "id", "text", listed, max_entries=3)
    tiny_parts = lex.substring_pairs(docs.where("text is not null"), "id", "text", listed, 10, 3)
    for pairs in (small, beyond, tiny_parts):
        rows = [(r["id"], r["word"]) for r in pairs.collect()]
        assert len(rows) == len(set(rows))
        assert set(rows) == want


def index_pairs(index, docs):
    rows = [(r["id"], r["word"]) for r in index.pairs(docs, "id", "text").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("q, bits", [(8, qgrams.BITMAP_BITS), (2, qgrams.ROW_BITS), (1, qgrams.ROW_BITS), (3, 2 * qgrams.ROW_BITS)])
def test_index_finds_the_same_pairs(frames, sample, q, bits):
    listed, docs = frames
    assert index_pairs(qgrams.GramIndex.of(listed, q, bits), docs) == expected_pairs(*sample)


def test_index_of_long_and_alike_entries(spark):
    words = ["x" * n for n in range(1, 40)] + ["prefix " + "y" * n for n in range(30)] + ["z" * 3000, "😀" * 20, "a"]
    texts = [(0, "x" * 50), (1, "a prefix yyyyy!"), (2, "z" * 3001), (3, "😀" * 19), (4, "b" + "😀" * 20), (5, None), (6, "")]
    listed = spark.createDataFrame([(w,) for w in words + ["", None]], "word string")
    docs = spark.createDataFrame(texts, "id int, text string")
    assert index_pairs(qgrams.GramIndex.of(listed), docs) == expected_pairs(set(words), texts)
    empty = qgrams.GramIndex.of(listed.limit(0))
    assert index_pairs(empty, docs) == set()
    assert qgrams.with_hit(docs, F.col("text"), empty).where("_hit").count() == 0


def test_a_long_list_takes_one_python_node_and_rows_linear_in_characters(frames, sample):
    listed, docs = frames
    flagged = lex.flag_hits(docs, F.col("text"), listed, max_entries=6)  # ten shards
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 1 and "CartesianProduct" not in plan and "NestedLoop" not in plan
    hit = {i for i, _ in expected_pairs(*sample)}
    assert {r["id"]: r["_hit"] for r in flagged.collect()} == {i: i in hit for i, _ in sample[1]}
    index = qgrams.GramIndex.of(listed)
    chars = sum(len(t or "") for _, t in sample[1])
    assert docs.select(F.explode(index.places(F.col("text")))).count() <= index.q * chars
    entries = index.words.select(F.sum(F.length("word")).alias("n")).first()["n"]
    assert index.words.select(F.explode(index.places(F.col("word")))).count() <= index.q * entries


@pytest.mark.parametrize("limit", [lex.BROADCAST_ENTRIES, 3])
def test_texts_with_a_hit_are_dropped(frames, sample, limit):
    listed, docs = frames
    kept = {r["id"] for r in lex.drop_hits(docs, "text", listed, max_entries=limit).collect()}
    hit = {i for i, _ in expected_pairs(*sample)}
    assert kept == {i for i, _ in sample[1]} - hit


@pytest.mark.parametrize("method", ["chain", "automaton", "auto"])
def test_hit_flags(frames, sample, method):
    words, texts = sample
    rows = frames[1].select("id", lex.lexicon_hit(F.col("text"), words, method).alias("hit")).collect()
    hit = {i for i, _ in expected_pairs(words, texts)}
    assert {r["id"]: r["hit"] for r in rows} == {i: i in hit for i, _ in texts}


def test_no_words_no_hits(frames):
    assert frames[1].where(lex.lexicon_hit(F.col("text"), [])).count() == 0
    with pytest.raises(ValueError):
        lex.lexicon_hit(F.col("text"), ["a"], "other")


def test_shards_hold_every_entry_within_the_bound(frames, sample):
    for given in (frames[0], sample[0]):
        shards = list(lex.word_shards(given, 7, 20))
        assert sorted(w for s in shards for w in s) == sample[0]
        assert len(shards) > 5 and all(len(s) <= 7 and sum(map(len, s)) <= 20 for s in shards)
    assert list(lex.word_shards([])) == [] == list(lex.word_shards(frames[0].limit(0)))


def test_a_missing_list_is_an_error(frames):
    for use in (lambda: lex.lexicon_hit(F.col("text"), None), lambda: lex.drop_hits(frames[1], "text", None)):
        with pytest.raises(TypeError):
            use()


@pytest.mark.parametrize("as_frame", [True, False])
def test_folded_list_gives_the_same_flags(frames, sample, as_frame):
    words, texts = sample
    given = frames[0] if as_frame else words
    rows = frames[1].select("id", lex.lexicon_hit(F.col("text"), given, max_entries=9).alias("hit")).collect()
    hit = {i for i, _ in expected_pairs(words, texts)}
    assert {r["id"]: r["hit"] for r in rows} == {i: i in hit for i, _ in texts}


def test_reduction_keeps_the_decision(frames, sample):
    words, texts = sample
    listed, _ = frames
    reduced = {r["word"] for r in lex.minimal_substrings(listed).collect()}
    assert reduced == {w for w in words if not any(v != w and v in w for v in words)}
    assert {i for i, _ in expected_pairs(words, texts)} == {
        i for i, _ in expected_pairs(reduced, texts)
    }


def test_shortest_listed(spark):
    listed = spark.createDataFrame([(w,) for w in ("ab", "xaby", "y", "abab", "q")], "word string")
    got = {r["word"]: r["shortest"] for r in lex.shortest_listed(listed).collect()}
    assert got == {"ab": "ab", "xaby": "y", "y": "y", "abab": "ab", "q": "q"}


def test_load_order_files(spark, tmp_path):
    for name, body in {"en": "one\n two \n\n", "zz": "last\n", "fr": "Un\n", "README.md": "no\n"}.items():
        (tmp_path / name).write_text(body)
    loaded = lex.with_load_order(lex.load_lexicon(spark, str(tmp_path)))
    rows = loaded.orderBy("lang_rank", "lang", "line_no").collect()
    assert [(r["lang"], r["lang_rank"], r["word"]) for r in rows] == [
        ("en", 1, "one"),
        ("en", 1, "two"),
        ("fr", 5, "Un"),
        ("zz", 12, "last"),
    ]
    kept = {r["word"] for r in lex.drop_unmatchable(loaded).collect()}
    assert kept == {"one", "two", "last"}
    assert {r["word"] for r in lex.with_literals(loaded).collect()} >= set(lex.LITERALS)
    assert lex.bounded_words(loaded) == ["Un", "one", "two", "last"]
    for bound in ({"max_entries": 3}, {"max_chars": 11}):
        with pytest.raises(ValueError):
            lex.bounded_words(loaded, **bound)


def test_missing_folder_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        lex.load_lexicon(spark, str(tmp_path / "none"))
