import public_tokenizers
import pytest
import tiktoken

from gristmill.llm import attribution, bpe, queries

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.COUNT_RANKS)


@pytest.fixture(scope="module")
def plain():
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(PATH))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder(spark):
    return attribution.Encoder(spark, PATH, public_tokenizers.PATTERN)


def spans(plain, text):
    """Characters each token touches, byte by byte."""
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    found, at = [], 0
    for t in plain.encode_ordinary(text):
        n = len(plain.decode_single_token_bytes(t))
        found.append((owner[at], owner[at + n - 1] + 1))
        at += n
    return found


def brute(plain, text, sections, rule):
    count = [0.0] * len(sections)
    for a, b in spans(plain, text):
        common = [max(0, min(b, e) - max(a, s)) for s, e in sections]
        if rule == "start":
            common = [float(s <= a < e) for s, e in sections]
        if rule == "share":
            count = [n + c / (b - a) for n, c in zip(count, common, strict=True)]
        elif any(common):
            count[common.index(max(common))] += 1
    return count


def lines(text):
    at, found = 0, []
    for line in text.split("\n"):
        found.append((at, min(len(text), at + len(line) + 1)))
        at += len(line) + 1
    return [f for f in found if f[0] < f[1]]


TEXTS = ["one line", "two\nlines here\n", "\n\n\nmany\n\n", "ünïcödé 😀😀\n東京\n", "x" * 3000 + "\n" + "y z " * 3000, "same\ntext", "same\ntext", "", None]


@pytest.mark.parametrize("rule", attribution.RULES)
def test_lines(spark, encoder, plain, rule):
    docs = spark.createDataFrame([(i, t, "k") for i, t in enumerate(TEXTS)] + [(None, "no key", "k")], "doc_id long, text string, section string")
    rows = attribution.section_counts(docs, encoder, rule=rule).collect()
    for i, text in [*enumerate(TEXTS), (None, "no key")]:
        got = sorted((r["section"], r["start"], r["end"], r["tokens"]) for r in rows if r["doc_id"] == i)
        cuts = lines(text or "")
        want = brute(plain, text or "", cuts, rule)
        assert [g[1:3] for g in got] == cuts
        assert [g[3] for g in got] == pytest.approx(want)
        assert sum(want) == pytest.approx(len(plain.encode_ordinary(text or "")))


@pytest.mark.parametrize("rule", attribution.RULES)
def test_given_sections_may_leave_gaps(spark, encoder, plain, rule):
    text, cuts = "Thestationing of überraschungen, wherever they may be 12345678", [(2, 5), (5, 9), (14, 14), (15, 22), (30, 61)]
    given = spark.createDataFrame([(1, text, cuts), (2, None, cuts), (3, text, None), (4, text, [])], "doc_id long, text string, parts array<struct<start:int,end:int>>")
    rows = attribution.section_counts(given, encoder, sections="parts", rule=rule).collect()
    got = [r["tokens"] for r in sorted((r for r in rows if r["doc_id"] == 1), key=lambda r: r["section"])]
    assert got == pytest.approx(brute(plain, text, cuts, rule))
    assert [r["tokens"] for r in rows if r["doc_id"] == 2] == [0] * 5
    assert not [r for r in rows if r["doc_id"] in (3, 4)]


def test_query_adds_up(spark, plain):
    total = {}
    for r in queries.op9_token_counts(spark, SMALL).collect():
        total[r["doc_id"]] = total.get(r["doc_id"], 0) + r["n_tokens"]
    for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect():
        assert total.get(r["doc_id"], 0) == len(plain.encode_ordinary(r["text"] or ""))


def test_empty_table_and_unknown_rule(spark, encoder):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert attribution.section_counts(docs, encoder).collect() == []
    with pytest.raises(ValueError):
        attribution.section_counts(docs, encoder, rule="none")
