import random

import pytest

from gristmill.llm import decontaminate as d
from gristmill.llm import queries

SMALL = "/root/testdata/sf0.01"


def test_query_finds_what_a_plain_search_finds(spark):
    items = [(r["item_id"], d.normal(r["text"])) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    want = {(r["doc_id"], i) for r in docs for i, t in items if t in d.normal(r["text"] or "")}
    rows = queries.op6_decontamination(spark, SMALL).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows if r["distance"] == 0} == want and want
    texts = {r["doc_id"]: d.normal(r["text"] or "") for r in docs}
    for r in rows:
        item = dict(items)[r["item_id"]]
        assert r["distance"] <= d.RATE * len(item)
        assert edit(item, texts[r["doc_id"]][r["start"] : r["end"]]) == r["distance"]


def edit(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best(a, text):
    """Least distance of ``a`` to any part of a text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_every_item_within_the_budget_is_found():
    rng = random.Random(3)
    some = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    items = [(i, "x" + some(rng.randrange(30, 90)) + "y") for i in range(12)]
    finder = d.Finder(items, 0.1)
    for trial in range(150):
        n = rng.randrange(len(items))
        chars = list(d.normal(items[n][1]))
        for _ in range(rng.randrange(int(0.13 * len(chars)) + 1)):
            at = rng.randrange(len(chars))
            chars[at : at + 1] = rng.choice(([], ["q"], [chars[at], "z"]))
        text = d.normal(some(80) + "".join(chars) + some(80))
        got = {m[0]: m for m in finder.find(text)}
        for name, item in finder.items:
            least = best(item, text)
            assert (name in got) == (least <= int(0.1 * len(item))), trial
            if name in got:
                assert got[name][1] == least == edit(item, text[got[name][2] : got[name][3]])


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_odd_rows(spark, block):
    items = spark.createDataFrame(
        [(1, "The quick brown fox jumps over the lazy dog tonight"), (2, None), (3, " "), (4, "tiny"), (5, "tiny"), (None, "another item of the benchmark, long enough to edit")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [(1, "so THE quick brown\n fox jumps over the lazy dog   tonight, yes", "k"), (2, None, "k"), (3, "", "k"), (4, "a tiny house, untinyness", "k"), (5, "w " * 50_000 + "the quick brwn fox jumps over the lazzy dog tonight", "k"), (None, "another item of the benchmark, long enough to edit", None), (6, "clean", "k"), (6, "clean", "k")],
        "doc_id long, text string, item_id string",
    )
    rows = d.contaminated(docs, items, block_chars=block).collect()
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in rows), key=str)
    assert got == sorted([(1, 1, 0), (4, 4, 0), (4, 5, 0), (5, 1, 2), (None, None, 0)], key=str)
    kept = d.clean(docs, items, block_chars=block)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 6, 6]
    assert d.clean(docs, items.limit(0)).count() == 8 and d.contaminated(docs.limit(0), items).count() == 0


@pytest.mark.parametrize("block", [2_000_000, 60])
def test_ids_of_any_type(spark, block):
    items = spark.createDataFrame([("a1", "the quick brown fox jumps over it"), ("b", "another item of the benchmark")], "item_id string, text string")
    docs = spark.createDataFrame([("x", "So the quick brown fox jumps over it all"), ("y", "clean")], "doc_id string, text string")
    rows = d.contaminated(docs, items, block_chars=block)
    assert dict(rows.dtypes)["item_id"] == "string"
    assert [(r["doc_id"], r["item_id"]) for r in rows.collect()] == [("x", "a1")]
    assert [r["doc_id"] for r in d.clean(docs, items, block_chars=block).collect()] == ["y"]


def test_a_plan_holds_one_block(spark):
    items = spark.createDataFrame([(i, f"item number {i} of the benchmark with some words") for i in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"see item number {i} of the benchmark with some words here") for i in range(30)], "doc_id long, text string")
    rows = d.contaminated(docs, items, block_chars=200)
    assert {(r["doc_id"], r["item_id"]) for r in rows.collect() if r["distance"] == 0} >= {(i, i) for i in range(30)}
    plan = d.clean(docs, items, block_chars=200)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
