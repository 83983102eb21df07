import pytest
from pyspark.sql import functions as F

from gristmill.operators.passage import BULLETS, PassageRules, keep_passages, tag_passages
from gristmill.operators.reasons import first_reason, funnel

LONG = "x" * 100


def text_of(paragraphs):
    return "\n".join(paragraphs)


def base(n=6, width=100):
    return [f"{'word ' * (width // 5)}" for _ in range(n)]


CASES = {
    "511 characters": ("x" * 511, "short_text"),
    "512 characters in one paragraph": ("x" * 512, "few_paragraphs"),
    "5 paragraphs": (text_of(base(5, 200)), "few_paragraphs"),
    "6 paragraphs": (text_of(base(6)), None),
    "5 paragraphs and blank ones": (text_of(base(5, 200) + ["", "  ", "　", "\t"]), "few_paragraphs"),
    "short share exactly 0.5": (text_of(base(4, 200) + ["short"] * 4), None),
    "short share above 0.5": (text_of(base(4, 200) + ["short"] * 5), "short_paragraphs"),
    "15 characters are short": (text_of(base(3, 250) + ["x" * 15] * 4), "short_paragraphs"),
    "16 characters are not": (text_of(base(3, 250) + ["x" * 16] * 4), None),
    "blanks count for the length": (text_of(base(3, 250) + [" " * 8 + "x" * 8] * 4), None),
    "lexicon, case folded": (text_of(base(6) + ["Some BADWORDS inside a longer paragraph"]), "lexicon"),
    "bullet share exactly 0.9": (text_of(["- " + LONG] * 9 + [LONG]), None),
    "bullet share above 0.9": (text_of([" 　- " + LONG] * 10), "bullets"),
    "ellipsis share exactly 0.3": (text_of([LONG + "..."] * 3 + [LONG] * 7), None),
    "ellipsis share above 0.3": (text_of([LONG + "... "] * 2 + [LONG + "…"] * 2 + [LONG] * 6), "ellipses"),
    "hash share exactly 0.1": (text_of(["x" * 99] * 9 + ["#" * 100 + "x"])[:1000], None),
    "hash share above 0.1": (text_of(["x" * 99] * 9 + ["#" * 101])[:1001], "hash_signs"),
    "ellipsis sign share": (text_of([("x" * 8 + "…y") * 10 + "……x"] * 6), "ellipsis_signs"),
    "dot run share": (text_of(["x......y..." * 10 + "x"] * 6), "dot_runs"),
}


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(
        [(name, text, want) for name, (text, want) in CASES.items()],
        "name string, raw_content string, want string",
    )


@pytest.mark.parametrize("method", ["chain", "automaton"])
def test_first_reason_at_every_boundary(frame, method):
    rows = tag_passages(frame, words=["badword"], method=method).collect()
    assert {r["name"]: r["reason"] for r in rows} == {k: v[1] for k, v in CASES.items()}


@pytest.mark.parametrize("method", ["chain", "automaton"])
def test_survivors_are_the_rows_without_reason(frame, method):
    kept = keep_passages(frame, words=["badword"], method=method).collect()
    assert {r["name"] for r in kept} == {k for k, v in CASES.items() if v[1] is None}


def test_rows_outside_the_condition_pass(frame):
    only = F.col("name").startswith("5")
    kept = {r["name"] for r in keep_passages(frame, words=["badword"], only=only).collect()}
    assert kept == {k for k in CASES if not k.startswith("5")}


@pytest.mark.parametrize("bullet", BULLETS)
def test_bullet_characters(spark, bullet):
    df = spark.createDataFrame([(text_of([bullet + LONG] * 6),)], "raw_content string")
    assert tag_passages(df).first()["reason"] == "bullets"


def test_funnel_counts_every_row_once(frame):
    counts = {r["reason"]: r["n"] for r in funnel(tag_passages(frame, words=["badword"])).collect()}
    assert sum(counts.values()) == len(CASES)
    assert counts["kept"] == sum(v[1] is None for v in CASES.values())


def test_thresholds_are_parameters(spark):
    df = spark.createDataFrame([("a b c",)], "raw_content string")
    loose = PassageRules(min_chars=0, few_paragraphs=0, max_short_share=1.0)
    assert tag_passages(df, rules=loose).first()["reason"] is None


def test_custom_rule_list(spark):
    df = spark.createDataFrame([(1,), (5,), (None,)], "n int")
    reason = first_reason([("low", F.col("n") < 2), ("odd", F.col("n") % 2 == 1)])
    assert [r[0] for r in df.select(reason).collect()] == ["low", "odd", None]
    assert df.select(first_reason([])).first()[0] is None
