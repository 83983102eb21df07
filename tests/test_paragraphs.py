import pytest
from pyspark.sql import functions as F

from gristmill.operators.paragraphs import (
    END_MARKS,
    clean_documents,
    clean_text,
    explode_paragraphs,
    paragraph_reason,
)

OK = "Four words are enough."

CASES = {
    "": "no_end_mark",
    "   ": "no_end_mark",
    "no end mark at all here": "no_end_mark",
    "a comma ends this line,": "no_end_mark",
    "one two three .": "short",
    "one two three .": "short",
    " one two three. ": "short",
    "one two three 4.": None,
    "three wordsss only.": "few_words",
    "three　wordsss only.": "few_words",
    "four\xa0words\x1care　enough.": None,
    "a b c d e f g h i j k.": "word_length",
    "abc def ghi jkl mno.": None,
    "ab cde fgh ijk lmno.": None,
    "ab cde fgh ijk lmn.": None,
    "ab cde fg ijk lmn.": "word_length",
    "abcdefghij abcdefghij abcdefghij abcdefghi.": None,
    "abcdefghij abcdefghij abcdefghij abcdefghij.": "word_length",
    "double  blanks   between words.": None,
    "ends with a blank. \t": None,
    "only� � � three words.": "few_words",
    "不分词的文字一整段也没有空格。": "short",
    "不分词的文字一整段也没有空格所以只算一个词。": "few_words",
}


def test_reasons_at_every_boundary(spark):
    df = spark.createDataFrame([(k,) for k in CASES], "p string")
    rows = df.select("p", paragraph_reason(F.col("p")).alias("reason")).collect()
    assert {r["p"]: r["reason"] for r in rows} == CASES


def clean(spark, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(clean_text(F.col("t")).alias("c")).first()["c"]


@pytest.mark.parametrize("mark", END_MARKS)
def test_end_marks(spark, mark):
    text = "Some words before the mark" + mark
    assert clean(spark, text) == text + "\n"


def test_characters(spark):
    text = "tab\there \x00and\x7f wide blanks　stay �\xa0separate."
    assert clean(spark, text) == "tabhere and wide blanks stay \xa0separate.\n"
    assert clean(spark, "") == ""


def test_paragraph_order_and_line_feeds(spark):
    text = f"{OK}\n\nbad\n  {OK}\n"
    assert clean(spark, text) == f"{OK}\n  {OK}\n"


def test_documents_need_four_paragraphs(spark):
    rows = [(1, "\n".join([OK] * 3)), (2, "\n".join([OK] * 4)), (3, None), (4, "")]
    df = spark.createDataFrame(rows, "id int, raw_content string")
    got = {r["id"]: (r["n_kept"], r["raw_content"]) for r in clean_documents(df).collect()}
    assert got == {2: (4, f"{OK}\n" * 4)}


def test_rows_outside_the_condition_pass(spark):
    df = spark.createDataFrame([(1, "x"), (2, "x")], "id int, raw_content string")
    got = clean_documents(df, only=F.col("id") == 1).collect()
    assert [(r["id"], r["n_kept"], r["raw_content"]) for r in got] == [(2, 0, "")]


def test_cleaning_is_idempotent_on_fixtures(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    once = clean_documents(docs, "text").drop("n_kept")
    twice = clean_documents(once, "text").drop("n_kept")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_exploded_paragraphs_cover_the_text(spark):
    df = spark.createDataFrame([(1, f"{OK}\n\nno")], "id int, raw_content string")
    rows = explode_paragraphs(df).orderBy("pos").collect()
    assert [(r["pos"], r["reason"]) for r in rows] == [(0, None), (1, "no_end_mark"), (2, "no_end_mark")]
