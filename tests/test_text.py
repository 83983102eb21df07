from pyspark.sql import functions as F

from gristmill.functions import paths, text as t
from gristmill.functions.html import first_link, inner_text, list_items


def one(spark, value, build):
    df = spark.createDataFrame([(value,)], "x string")
    return df.select(build(F.col("x")).alias("y")).first()["y"]


EDGES = ["", " ", "a", "\xa0a　b ", "\x1c\x1da b\x85", "  a  b\t\nc ", "​a", "é 😀 x", "a\rb"]


def test_whitespace_set_is_the_full_unicode_one():
    assert set(t.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(t.RARE_BLANKS + t.RARE_BLANKS_E280 + " \n") == set(t.WHITESPACE)


def test_strip_words_and_ink_on_every_whitespace_character(spark):
    values = EDGES + [f"{c}a{c}{c}bc{c}" for c in t.WHITESPACE]
    x = F.col("x")
    spaced = t.blanks_for_whitespace(x)
    rows = (
        spark.createDataFrame([(v,) for v in values], "x string")
        .select(
            "x",
            t.strip(x).alias("strip"),
            t.words(x).alias("words"),
            t.ink_length(x).alias("ink"),
            t.is_blank(x).alias("blank"),
            t.word_count(spaced, F.length(t.remove(spaced, " "))).alias("n"),
            t.second_word(x).alias("second"),
        )
        .collect()
    )
    for r in rows:
        words = r["x"].split()
        assert r["strip"] == r["x"].strip()
        assert r["words"] == words
        assert r["ink"] == sum(map(len, words))
        assert r["blank"] == (not r["x"].strip())
        assert r["n"] == len(words)
        assert r["second"] == (words[1] if len(words) > 1 else None)


def test_newlines_and_counts(spark):
    assert one(spark, "a\r\nb\rc\n\r\n", t.unix_newlines) == "a\nb\nc\n\n"
    assert one(spark, ".......", lambda c: t.count_token(c, "...")) == 2
    assert one(spark, "#a##", lambda c: t.count_token(c, "#")) == 3
    assert one(spark, "end. 　", lambda c: t.ends_with_any(c, ("!", "."))) is True
    assert one(spark, "end, ", lambda c: t.ends_with_any(c, ("!", "."))) is False
    assert one(spark, "", lambda c: t.ends_with_any(c, ("!", "."))) is False
    assert one(spark, "abc", lambda c: t.holds_any(c, ["x", "bc"])) is True
    assert one(spark, "abc", lambda c: t.holds_any(c, [])) is False


def test_netloc_keeps_user_port_and_case(spark):
    cases = {
        "http://User@Example.COM:8080/a?b": "User@Example.COM:8080",
        "https://a_b.example/x y|z": "a_b.example",
        "//host/x": "host",
        "http://host?q": "host",
        "http://host#f": "host",
        "no url": "",
        "mailto:a@b": "",
    }
    for url, want in cases.items():
        assert one(spark, url, paths.netloc) == want


def test_paths(spark):
    path = "base/CC-MAIN-2023-06/wet.paths.gz"
    assert one(spark, path, paths.local_name) == "CC-MAIN-2023-06_wet.paths.gz"
    assert one(spark, "d/res/cut/0001/en.wet", paths.cut_of) == "cut"
    assert one(spark, "en.wet", paths.cut_of) is None
    assert one(spark, "a/zig.gz", lambda c: paths.without_gz(paths.base_name(c))) == "zig"


def test_html_items(spark):
    html = "<ul><LI class=x><a href='#'>One &amp; <b>two</b></a> x</LI><li>three\nfour</li><link></ul>"
    items = one(spark, html, list_items)
    assert items == ["<a href='#'>One &amp; <b>two</b></a> x", "three\nfour"]
    assert one(spark, items[0], inner_text) == "One & two x"
    assert one(spark, items[0], lambda c: inner_text(first_link(c))) == "One & two"
    assert one(spark, items[1], first_link) == ""


def test_html_items_nested_open_and_numeric(spark):
    html = "<ul><li>a<ul><li>b</li><LI k=1>c</ul><li>d &#233;&#x20ac;&#128512;&#0;&#xD800;&amp;#65;</ul> tail"
    items = one(spark, html, list_items)
    assert items == ["a<ul>", "b", "c", "d &#233;&#x20ac;&#128512;&#0;&#xD800;&amp;#65;"]
    assert one(spark, items[3], inner_text) == "d é€😀&#0;&#xD800;&#65;"
    assert one(spark, "no items", list_items) == []
