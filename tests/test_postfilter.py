import json

import pytest
from pyspark.sql import functions as F

from gristmill.operators.postfilter import (
    ENRICHED_SCHEMA,
    PostRules,
    corpus_rows,
    keep_post,
    tag_post,
)
from gristmill.operators.reasons import funnel
from gristmill.plans.post import run_post
from gristmill.sources.corpus import read_corpus
from gristmill.sources.enriched import read_enriched

# 500 characters, 100 words, all distinct; 401 visible ones.
TEXT = " ".join(f"w{i:03d}" for i in range(100)) + "."
GOOD = dict(
    title="t",
    raw_content=TEXT,
    length=500,
    nlines=3,
    language="en",
    language_score=0.6,
    original_nlines=15,
    perplexity=1000.0,
    original_length=900,
)
REPEATED = "ab " * 200

CASES = {
    "all at the limit": ({}, None),
    "perplexity above, text short": (dict(perplexity=1000.5, length=499), "perplexity"),
    "perplexity above, text long": (dict(perplexity=1000.5), None),
    "perplexity at the limit, text short": (dict(length=499), None),
    "perplexity not a number": (dict(perplexity=float("nan"), length=499), None),
    "two lines": (dict(nlines=2), "few_lines"),
    "no lines": (dict(nlines=0), "few_lines"),
    "line ratio 5": (dict(original_nlines=15), None),
    "line ratio above 5": (dict(original_nlines=16), "line_loss"),
    "score below": (dict(language_score=0.599), "language_score"),
    "length 255": (dict(length=255, perplexity=1.0), "short_text"),
    "length 256": (dict(length=256, perplexity=1.0), None),
    "ink share 0.8": (dict(raw_content=TEXT, length=501), None),
    "ink share below": (dict(raw_content=TEXT, length=502), "low_ink"),
    "wide blanks are no ink": (dict(raw_content=TEXT.replace(" ", "　"), length=502), "low_ink"),
    "repetition": (dict(raw_content=REPEATED), "repetitive"),
    "repetition 2.5": (dict(raw_content="x" * 400 + " " * 600), None),
    "repetition above": (dict(raw_content="x" * 400 + " " * 601), "repetitive"),
    "no words": (dict(raw_content="   ", length=300), "low_ink"),
}
for field in ENRICHED_SCHEMA.names:
    CASES[f"no {field}"] = ({field: None}, "missing_field")


@pytest.fixture(scope="module")
def frame(spark):
    rows = [tuple({**GOOD, **c}[f] for f in ENRICHED_SCHEMA.names) for c, _ in CASES.values()]
    names = list(CASES)
    df = spark.createDataFrame(
        [(n, *r) for n, r in zip(names, rows, strict=True)],
        "name string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ENRICHED_SCHEMA),
    )
    return df


def test_visible_characters_of_the_sample():
    assert len(TEXT) == 500 and sum(map(len, TEXT.split())) == 401


def test_first_reason_at_every_boundary(frame):
    got = {r["name"]: r["reason"] for r in tag_post(frame).collect()}
    assert got == {name: want for name, (_, want) in CASES.items()}


def test_kept_rows_and_funnel(frame):
    kept = {r["name"] for r in keep_post(frame).collect()}
    assert kept == {n for n, (_, want) in CASES.items() if want is None}
    counts = {r["reason"]: r["n"] for r in funnel(tag_post(frame)).collect()}
    assert sum(counts.values()) == len(CASES)
    assert counts["missing_field"] == 9


def test_strict_mode_ends_the_job(frame):
    with pytest.raises(Exception, match="without a required field"):
        tag_post(frame, strict=True).collect()
    assert tag_post(frame.where("reverse(name) = 'timil eht ta lla'"), strict=True).count() == 1


def test_thresholds_are_parameters(frame):
    rules = PostRules(min_nlines=4)
    row = tag_post(frame.where("name = 'all at the limit'"), rules).first()
    assert row["reason"] == "few_lines"


def test_projection(frame):
    df = frame.where("name = 'all at the limit'").withColumn("raw_content", F.lit("﻿a﻿b"))
    assert corpus_rows(df).collect() == [("CommonCrawl", "ab", "en")]


def write_lines(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def test_result_files_to_corpus(spark, tmp_path):
    data, out = tmp_path / "data", str(tmp_path / "out")
    bad = {**GOOD, "nlines": 1}
    write_lines(data / "res" / "cut-1" / "s" / "a.wet", [GOOD, bad])
    write_lines(data / "res" / "cut-2" / "s" / "a.wet", [GOOD])
    write_lines(data / "res" / "cut-2" / "s" / "none.wet", [bad])
    write_lines(data / "res" / "cut-2" / "hashes" / "b.wet", [GOOD])
    write_lines(data / "res" / "cut-2" / "s" / "c.json", [GOOD])
    write_lines(data / "other" / "cut-3" / "s" / "a.wet", [GOOD])
    assert read_enriched(spark, str(data)).select("cut", "file").distinct().count() == 3

    counts = run_post(spark, str(data), out, batch_files=2)
    assert (counts["kept"], counts["few_lines"]) == (2, 2)
    rows = read_corpus(spark, out).select("cut", "file", "source", "text", "language").collect()
    assert sorted((r["cut"], r["file"], r["source"], r["language"]) for r in rows) == [
        ("cut-1", "a.wet", "CommonCrawl", "en"),
        ("cut-2", "a.wet", "CommonCrawl", "en"),
    ]
    assert {r["text"] for r in rows} == {TEXT}

    # A second run takes what has no output yet, also inside a cut begun before.
    write_lines(data / "res" / "cut-2" / "s" / "new.wet", [GOOD])
    assert run_post(spark, str(data), out)["kept"] == 1
    assert read_corpus(spark, out).count() == 3


def test_a_malformed_line_ends_the_job(spark, tmp_path):
    path = tmp_path / "res" / "c" / "s" / "a.wet"
    write_lines(path, [GOOD])
    path.write_text(path.read_text() + "{not json\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|malformed"):
        read_enriched(spark, str(tmp_path)).collect()


def test_only_matching_paths_are_read(spark, tmp_path):
    for cut in ("a", "b"):
        write_lines(tmp_path / "res" / cut / "s" / "x.wet", [GOOD])
    plan = read_enriched(spark, str(tmp_path)).where("cut = 'a'")
    assert plan.count() == 1
