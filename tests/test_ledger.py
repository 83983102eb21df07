import os

import pytest

from gristmill.sources import ledger
from gristmill.sources.corpus import read_corpus, write_corpus


def names(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "path string")


def paths(spark, out):
    return sorted(r["path"] for r in ledger.landed(spark, out).collect())


def test_entries_have_versions_and_are_compacted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "COMPACT_EVERY", 3)
    out = str(tmp_path / "out")
    assert paths(spark, out) == [] == ledger.versions(spark, out)
    for i in range(10):
        assert ledger.mark_landed(names(spark, f"n{i}", "same"), out, f"c-{i % 4}") == i + 1
        assert paths(spark, out) == sorted(["same", *[f"n{j}" for j in range(i + 1)]])
        entries = ledger.versions(spark, out)
        # One base and fewer than three commits are read, and little else is kept.
        assert len(ledger.live(entries)) <= 3 and len(entries) <= 8
    assert sorted(r["commit"] for r in ledger.commits(spark, out).collect()) == [f"c-{i}" for i in range(4)]
    assert any(kind == "base" for _, kind in entries)


def test_a_commit_that_was_not_renamed_counts_for_nothing(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    ledger.mark_landed(names(spark, "a"), out)
    aside = tmp_path / "out" / "_landed" / "_half"
    names(spark, "b").write.json(str(aside))
    assert paths(spark, out) == ["a"]
    assert ledger.mark_landed(names(spark, "c"), out) == 2
    assert paths(spark, out) == ["a", "c"]


def test_a_version_that_is_taken(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    ledger.mark_landed(names(spark, "a"), out)
    first, seen = ledger.versions, []

    def late(spark, out):
        # The first look misses what another writer has entered in the meantime.
        seen.append(1)
        return [] if len(seen) == 1 else first(spark, out)

    monkeypatch.setattr(ledger, "versions", late)
    assert ledger.mark_landed(names(spark, "b"), out) == 2
    monkeypatch.setattr(ledger, "versions", lambda spark, out: [])
    with pytest.raises(RuntimeError):
        ledger.mark_landed(names(spark, "c"), out)
    monkeypatch.setattr(ledger, "versions", first)
    assert paths(spark, out) == ["a", "b"]


def corpus_rows(spark, *rows):
    return spark.createDataFrame(rows, "source string, text string, language string, file string, cut string")


def test_only_complete_commits_are_read(spark, tmp_path):
    out = str(tmp_path / "out")
    write_corpus(corpus_rows(spark, ("s", "left", "en", "a", "x")), out, commit="c-0")
    assert read_corpus(spark, out).count() == 0
    write_corpus(corpus_rows(spark, ("s", "t1", "en", "a", "x"), ("s", "t2", "de", "b", "y")), out, commit="c-1")
    ledger.mark_landed(names(spark, "x/a", "y/b"), out, "c-1")
    rows = read_corpus(spark, out).select("cut", "file", "text").collect()
    assert sorted(map(tuple, rows)) == [("x", "a", "t1"), ("y", "b", "t2")]


def test_files_grow_with_commits_not_with_inputs(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [("s", f"t{i}", "en", f"file{i}", "x") for i in range(200)]
    write_corpus(corpus_rows(spark, *rows).coalesce(2), out, commit="c-1")
    ledger.mark_landed(names(spark, *[f"x/file{i}" for i in range(200)]), out, "c-1")
    files = [f for d, _, fs in os.walk(f"{out}/cut=x") for f in fs if f.endswith(".json")]
    assert len(files) == 2
    assert read_corpus(spark, out).select("file").distinct().count() == 200
