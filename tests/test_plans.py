import gzip
import json
import os
import shutil

import pytest

from gristmill.plans import coarse
from gristmill.plans.coarse import run_coarse
from gristmill.sources.listing import landed_partitions
from gristmill.sources.wet import file_headers, read_wet, read_wet_rows
from gristmill.streaming.incremental import clean_stream, land_new, stream_wet, write_new
from test_wet import INFO, record

GOOD = "Title\n" + "\n".join(
    f"Paragraph number {i} holds enough words, with a sound mean length and a full stop at its end."
    for i in range(8)
)
SHORT = "Title\ntoo short\n"
HIT = GOOD + "\nThis paragraph names the FORBIDDEN thing and therefore drops out.\n"


def archive(folder, name, bodies, broken=False):
    text = INFO + "".join(record(n, b) for n, b in bodies.items())
    data = text.encode() + (b"\xff\xfe broken \n" if broken else b"")
    (folder / name).write_bytes(gzip.compress(data) if name.endswith(".gz") else data)


def urls(spark, out):
    return sorted(r["url"] for r in read_wet(spark, out).select("url").collect())


def test_first_stage_end_to_end(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    archive(data, "a.warc.wet.gz", {"1": GOOD, "2": SHORT, "3": HIT})
    archive(data, "b.warc.wet", {"4": GOOD})
    archive(data, "broken.warc.wet.gz", {"5": GOOD}, broken=True)
    archive(data, "none.warc.wet.gz", {"6": SHORT})

    report = run_coarse(spark, str(data), out, ["forbidden"], batch_files=3)
    assert (report.n_files, report.n_failed, report.n_parsed, report.n_docs) == (4, 1, 5, 5)
    assert urls(spark, out) == ["http://h1:8/p", "http://h4:8/p"]

    # One folder per archive, the header first, a header also where nothing is left.
    archives = sorted(d.split("=")[1] for d in os.listdir(out) if d.startswith("archive="))
    assert archives == ["a.warc.wet", "b.warc.wet", "none.warc.wet"]
    heads = file_headers(read_wet_rows(spark, out)).collect()
    assert {r["headers"][1] for r in heads} == {"WARC-Type: warcinfo"} and len(heads) == 3
    failed = [
        json.loads(line)
        for f in os.listdir(out + "/_failed")
        if f.endswith(".json")
        for line in open(f"{out}/_failed/{f}", encoding="utf-8")
    ]
    assert [(f["file"].split("/")[-1], f["reason"]) for f in failed] == [
        ("broken.warc.wet.gz", "bad_utf8")
    ]

    # Resume: only new files and the failed one are read again.
    archive(data, "c.warc.wet.gz", {"7": GOOD})
    again = run_coarse(spark, str(data), out, ["forbidden"])
    assert (again.n_files, again.n_failed) == (2, 1)
    assert urls(spark, out) == ["http://h1:8/p", "http://h4:8/p", "http://h7:8/p"]


def test_broken_compression_puts_a_file_aside(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    archive(data, "a.wet.gz", {"1": GOOD})
    archive(data, "b.wet", {"2": GOOD})
    archive(data, "cut.wet.gz", {str(i): GOOD for i in range(3, 40)})
    whole = (data / "cut.wet.gz").read_bytes()
    (data / "cut.wet.gz").write_bytes(whole[: len(whole) // 2])
    (data / "noise.wet.gz").write_bytes(b"no gzip at all")
    # Two members, the second one damaged.
    (data / "two.wet.gz").write_bytes((data / "a.wet.gz").read_bytes() + whole[:-9])
    report = run_coarse(spark, str(data), out)
    assert (report.n_files, report.n_failed, report.n_docs) == (5, 3, 2)
    assert urls(spark, out) == ["http://h1:8/p", "http://h2:8/p"]


def test_a_batch_of_broken_files_only(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "noise.wet.gz").write_bytes(b"no gzip at all")
    report = run_coarse(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert (report.n_files, report.n_failed, report.n_docs) == (1, 1, 0)


def test_nothing_to_do(spark, tmp_path):
    report = run_coarse(spark, str(tmp_path / "none"), str(tmp_path / "out"))
    assert report.n_files == 0


def test_many_words_give_the_same_documents(spark, tmp_path):
    data = tmp_path / "in"
    data.mkdir()
    archive(data, "a.wet", {"1": GOOD, "3": HIT})
    many = ["forbidden"] + [f"absent{i}" for i in range(100)]
    run_coarse(spark, str(data), str(tmp_path / "few"), ["forbidden"])
    run_coarse(spark, str(data), str(tmp_path / "many"), many)
    assert urls(spark, str(tmp_path / "few")) == urls(spark, str(tmp_path / "many")) == ["http://h1:8/p"]


def test_output_is_equal_on_both_sides_of_the_bound(spark, tmp_path, monkeypatch):
    data = tmp_path / "in"
    data.mkdir()
    archive(data, "a.wet", {"1": GOOD, "3": HIT})
    words = spark.createDataFrame([(w,) for w in ["forbidden", "x1", "x2", "x3", "x4", "x5"]], "word string")
    run_coarse(spark, str(data), str(tmp_path / "within"), words)
    run_coarse(spark, str(data), str(tmp_path / "beyond"), words, max_entries=2)
    assert urls(spark, str(tmp_path / "within")) == urls(spark, str(tmp_path / "beyond")) == ["http://h1:8/p"]
    with pytest.raises(TypeError):
        run_coarse(spark, str(data), str(tmp_path / "none"), None)


@pytest.mark.parametrize("kind", ["metadata", "request", "warcinfo"])
@pytest.mark.parametrize("name", ["a.wet.gz", "a.wet"])
@pytest.mark.parametrize("written, read", [("crlf", "crlf"), ("lf", "lf"), ("lf", "crlf"), ("lf", "any")])
def test_headers_of_any_type_stay(spark, tmp_path, kind, name, written, read):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    others = record("9", "second\nmetadata\n", kind="metadata")
    text = INFO.replace("warcinfo", kind) + others + record("1", GOOD) + others
    if written == "lf":
        text = text.replace("\r\n", "\n")
    (data / name).write_bytes(gzip.compress(text.encode()) if name.endswith(".gz") else text.encode())
    run_coarse(spark, str(data), out, newline=read)
    assert urls(spark, out) == ["http://h1:8/p"]
    heads = [r["headers"] for r in file_headers(read_wet_rows(spark, out)).collect()]
    heads = [h for h in heads if h[1] != "WARC-Type: conversion"]
    assert [h[:4] for h in heads] == [["WARC/1.0", f"WARC-Type: {kind}", "WARC-Date: 2023-01-01T00:00:00Z", "WARC-Filename: a.warc.wet.gz"]]


def test_headers_of_split_plain_files(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    for name in "ab":
        bodies = {f"{name}{i}": GOOD for i in range(40)}
        text = INFO.replace("warcinfo", "metadata").replace("a.warc", name) + "".join(record(n, b) for n, b in bodies.items())
        (data / f"{name}.wet").write_text(text.replace("\r\n", "\n").replace("\n", "\r\n"), newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        run_coarse(spark, str(data), out)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(urls(spark, out)) == 80
    heads = [r["headers"] for r in file_headers(read_wet_rows(spark, out)).collect()]
    assert sorted(h[3] for h in heads if h[1] == "WARC-Type: metadata") == ["WARC-Filename: a.wet.gz", "WARC-Filename: b.wet.gz"]


def test_an_archive_is_read_once(spark, tmp_path, monkeypatch):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    archive(data, "a.wet.gz", {"1": GOOD})
    archive(data, "b.wet", {"2": GOOD})
    read = []

    def counted(spark, paths, newline):
        read.extend(paths)
        return read_wet_rows(spark, paths, newline)

    monkeypatch.setattr(coarse, "read_wet_rows", counted)
    run_coarse(spark, str(data), out)
    assert sorted(p.split("/")[-1] for p in read) == ["a.wet.gz", "b.wet"]
    assert urls(spark, out) == ["http://h1:8/p", "http://h2:8/p"]
    assert not [d for d in os.listdir(out) if d.startswith("_staging")]


def test_a_run_broken_off_before_publishing(spark, tmp_path, monkeypatch):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    for name in "abc":
        archive(data, f"{name}.wet", {name: GOOD})
    publish = coarse.publish

    def part(spark, folder, out, names):
        publish(spark, folder, out, names[:2])
        raise RuntimeError("lost")

    monkeypatch.setattr(coarse, "publish", part)
    with pytest.raises(RuntimeError):
        run_coarse(spark, str(data), out)
    monkeypatch.setattr(coarse, "publish", publish)
    assert run_coarse(spark, str(data), out).n_files == 3
    assert urls(spark, out) == ["http://ha:8/p", "http://hb:8/p", "http://hc:8/p"]


ODD_NAMES = ("a b.wet", "a%20c.wet", "d+e.wet.gz", "f[1].wet", "ü{x}.wet.gz")


def test_odd_names_land_once(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    for i, name in enumerate(ODD_NAMES):
        archive(data, name, {str(i): GOOD})
    assert run_coarse(spark, str(data), out).n_files == 5
    assert run_coarse(spark, str(data), out).n_files == 0
    assert urls(spark, out) == sorted(f"http://h{i}:8/p" for i in range(5))
    got = {r["path"] for r in landed_partitions(spark, out, "archive").collect()}
    assert got == {n.removesuffix(".gz") for n in ODD_NAMES}


def test_half_landed_archives_are_replaced(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    archive(data, "x.wet", {"1": GOOD, "2": GOOD})
    run_coarse(spark, str(data), out)
    shutil.copytree(f"{out}/archive=x.wet", tmp_path / "half")
    other = str(tmp_path / "other")
    shutil.copytree(tmp_path / "half", f"{other}/archive=x.wet")
    # The ledger does not know the archive, whatever lies in its folder.
    assert run_coarse(spark, str(data), other).n_files == 1
    assert urls(spark, other) == ["http://h1:8/p", "http://h2:8/p"]


def test_archives_without_survivors_are_done(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    (data / "only.wet").write_text("no record at all")
    archive(data, "short.wet", {"1": SHORT})
    assert run_coarse(spark, str(data), out).n_files == 2
    assert run_coarse(spark, str(data), out).n_files == 0


def test_failed_files_are_listed_once(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    archive(data, "bad.wet", {"1": GOOD}, broken=True)
    (data / "noise.wet.gz").write_bytes(b"no gzip at all")
    for _ in range(2):
        assert run_coarse(spark, str(data), out).n_failed == 2
    listed = spark.read.json(f"{out}/_failed").collect()
    assert sorted((r["file"].split("/")[-1], r["reason"]) for r in listed) == [("bad.wet", "bad_utf8"), ("noise.wet.gz", "unreadable")]
    archive(data, "bad.wet", {"1": GOOD})
    assert run_coarse(spark, str(data), out).n_failed == 1
    assert [r["file"].split("/")[-1] for r in spark.read.json(f"{out}/_failed").collect()] == ["noise.wet.gz"]


def test_stream_withholds_what_the_batch_withholds(spark, tmp_path):
    data, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    data.mkdir()
    archive(data, "a.wet.gz", {"1": GOOD, "2": SHORT})
    archive(data, "bad.wet", {"3": GOOD}, broken=True)
    (data / "noise.wet.gz").write_bytes(b"no gzip at all")
    for _ in range(2):
        land_new(spark, str(data), out, state, ["forbidden"]).awaitTermination()
        assert urls(spark, out) == ["http://h1:8/p"]
    assert spark.read.json(f"{out}/_failed").count() == 2
    archive(data, "b.wet", {"4": GOOD})
    land_new(spark, str(data), out, state, ["forbidden"]).awaitTermination()
    assert urls(spark, out) == ["http://h1:8/p", "http://h4:8/p"]


def test_stream_takes_each_file_once(spark, tmp_path):
    data, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    data.mkdir()

    def run():
        docs = clean_stream(stream_wet(spark, str(data)), ["forbidden"])
        write_new(docs, out, state).awaitTermination()
        rows = spark.read.schema("url string, n_kept int").parquet(out).collect()
        return sorted((r["url"], r["n_kept"]) for r in rows)

    archive(data, "a.warc.wet.gz", {"1": GOOD, "2": SHORT, "3": HIT})
    (data / "note.txt").write_text("no archive")
    assert run() == [("http://h1:8/p", 8)]
    archive(data, "b.wet", {"4": GOOD})
    assert run() == [("http://h1:8/p", 8), ("http://h4:8/p", 8)]
    assert run() == [("http://h1:8/p", 8), ("http://h4:8/p", 8)]
