import gzip

import pytest

from gristmill.sources import wet

INFO = (
    "WARC/1.0\r\nWARC-Type: warcinfo\r\nWARC-Date: 2023-01-01T00:00:00Z\r\n"
    "WARC-Filename: a.warc.wet.gz\r\n\r\nrobots: checked\r\n\r\n\r\n"
)


def record(n, body, end="\r\n\r\n", length="77", kind="conversion"):
    return (
        f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Target-URI: http://h{n}:8/p\r\n"
        "WARC-Date: 2023-02-05T10:20:30Z\r\nWARC-Record-ID: <urn:uuid:1>\r\n"
        "WARC-Refers-To: <urn:uuid:2>\r\nWARC-Block-Digest: sha1:ABC\r\n"
        f"Content-Type: text/plain\r\nContent-Length: {length}\r\n\r\n{body}{end}"
    )


def write(path, text, encoding="utf-8"):
    data = text.encode(encoding) if isinstance(text, str) else text
    path.write_bytes(gzip.compress(data) if path.suffix == ".gz" else data)


def docs(spark, path, **options):
    rows = wet.read_wet(spark, str(path), **options).collect()
    return {r["url"][8:-4]: (r["title"], r["raw_content"], r["nlines"], r["length"]) for r in rows}


BODIES = {
    "1": ("Title one\nline 1\nline 2\n", ("Title one", "line 1\nline 2", 2, 77)),
    "2": ("Title\n  padded　\n\n\tx WARC/1.0 y\n", ("Title", "padded\n\nx WARC/1.0 y", 3, 77)),
    "3": ("T\nno newline at the end", ("T", "no newline at the end\n", 2, 77)),
    "4": ("\nuntitled\n", ("", "untitled", 1, 77)),
    "5": ("T\nlone\rreturn\n", ("T", "lone\nreturn", 2, 77)),
}


@pytest.mark.parametrize("name", ["a.warc.wet.gz", "a.warc.wet"])
@pytest.mark.parametrize("newline", ["crlf", "lf"])
def test_bodies_in_every_framing(spark, tmp_path, name, newline):
    text = INFO + "".join(record(n, body) for n, (body, _) in BODIES.items())
    if newline == "lf":
        text = text.replace("\r\n", "\n")
    (tmp_path / "deep").mkdir()
    write(tmp_path / "deep" / name, text)
    (tmp_path / "note.txt").write_text(text)
    want = {n: w for n, (_, w) in BODIES.items()}
    # The other newline style frames records later, with the same result.
    assert docs(spark, tmp_path, newline="crlf") == want
    assert docs(spark, tmp_path, newline="lf") == want


def test_last_record_is_like_the_others(spark, tmp_path):
    for end in ("\r\n\r\n", "\r\n\r\n\n", "\n\n", "\r\n", ""):
        folder = tmp_path / f"end{len(end)}{end.count(chr(13))}"
        folder.mkdir()
        write(folder / "a.wet", INFO + record("1", "T\nx\n", end) + record("2", "T\nx\n", end))
        got = docs(spark, folder)
        if end:
            assert got["1"] == got["2"]
        assert got["2"][1].startswith("x")


def test_multi_member_gzip(spark, tmp_path):
    parts = [INFO, record("1", "T\na\n"), record("2", "T\nb\n")]
    (tmp_path / "m.gz").write_bytes(b"".join(gzip.compress(p.encode()) for p in parts))
    assert sorted(docs(spark, tmp_path)) == ["1", "2"]


def test_plain_files_may_be_split_anywhere(spark, tmp_path):
    want = {str(i): ("T", "word " * (i % 7) + "end", 1, 77) for i in range(60)}
    write(tmp_path / "s.wet", INFO + "".join(record(i, f"T\n{w[1]}\n") for i, w in want.items()))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("700", "1111", "5000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert docs(spark, tmp_path) == want
            heads = wet.file_headers(wet.read_wet_rows(spark, str(tmp_path))).collect()
            assert heads[0]["headers"][1] == "WARC-Type: warcinfo"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_marker_line_inside_a_body_ends_the_record(spark, tmp_path):
    for marker in ("WARC/1.0", "  WARC/1.0 \t"):
        folder = tmp_path / str(len(marker))
        folder.mkdir()
        write(folder / "a.wet", INFO + record("1", f"T\nx\n{marker}\nrest: conversion\n") + record("2", "T\ny\n"))
        assert {k: v[1] for k, v in docs(spark, folder).items()} == {"1": "x", "2": "y"}


def test_indented_marker_before_a_record(spark, tmp_path):
    write(tmp_path / "a.wet", INFO + record("1", "T\nx\n") + "  " + record("2", "T\ny\n"))
    assert {k: v[1] for k, v in docs(spark, tmp_path).items()} == {"1": "x", "2": "y"}


def test_records_that_are_no_documents(spark, tmp_path):
    good = record("1", "T\nx\n")
    write(
        tmp_path / "a.wet",
        INFO
        + record("2", "T\nx\n", kind="response")
        + record("3", "only a title\n")
        + record("4", "")
        + record("5", "\n")
        + record("6", "T\nx\n").replace("WARC-Date: ", "WARC-Date:")
        + record("7", "T\nx\n").replace("WARC-Type: conversion\r\n", "")
        + "WARC/1.0\r\nWARC-Type: conversion\r\n\r\nT\nx\n\r\n\r\n"
        + good,
    )
    assert list(docs(spark, tmp_path)) == ["1"]


def test_length_is_zero_when_it_is_no_number(spark, tmp_path):
    write(tmp_path / "a.wet", record("1", "T\nx\n", length="many") + record("2", "T\nx\n", length=""))
    assert {k: v[3] for k, v in docs(spark, tmp_path).items()} == {"1": 0, "2": 0}


def test_lookup_by_field_name(spark, tmp_path):
    text = record("1", "T\nx\n")
    date = "WARC-Date: 2023-02-05T10:20:30Z\r\n"
    moved = text.replace(date, "").replace("WARC-Target", date + "WARC-Target")
    write(tmp_path / "a.wet", moved)
    by_name = wet.read_wet(spark, str(tmp_path), by_name=True).first()
    by_place = wet.read_wet(spark, str(tmp_path)).first()
    assert by_name["url"] == "http://h1:8/p"
    assert by_name["date_download"] == by_place["url"] == "2023-02-05T10:20:30Z"


def test_min_len_and_stats(spark, tmp_path):
    write(tmp_path / "a.wet", INFO + record("1", "T\nxx\n") + record("2", "T\nlonger\n"))
    assert list(docs(spark, tmp_path, min_len=3)) == ["2"]
    records = wet.parse_records(wet.read_wet_rows(spark, str(tmp_path)))
    stats = wet.parse_stats(records, min_len=3).first()
    assert (stats["n_docs"], stats["n_kept"], stats["kept_ratio"]) == (2, 1, 0.5)


def test_header_of_each_file(spark, tmp_path):
    write(tmp_path / "a.gz", INFO + record("1", "T\nx\n"))
    write(tmp_path / "b.wet", record("2", "T\nx\n"))
    heads = {
        r["file"][-5:].lstrip("/"): r["headers"]
        for r in wet.file_headers(wet.read_wet_rows(spark, str(tmp_path))).collect()
    }
    assert heads["a.gz"] == INFO.replace("\r", "").split("\n")[:-1]
    assert heads["b.wet"][:2] == ["WARC/1.0", "WARC-Type: conversion"]


def test_bad_bytes_put_the_whole_file_aside(spark, tmp_path):
    write(tmp_path / "good.gz", INFO + record("1", "T\nx\n"))
    broken = (INFO + record("2", "T\nx\n") + record("3", "T\n?\n")).encode().replace(b"?", b"\xff")
    write(tmp_path / "bad.gz", broken)
    good, failed = wet.quarantine(wet.read_wet_rows(spark, str(tmp_path)))
    assert {r["url"] for r in wet.parse_records(good).where("is_doc").collect()} == {"http://h1:8/p"}
    row = failed.first()
    assert (row["file"].split("/")[-1], row["reason"], row["n_bad"]) == ("bad.gz", "bad_utf8", 1)


def test_text_of_a_document(spark):
    df = spark.createDataFrame(
        [("http://h/p", "2023", "sha1:ABC", 5, "T \t", "a\nb  \n\n")],
        "url string, date_download string, digest string, length bigint, title string, raw_content string",
    )
    text = df.select(wet.to_wet_text().alias("t")).first()["t"]
    lines = text.split("\r\n")
    assert lines[:4] == ["WARC/1.0", "WARC-Type: conversion", "WARC-Target-URI: http://h/p", "WARC-Date: 2023"]
    assert lines[4].startswith("WARC-Record-ID: <urn:uuid:") and lines[5].startswith("WARC-Refers-To: <urn:uuid:")
    assert lines[4][16:] != lines[5][16:]
    assert lines[6:] == [
        "WARC-Block-Digest: sha1:ABC",
        "Content-Type: text/plain",
        "Content-Length: 5",
        "",
        "T",
        "a\nb",
        "",
    ]


def test_header_text_round_trip(spark):
    stripped = "WARC-Type: warcinfo\nk: v\n\nrobots: x\n\n"
    df = spark.createDataFrame([(stripped,)], "record_text string")
    text = df.select(wet.header_text().alias("t")).first()["t"]
    assert text == "WARC/1.0\r\nWARC-Type: warcinfo\r\nk: v\r\n\r\nrobots: x\r\n"


def test_reading_is_narrow(spark, tmp_path):
    write(tmp_path / "a.wet", record("1", "T\nx\n"))
    plan = wet.read_wet(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Generate") == 1


def test_bucket_archives_are_read_by_many_tasks(spark, tmp_path):
    from gristmill.catalog import archives

    text = "Some words of a line that stays in the text, and more of them.\n" * 40
    rows = [(i, "web", "en", text + f"Line {i}.", len(text) + 30_000 * (i == 43)) for i in range(400)]
    docs = spark.createDataFrame([*rows, (None, "web", "en", text, 1)], "doc_id long, source string, lang string, text string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    size = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(size)
    spark.conf.set(size, "64k")
    try:
        folder = archives._bucket_archives(spark, str(tmp_path))
        read = wet.read_wet_rows(spark, folder)
        assert read.rdd.getNumPartitions() > 2 * archives.BUCKETS
        assert read.select("file").distinct().count() == archives.BUCKETS
        records = wet.parse_records(read).where("is_doc")
        assert records.count() == 400 and records.select("url").distinct().count() == 400
        bad = wet.bad_files(read).collect()
        assert [(r["reason"], r["n_bad"], "/bucket=3/" in r["file"]) for r in bad] == [("bad_utf8", 1, True)]
        heads = archives.coarse_other_headers(spark, str(tmp_path)).collect()
        want = [f"WARC/1.0|WARC-Type: metadata|WARC-Target-URI: bucket:{b}||note" for b in range(3)]
        assert sorted(r["head"] for r in heads) == want
    finally:
        spark.conf.set(size, before)
