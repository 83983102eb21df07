import gzip

import pytest

from gristmill.plans.coarse import run_coarse
from gristmill.sources import wet
from gristmill.sources.wet_records import read_wet_records
from test_plans import GOOD, archive, urls
from test_wet import BODIES, INFO, docs, record, write

TEXT = INFO + "".join(record(n, body) for n, (body, _) in BODIES.items())
WANT = {n: want for n, (_, want) in BODIES.items()}


def lf(text):
    return text.replace("\r\n", "\n")


@pytest.mark.parametrize("name", ["a.warc.wet.gz", "a.warc.wet"])
@pytest.mark.parametrize("kind", ["crlf", "lf", "mixed"])
def test_any_line_end(spark, tmp_path, name, kind):
    parts = [INFO, *(record(n, body) for n, (body, _) in BODIES.items())]
    turned = {"crlf": parts, "lf": [lf(p) for p in parts], "mixed": [lf(p) if i % 2 else p for i, p in enumerate(parts)]}
    write(tmp_path / name, "".join(turned[kind]))
    assert docs(spark, tmp_path, newline="any") == WANT


@pytest.mark.parametrize("split", [1, 7, 100, 997, 10_000])
def test_ranges_give_each_record_once(spark, tmp_path, split):
    write(tmp_path / "a.wet", "garbage\r\n" + TEXT)
    write(tmp_path / "b.wet", lf(TEXT))
    write(tmp_path / "c.wet.gz", TEXT)
    rows = read_wet_records(spark, str(tmp_path), split).collect()
    whole = read_wet_records(spark, str(tmp_path)).collect()
    assert sorted(bytes(r["value"], "utf-8") for r in rows) == sorted(bytes(r["value"], "utf-8") for r in whole)
    assert len(whole) == 3 * (1 + len(BODIES))
    for name in "abc":
        own = sorted((r["block_start"], r["row_id"], r["value"]) for r in rows if f"/{name}.wet" in r["file"])
        assert [v.split("\n")[1][:14] for _, _, v in own][0].startswith("WARC-Type: war")
        assert len({o[:2] for o in own}) == len(own)


def test_long_records_are_cut(spark, tmp_path):
    write(tmp_path / "a.wet", record("1", "x" * 5000) + record("2", "short\nbody\n"))
    rows = read_wet_records(spark, str(tmp_path), record_bytes=1000).orderBy("row_id").collect()
    assert [len(r["value"]) for r in rows][0] == 1000 and rows[0]["cut"] > 4000
    assert rows[1]["cut"] == 0 and "short" in rows[1]["value"]


def test_members_hidden_and_missing_files(spark, tmp_path):
    (tmp_path / "two.wet.gz").write_bytes(gzip.compress(INFO.encode()) + gzip.compress(record("1", "t\nb\n").encode()))
    write(tmp_path / "_hidden.wet", TEXT)
    (tmp_path / "note.txt").write_text(TEXT)
    (tmp_path / "empty.wet").write_bytes(b"")
    assert read_wet_records(spark, str(tmp_path)).count() == 2
    assert list(docs(spark, tmp_path, newline="any")) == ["1"]
    with pytest.raises(Exception, match="none"):
        read_wet_records(spark, str(tmp_path / "none")).count()


def test_bad_bytes_are_left_for_the_quarantine(spark, tmp_path):
    write(tmp_path / "a.wet", (INFO + record("1", "t\nb\n")).encode() + b"\xff\n")
    bad = wet.bad_files(wet.read_wet_rows(spark, str(tmp_path), "any")).collect()
    assert [(r["reason"], r["n_bad"]) for r in bad] == [("bad_utf8", 1)]


def test_first_stage_on_mixed_archives(spark, tmp_path):
    data, out = tmp_path / "in", str(tmp_path / "out")
    data.mkdir()
    archive(data, "a b.wet.gz", {"1": GOOD})
    (data / "b[1].wet").write_bytes((lf(INFO) + lf(record("2", GOOD)) + record("3", GOOD)).encode())
    archive(data, "bad.wet", {"4": GOOD}, broken=True)
    report = run_coarse(spark, str(data), out, newline="any")
    assert (report.n_files, report.n_failed, report.n_docs) == (3, 1, 3)
    assert urls(spark, out) == ["http://h1:8/p", "http://h2:8/p", "http://h3:8/p"]
