import hashlib

import pytest
import zstandard

from gristmill.llm import queries, warc_zst
from oracle_check import connect, difference

SMALL = "/root/testdata/sf0.01"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_query_matches_sql(spark):
    got = queries.op8_warc_zst(spark, SMALL).toPandas()
    assert difference(got, connect(SMALL).execute(queries.SQL["op8_warc_zst"]).fetchdf()) is None


def test_round_trip_of_odd_pages(spark):
    long, umlaut = "x" * 1500, "ü" * 499 + "é"
    rows = [(1, "u1", long, "a"), (2, None, long, None), (3, "u\n3", None, "b"), (4, "u4", "", ""), (5, "u5", "a\r\n\r\nb", ""), (6, "u6", umlaut, ""), (7, "u7", umlaut, ""), (8, "u8", "ü" * 499, ""), (9, "u9", "ü" * 499, ""), (10, "u", "z" * 300_000, "")]
    got = {r["record_id"]: r for r in warc_zst.round_trip(pages(spark, rows)).collect()}
    assert len(got) == 10 and not any(r["error"] for r in got.values())
    for i, _, html, _ in rows:
        row, data = got[f"<urn:page:{i}>"], (html or "").encode()
        assert row["payload_length"] == len(data)
        assert row["payload_digest"] == hashlib.sha1(data).hexdigest()
        revisit = i in (1, 6)
        assert row["record_type"] == ("revisit" if revisit else "response")
        assert bytes(row["payload"]) == (b"" if revisit else data)
    assert got["<urn:page:1>"]["refers_to_id"] == "<urn:page:2>"
    assert got["<urn:page:6>"]["refers_to_id"] == "<urn:page:7>"


def test_empty_table_and_repeated_pages(spark):
    assert warc_zst.round_trip(pages(spark, []).limit(0)).collect() == []
    twice = pages(spark, [(1, "u", "y" * 1200, "")] * 2 + [(None, "u", "q", "")])
    rows = warc_zst.round_trip(twice).collect()
    assert sorted(r["record_type"] for r in rows) == ["response"] * 3


def record(i, body=b"body"):
    return warc_zst.record(i, "u", body, hashlib.sha1(body).hexdigest(), None)


def test_broken_archives_are_told(spark, tmp_path):
    good = warc_zst.archive_bytes([record(i, b"text %d " % i * 50) for i in range(20)])
    assert [warc_zst.parse(f)["record_id"] for f in warc_zst.frames(good)] == [f"<urn:page:{i}>" for i in range(20)]
    (tmp_path / "good.warc.zst").write_bytes(good)
    (tmp_path / "cut.warc.zst").write_bytes(good[:-10])
    (tmp_path / "empty.warc.zst").write_bytes(b"")
    wrong = record(1).replace(b"Content-Length: 4", b"Content-Length: 5")
    flipped = record(1).replace(b"\r\n\r\nbody", b"\r\n\r\nbodz")
    (tmp_path / "wrong.warc.zst").write_bytes(warc_zst.archive_bytes([wrong, record(2), flipped]))
    (tmp_path / "plain.warc.zst").write_bytes(zstandard.ZstdCompressor().compress(record(3)) + b"junk")
    rows = warc_zst.read_archives(warc_zst.list_archives(spark, str(tmp_path))).collect()
    by = lambda name: [r for r in rows if r["archive"].endswith(f"/{name}.warc.zst")]
    assert len(by("good")) == 20 and not any(r["error"] for r in by("good"))
    assert by("cut")[-1]["error"].startswith("archive:") and len(by("cut")) == 20
    assert by("empty") == []
    assert [bool(r["error"]) for r in sorted(by("wrong"), key=lambda r: r["position"])] == [True, False, True]
    assert [bool(r["error"]) for r in sorted(by("plain"), key=lambda r: r["position"])] == [False, True]


@pytest.mark.parametrize("data", [b"", b"WARC/1.1\r\n\r\n", b"x: y\r\n\r\n", b"WARC/1.1\r\nnope\r\n\r\n"])
def test_bad_records_raise(data):
    with pytest.raises(ValueError):
        warc_zst.parse(data)
