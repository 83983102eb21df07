import hashlib
import re
import time

from gristmill.llm import pii, queries

SMALL = "/root/testdata/sf0.01"


def luhn(d):
    n = [int(c) for c in d[::-1]]
    return sum(n[::2]) % 10 == -sum(sum(divmod(2 * x, 10)) for x in n[1::2]) % 10


def brute(text):
    text, found = text or "", []
    digits = lambda v: re.sub("[^0-9]", "", v)
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(p) <= 255 for p in v.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 9 <= len(digits(v)) <= 15),
    )
    for kind, pattern, ok in kinds:
        found += [(kind, m.start(), m.end()) for m in re.finditer(pattern, text) if ok(m[0])]
    return found


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()


def test_base_spans_match_brute_force(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries.op5_personal_data(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(f[0] == k for f in want) for k in pii.KINDS]
        assert r["base_sha256"] == digest(want)
        assert set(filter(None, r["spans"].split(","))) >= {f"{k}:{s}:{e}" for k, s, e in want}
        if not re.search("[0-9@]", texts[r["doc_id"]]):
            assert r["spans"] == ""


ODD = [
    None,
    "",
    "é😀 a@b.c._x@d.e-f.gh, x@y z@ @w.com a.@b.c",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.0004 1.2.3.99999999999999999999",
    "4111 1111 1111 1111 4111-1111-1111-1112 4041894974608795 0000000000000",
    "+1 (988) 555-2485 +12 +1.2.3 +49-30-123456789012345 ++1 234 567 8901",
    "9" * 50_000 + " " + "a" * 50_000 + "@b.c " + "1." * 20_000 + "0",
    "1 2-3 " * 5000 + "+" * 5000,
    "a@b.co +1 222 333 4444 " * 800,
]


def test_odd_texts(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, ODD[2], "x")], "doc_id long, text string, base string")
    rows = pii.summary(pii.scan(docs)).collect()
    assert len(rows) == len(ODD) + 1
    for r in rows:
        assert r["base_sha256"] == digest(brute(ODD[2 if r["doc_id"] is None else r["doc_id"]])), r["doc_id"]
    assert pii.summary(pii.scan(docs.limit(0))).collect() == []


def test_method_adds_what_labelers_agree_on(spark):
    rows = [(i, f"please contact us: user{i}.x@mail{i}.example.com or call +1 (555) 200-{1000 + i} today") for i in range(60)]
    rows += [(100 + i, f"page 2024-01-{10 + i} total 0.{1000000 + i} version 0{100000 + i}.5") for i in range(60)]
    rows += [(200, "é mail jo.doe7 (at) host (dot) com now"), *((300 + i, f"ssn 123-45-67{10 + i} is his") for i in range(40))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in pii.summary(pii.scan(docs)).collect()}
    assert got[200] == "handle:7:34" and got[303] == "number:4:15"
    assert all(got[100 + i] == "" for i in range(60))
    assert got[3].count("email:") == 1 and got[3].count("phone:") == 1


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, "a@b.co")], "doc_id long, text string")
    plan = pii.find(docs, "doc_id", "text")._jdf.queryExecution().toString()
    plan += pii.summary(pii.scan(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_many_spans_in_one_text(spark):
    """100,000 spans of several families in 2 MB."""
    parts = [f"a{i}@b.co +1 222 {i:07d} 1.2.3.{i % 250}, call (555) {1000000 + i}" for i in range(25_000)]
    text = "\n".join(parts)
    assert len(text) > 1_000_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.time()
    row = pii.summary(pii.scan(docs)).first()
    assert time.time() - start < 40
    assert row["base_sha256"] == digest(brute(text)) and row["n_email"] == 25_000
