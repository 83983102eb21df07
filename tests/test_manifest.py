import gzip
import random

import pytest
from pyspark.sql import functions as F

from gristmill.operators import manifest as m
from gristmill.operators.numbering import number_rows, renumber
from gristmill.plans.acquire import fetch_plan, shuffled_manifest
from gristmill.sources.manifests import read_manifests, write_manifest


def manifest(spark, n, first=0):
    return spark.range(first, first + n).select(
        F.col("id").alias("pos"), F.concat(F.lit("d/"), F.col("id"), F.lit(".wet.gz")).alias("path")
    )


def test_numbering_follows_bucket_and_order(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 5), i) for i in range(200)]
    df = spark.createDataFrame(rows, "b int, k int").repartition(7)
    got = number_rows(df, F.col("b"), [F.col("k").desc()], total="n").collect()
    want = sorted(rows, key=lambda r: (r[0], -r[1]))
    assert [(r["b"], r["k"]) for r in sorted(got, key=lambda r: r["pos"])] == want
    assert {r["n"] for r in got} == {200}
    assert [r["pos"] for r in sorted(got, key=lambda r: r["pos"])] == list(range(200))


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_renumber_closes_gaps(spark, width):
    keep = [0, 3, 4, 17, 400, 401]
    df = spark.createDataFrame([(k,) for k in keep], "pos bigint").withColumn("old", F.col("pos"))
    got = renumber(df, width=width).orderBy("pos").collect()
    assert [(r["old"], r["pos"]) for r in got] == [(k, i) for i, k in enumerate(keep)]
    assert renumber(df.where("pos < 0"), width=width).count() == 0


def test_hot_bucket_is_numbered_whole(spark):
    df = spark.range(3000).withColumn("b", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")))
    got = number_rows(df, F.col("b"), [F.col("id")]).agg(
        F.count_distinct("pos").alias("n"), F.min("pos").alias("lo"), F.max("pos").alias("hi")
    ).first()
    assert (got["n"], got["lo"], got["hi"]) == (3000, 0, 2999)


@pytest.mark.parametrize("n,k,sizes", [(11, 3, [4, 4, 3]), (3, 5, [1, 1, 1]), (8, 4, [2, 2, 2, 2]), (1, 1, [1]), (0, 3, [])])
def test_split_sizes(spark, n, k, sizes):
    rows = m.assign_splits(manifest(spark, n), k).orderBy("pos").collect()
    splits = [r["split"] for r in rows]
    assert splits == [i for i, size in enumerate(sizes) for _ in range(size)]


def test_splits_ignore_gaps(spark):
    rows = m.assign_splits(manifest(spark, 40).where("pos % 4 = 1"), 3).orderBy("pos").collect()
    assert [r["split"] for r in rows] == [0] * 4 + [1] * 3 + [2] * 3


def test_slices(spark):
    df = manifest(spark, 10)
    assert [r["pos"] for r in m.slice_manifest(df, 3, 6).collect()] == [3, 4, 5]
    assert m.slice_manifest(df, 3).count() == 7
    assert m.slice_manifest(df, 0, 0).count() == 0
    assert m.slice_manifest(df, 8, 99).count() == 2
    with pytest.raises(ValueError):
        m.slice_manifest(df, 0, -2)


def test_batches_and_labels(spark):
    df = spark.range(0, 60_000, 1).select(F.col("id").alias("pos"), F.lit("p").alias("path"))
    rows = (
        m.batch_manifest(df, start=20_000, k=2)
        .groupBy("batch", "batch_label")
        .agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("lo"))
        .orderBy("batch")
        .collect()
    )
    assert [tuple(r) for r in rows] == [(0, "2w_3w", 10_000, 20_000), (1, "3w_4w", 10_000, 30_000)]


def test_landed_names(spark):
    paths = spark.createDataFrame(
        [("a/1.wet.gz",), ("a/2.wet.gz",), ("a/3.wet.gz",), ("b/1.wet.gz",), ("a/4.wet",)], "path string"
    )
    landed = spark.createDataFrame(
        [("out/1.wet",), ("out/2.wet.gz",), ("out/3.wet.gz.tmp",), ("out/4.wet.gz",)], "path string"
    )
    open_ = {r["path"] for r in m.anti_landed(paths, landed).collect()}
    assert open_ == {"a/3.wet.gz", "a/4.wet"}


def test_shuffle_is_a_stable_permutation(spark):
    df = manifest(spark, 500).withColumn("path", F.when(F.col("pos") % 3 == 0, "same").otherwise(F.col("path")))
    df = df.withColumnRenamed("pos", "old")
    first = m.seeded_shuffle(df, ["path", "old"]).orderBy("pos").collect()
    again = m.seeded_shuffle(df.repartition(5), ["path", "old"]).orderBy("pos").collect()
    other = m.seeded_shuffle(df, ["path", "old"], seed=1).orderBy("pos").collect()
    assert [r["pos"] for r in first] == list(range(500))
    assert [r["old"] for r in first] == [r["old"] for r in again]
    assert [r["old"] for r in first] != [r["old"] for r in other]
    assert sorted(r["old"] for r in first) == list(range(500))
    assert [r["old"] for r in first] != list(range(500))


def test_dump_entries(spark):
    html = """<ul><li>about</li>
      <li>s3://commoncrawl/crawl-data/CC-MAIN-2023-06 &ndash; <a href='x'>January/February <b>2023</b></a></li>
      <li>s3://commoncrawl/crawl-data/CC-MAIN-2018-05/ – <a>January 2018</a></li>
      <li>s3://commoncrawl/crawl-data/CC-MAIN-2021-04 – <a>no year</a></li></ul>"""
    pages = spark.createDataFrame([(html,)], "html string")
    entries = m.dump_entries(m.extract_list_items(pages))
    rows = [tuple(r) for r in entries.select("date_label", "dump_id", "manifest_url").collect()]
    base = "https://data.commoncrawl.org/crawl-data/"
    assert rows == [
        ("January/February 2023", "CC-MAIN-2023-06", base + "CC-MAIN-2023-06/wet.paths.gz"),
        ("January 2018", "CC-MAIN-2018-05", base + "CC-MAIN-2018-05/wet.paths.gz"),
        ("no year", "CC-MAIN-2021-04", base + "CC-MAIN-2021-04/wet.paths.gz"),
    ]
    assert [r["dump_id"] for r in m.filter_min_year(entries).collect()] == ["CC-MAIN-2023-06"]


def test_manifest_files_in_input_order(spark, tmp_path):
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"crawl/CC-MAIN-2022-05/x/2.gz\n\n 3.gz \n"))
    (tmp_path / "a.txt").write_text("crawl/CC-MAIN-2021-04/x/1.gz\r\n")
    files = [str(tmp_path / "b.gz"), str(tmp_path / "a.txt")]
    rows = [tuple(r) for r in read_manifests(spark, files).orderBy("pos").collect()]
    assert rows == [
        (0, "crawl/CC-MAIN-2022-05/x/2.gz", "CC-MAIN-2022-05", "2.gz"),
        (1, "3.gz", None, "3.gz"),
        (2, "crawl/CC-MAIN-2021-04/x/1.gz", "CC-MAIN-2021-04", "1.gz"),
    ]
    out = str(tmp_path / "out")
    write_manifest(read_manifests(spark, files).repartition(3), out)
    again = read_manifests(spark, out).orderBy("pos").collect()
    assert [r["path"] for r in again] == [r[1] for r in rows]
    one = read_manifests(spark, str(tmp_path / "a.txt")).collect()
    assert [r["pos"] for r in one] == [0]


def attempts(spark):
    rows = [("first", 1, True)]
    rows += [("fifth", i, i == 5) for i in range(1, 6)]
    rows += [("sixth", i, i == 6) for i in range(1, 7)]
    rows += [("never", i, False) for i in range(1, 11)]
    return spark.createDataFrame(rows, "path string, try int, ok boolean")


def test_retry_accounting(spark):
    failed = {r["path"]: r["n_tries"] for r in m.failed_after(attempts(spark)).collect()}
    assert failed == {"sixth": 5, "never": 5}
    twice = {r["path"]: r["n_tries"] for r in m.failed_after(attempts(spark), rounds=2).collect()}
    assert twice == {"never": 10}
    rounds = [tuple(r) for r in m.retry_rounds(attempts(spark)).orderBy("round").collect()]
    assert rows_as_ints(rounds) == [(1, 4, 2), (2, 2, 1)]


def rows_as_ints(rows):
    return [tuple(int(v) for v in r) for r in rows]


def test_fetch_plan(spark):
    paths = manifest(spark, 30).withColumn(
        "path", F.when(F.col("pos") < 10, F.concat(F.lit("CC-MAIN-2019-01/"), "path")).otherwise(F.col("path"))
    )
    shuffled = shuffled_manifest(paths)
    assert shuffled.count() == 20
    landed = shuffled.where("pos = 3").select("path")
    rows = fetch_plan(shuffled, landed, start=0, step=5, k=2, workers=2).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == [0, 1, 2, 4, 5, 6, 7, 8, 9]
    assert [r["batch"] for r in rows] == [0] * 4 + [1] * 5
    assert [r["split"] for r in rows] == [0] * 5 + [1] * 4
