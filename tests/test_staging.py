from gristmill.sources import staging
from gristmill.sources.listing import landed_partitions, list_files, path_batches


def test_named_folder_is_used(spark):
    named = spark.conf.get(staging.SETTING, None)
    folder = staging.shared_folder(spark)
    assert folder == (named.rstrip("/") if named else folder)
    assert staging.new_folder(spark, "a") != staging.new_folder(spark, "a")


def test_own_folder_only_where_none_is_named(spark, monkeypatch):
    monkeypatch.setattr(staging, "SETTING", "gristmill.no.such.setting")
    folder = staging.shared_folder(spark)
    assert folder == staging.shared_folder(spark)
    staged = staging.stage(spark.range(5), "numbers")
    assert staged.count() == 5 and folder + "/numbers-" in staged.inputFiles()[0]


def test_batches_cover_every_file_once(spark):
    files = spark.range(7).selectExpr("concat('f', id) AS path", "id AS size")
    assert list(path_batches(files, 3)) == [["f0", "f1", "f2"], ["f3", "f4", "f5"], ["f6"]]
    assert list(path_batches(files.where("size < 0"), 3)) == []


def test_landed_values_are_decoded(spark, tmp_path):
    names = ["plain", "a+b", "a b", "50%", "x:y"]
    out = str(tmp_path / "out")
    df = spark.createDataFrame([(n, n) for n in names], "archive string, value string")
    df.write.partitionBy("archive").text(out)
    assert {r["path"] for r in landed_partitions(spark, out, "archive").collect()} == set(names)
    assert list_files(spark, str(tmp_path / "none")).count() == 0
    assert landed_partitions(spark, str(tmp_path / "none"), "cut", "file").count() == 0
