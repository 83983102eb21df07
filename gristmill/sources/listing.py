"""File listings as DataFrames, and the check of files that could not be read."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.paths import literal_path, plain_path
from gristmill.sources.staging import staged


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """All files under ``path`` as (path, size); a missing path gives no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, size bigint")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
    )
    return files.select("path", F.col("length").alias("size"))


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    return list_files(spark, path, "*.{gz,wet}")


def name_archives(spark: SparkSession, path: str) -> None:
    """Give plain text files under ``path`` the suffix of archives, which the writer does not know.

    A plain archive is split between tasks when it is read; a packed one is not.
    """
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    files = new_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for r in list_files(spark, path, "*.txt").select("path").collect():
        named = r["path"].removesuffix(".txt") + ".wet"
        if not files.rename(new_path(r["path"]), new_path(named)):
            raise OSError(f"could not rename {r['path']}")


def landed_partitions(spark: SparkSession, out: str, *columns: str) -> DataFrame:
    """Partition values that have output: one row per distinct set, ``path`` = joined by '/'."""

    def value(column: str):
        return plain_path(F.regexp_extract("path", rf"/{column}=([^/]+)/", 1))

    return (
        list_files(spark, out)
        .select(F.concat_ws("/", *[value(c) for c in columns]).alias("path"))
        .where("path <> '' AND NOT startswith(path, '/')")
        .distinct()
    )


def path_batches(files: DataFrame, size: int) -> Iterator[list[str]]:
    """Lists of at most ``size`` paths, in order; only one is on the driver at a time.

    The listing is staged in order, so that a batch reads its own stretch of it.
    Each batch starts after the last path of the one before, so it ends even if
    files of an earlier batch did not land.
    """
    last = ""
    with staged(files.select("path").orderBy("path"), "listing") as listing:
        while True:
            batch = listing.where(F.col("path") > last).orderBy("path").limit(size)
            paths = [r["path"] for r in batch.collect()]
            if not paths:
                return
            yield paths
            last = paths[-1]


def unreadable_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the given gzip files that do not decompress to their end.

    A file is checked by one task, which keeps none of its text.
    """

    def check(batches):
        import zlib

        import pandas as pd

        for batch in batches:
            bad = []
            for path, data in zip(batch["path"], batch["content"], strict=True):
                rest, sound = data, True
                while rest and sound:
                    member = zlib.decompressobj(wbits=31)
                    try:
                        while rest and not member.eof:
                            member.decompress(rest, 1 << 24)
                            rest = member.unused_data if member.eof else member.unconsumed_tail
                        sound = member.eof
                    except zlib.error:
                        sound = False
                if not sound:
                    bad.append(path)
            yield pd.DataFrame({"path": bad}, dtype="object")

    zipped = [p for p in paths if p.endswith(".gz")]
    if not zipped:
        return []
    given = [literal_path(p) for p in zipped]
    files = spark.read.format("binaryFile").load(given).select("path", "content")
    return sorted(r["path"] for r in files.mapInPandas(check, "path string").collect())
