"""Manifest text files: one path per line."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.text import strip
from gristmill.operators.manifest import dump_of
from gristmill.functions.paths import base_name
from gristmill.operators.numbering import number_rows


def read_manifests(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Lines of one or many manifests (plain or gzip) in input order.

    Gives pos, path, dump, file_name. Lines are stripped, empty ones left out.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    parts = [
        spark.read.text(p).select(
            F.lit(i).alias("_manifest"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_line"),
            strip(F.col("value")).alias("path"),
        )
        for i, p in enumerate(paths)
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    numbered = number_rows(
        union.where("path <> ''"),
        F.struct("_manifest", "_file", "_block"),
        [F.col("_line")],
    )
    return numbered.select(
        "pos", "path", dump_of(F.col("path")).alias("dump"), base_name(F.col("path")).alias("file_name")
    )


def write_manifest(df: DataFrame, out: str, mode: str = "errorifexists") -> None:
    """Write paths one per line; part files follow the order of ``pos``."""
    df.orderBy("pos").select(F.col("path").alias("value")).write.mode(mode).text(out)
