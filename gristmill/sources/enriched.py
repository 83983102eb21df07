"""Documents as the second stage delivers them: JSON lines in ``*.wet`` files.

Language and perplexity come from outside; this is the contract they arrive by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.paths import base_name, cut_of, plain_path
from gristmill.operators.postfilter import ENRICHED_SCHEMA

# A result file lies under this directory and under none of the others.
RESULT_DIR = "/res/"
SKIPPED_DIRS = ("split", "logs", "hashes")


def is_result_file(path: Column) -> Column:
    folder = F.regexp_replace(path, r"[^/]*\z", "")
    cond = F.contains(folder, F.lit(RESULT_DIR))
    for name in SKIPPED_DIRS:
        cond = cond & ~F.contains(folder, F.lit(name))
    return cond


def read_enriched(
    spark: SparkSession, path, mode: str = "FAILFAST", glob: str = "*.wet"
) -> DataFrame:
    """Typed rows plus file and cut. A malformed line ends the job by default.

    The test on the path needs file metadata only, so Spark prunes whole files.
    """
    raw = (
        spark.read.schema(ENRICHED_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("mode", mode)
        .json(path)
    )
    file = plain_path(F.col("_metadata.file_path"))
    return raw.where(is_result_file(file)).select(
        *ENRICHED_SCHEMA.names, base_name(file).alias("file"), cut_of(file).alias("cut")
    )
