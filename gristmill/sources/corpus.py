"""The final corpus: JSON lines partitioned by cut.

Rows that come in commits carry the name of theirs as a second partition, and the ledger
beside the corpus says which commits are complete. So a run that is broken off leaves
files that nobody reads, and the number of files goes with the bytes and the commits, not
with the number of input files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.ledger import LEDGER, commits
from gristmill.sources.listing import path_exists

COLUMNS = "source string, text string, language string, file string"


def write_corpus(df: DataFrame, out: str, fmt: str = "json", commit: str | None = None) -> None:
    """Write (source, text, language), and the file of a row if known, under ``cut=``.

    With ``commit`` rows go to a folder ``commit=`` of that name within their cut. Rows are
    written by the tasks that hold them, so a large cut is spread over many files.
    """
    known = [c for c in ("file",) if c in df.columns]
    rows = df.select("source", "text", "language", *known, "cut")
    keys = ["cut"]
    if commit is not None:
        rows, keys = rows.withColumn("commit", F.lit(commit)), ["cut", "commit"]
    rows.write.mode("append").partitionBy(*keys).format(fmt).save(out)


def read_corpus(spark: SparkSession, out: str, fmt: str = "json") -> DataFrame:
    """Read the corpus back, of commits the complete ones only.

    A filter on ``cut`` reads its directories only. ``file`` is NULL where it was not known.
    """
    rows = spark.read.schema(COLUMNS).format(fmt).load(out)
    if "commit" not in rows.columns:
        return rows
    if not path_exists(spark, f"{out.rstrip('/')}/{LEDGER}"):
        return rows.where(F.col("commit").isNull())
    return rows.join(commits(spark, out), "commit", "left_semi")
