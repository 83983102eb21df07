"""Clean new archives as they arrive, each file once.

The file stream source keeps the list of files it has seen in its checkpoint.
Records are self-contained rows, so cleaning needs no state and no watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gristmill.operators.lexicon import settled
from gristmill.operators.paragraphs import ParagraphRules
from gristmill.operators.passage import PassageRules
from gristmill.plans.coarse import clean_rows, land_batch
from gristmill.sources.wet import parse_documents, record_separator


def stream_wet(
    spark: SparkSession, path: str, newline: str = "crlf", files_per_batch: int = 1_000
) -> DataFrame:
    """Streaming form of the archive reader."""
    raw = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{gz,wet}")
        .option("lineSep", record_separator(newline))
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )
    return parse_documents(raw.select(F.col("_metadata.file_path").alias("file"), "value"))


def clean_stream(
    docs: DataFrame,
    words: Sequence[str] | DataFrame = (),
    passage: PassageRules = PassageRules(),
    paragraph: ParagraphRules = ParagraphRules(),
    text: str = "raw_content",
) -> DataFrame:
    return clean_rows(docs, words, passage, paragraph, text)


def write_new(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet") -> StreamingQuery:
    """Process what is there now, in bounded batches, then stop."""
    return (
        df.writeStream.format(fmt)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def land_new(
    spark: SparkSession,
    path: str,
    out: str,
    checkpoint: str,
    words: Sequence[str] | DataFrame = (),
    passage: PassageRules = PassageRules(),
    paragraph: ParagraphRules = ParagraphRules(),
    newline: str = "crlf",
    min_len: int = 1,
    files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Archives that have arrived, through the batch stage: same quarantine, ledger and output.

    The stream carries paths only; a broken archive is listed as failed and the others
    of its batch land. A batch that is repeated after a failure replaces what it left.
    """
    words = settled(words)
    paths = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{gz,wet}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
        .select("path")
    )

    def land(batch: DataFrame, _: int) -> None:
        names = sorted(r["path"] for r in batch.collect())
        if names:
            land_batch(spark, names, out, words, passage, paragraph, newline, min_len)

    return (
        paths.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
