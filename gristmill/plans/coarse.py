"""First stage: archives in, cleaned archives out.

Scan, generator, filters, projection and write form one stage without a shuffle. It
stages the text of each archive, and notes on files to withhold and on first records;
then sound archives are published one by one, and a ledger beside the output says which
have landed. A file that cannot be read ends the stage: it is found and left out.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, fields

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.paths import literal_path
from gristmill.operators.lexicon import BROADCAST_ENTRIES, settled
from gristmill.operators.paragraphs import ParagraphRules, clean_documents
from gristmill.operators.passage import PassageRules, keep_passages
from gristmill.sources.ledger import landed, mark_landed
from gristmill.sources.listing import list_archives, path_batches, path_exists, unreadable_files
from gristmill.sources.staging import discard, staged
from gristmill.sources.wet import (
    ANY_NEWLINE,
    NOTE_PART,
    ORDER,
    TEXT_PART,
    header_text,
    note_json,
    noted_headers,
    output_name,
    parse_noted,
    publish,
    read_wet_rows,
    staged_notes,
    to_wet_text,
    write_wet,
)

FAILED_FOLDER = "_failed"


@dataclass
class CoarseReport:
    n_files: int = 0
    n_failed: int = 0
    n_docs: int = 0
    n_parsed: int = 0


def clean_rows(
    docs: DataFrame,
    words: Sequence[str] | DataFrame = (),
    passage: PassageRules = PassageRules(),
    paragraph: ParagraphRules = ParagraphRules(),
    text: str = "raw_content",
    only=None,
    max_entries: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """Document rules, then paragraph cleaning; narrow."""
    kept = keep_passages(docs, text, words, passage, only=only, max_entries=max_entries)
    return clean_documents(kept, text, paragraph, only=only)


def coarse_rows(
    records: DataFrame,
    words: Sequence[str] | DataFrame = (),
    passage: PassageRules = PassageRules(),
    paragraph: ParagraphRules = ParagraphRules(),
    min_len: int = 1,
    max_entries: int = BROADCAST_ENTRIES,
) -> DataFrame:
    """Archive text of what stays, and notes: file, order columns, part, wet.

    Headers and notes pass the cleaning steps untouched, in the same scan and the same
    order as the documents around them. A record of another type in the first row of a
    block may be the first of its file, and is noted.
    """
    doc = F.col("is_doc") & (F.length("raw_content") >= min_len)
    noted = (F.col("block_start") == 0) & (F.col("piece") == 0) & F.col("record_text").isNotNull()
    role = (
        F.when(F.col("note").isNotNull(), "note")
        .when(doc, "doc")
        .when(F.col("kind") == "warcinfo", "header")
        .when(noted, "note")
    )
    flow = records.withColumn("role", role).where("role IS NOT NULL")
    cleaned = clean_rows(flow, words, passage, paragraph, only=F.col("role") == "doc", max_entries=max_entries)
    wet = (
        F.when(F.col("role") == "doc", to_wet_text())
        .when(F.col("role") == "header", header_text())
        .otherwise(note_json())
    )
    part = F.when(F.col("role") == "note", NOTE_PART).otherwise(TEXT_PART)
    return cleaned.select("file", *ORDER, part.alias("part"), wet.alias("wet"))


#: What Spark says of a file that ends early or is not what its name says.
BROKEN = re.compile("EOFException|ZipException|not in gzip format|invalid (stored|block|distance|code|bit)|end of ZLIB|FAILED_READ_FILE")


def stage_batch(
    spark: SparkSession, paths: list[str], folder: str, newline: str, clean
) -> tuple[Observation | None, list[str]]:
    """Stage the cleaned text and the notes of a batch, in one pass over its files.

    Returns the counts that were observed and the files that cannot be read. Only when
    the pass fails for such a file are the files looked at one by one, and the others
    staged anew; any other failure is raised.
    """
    unreadable: list[str] = []
    while True:
        good = [p for p in paths if p not in set(unreadable)]
        if not good:
            return None, unreadable
        seen = Observation()
        rows = read_wet_rows(spark, [literal_path(p) for p in good], newline)
        records = parse_noted(rows, numbered=newline == ANY_NEWLINE)
        try:
            write_wet(clean(records, seen), folder)
            return seen, unreadable
        except (PySparkException, Py4JJavaError) as err:
            if unreadable or not BROKEN.search(str(err)):
                raise
            unreadable = unreadable_files(spark, paths)
            if not unreadable:
                raise
            discard(spark, folder)


def _bare(path: str) -> str:
    return re.sub(r"^[a-z0-9]+:/*", "/", path)


def write_failed(spark: SparkSession, failed: list[tuple[str, str, int]], paths: list[str], out: str) -> None:
    """Bring the list of failed files up to date: one row per file, as its last try ended."""
    folder = f"{out.rstrip('/')}/{FAILED_FOLDER}"
    schema = "file string, reason string, n_bad bigint"
    if not path_exists(spark, folder):
        if failed:
            spark.createDataFrame(failed, schema).write.json(folder)
        return
    tried = spark.createDataFrame([(p,) for p in paths], "file string")
    others = spark.read.schema(schema).json(folder).join(tried, "file", "left_anti")
    with staged(others.unionByName(spark.createDataFrame(failed, schema)), "failed") as now:
        now.write.mode("overwrite").json(folder)


def land_batch(
    spark: SparkSession,
    paths: list[str],
    out: str,
    words: Sequence[str] | DataFrame = (),
    passage: PassageRules = PassageRules(),
    paragraph: ParagraphRules = ParagraphRules(),
    newline: str = "crlf",
    min_len: int = 1,
    max_entries: int = BROADCAST_ENTRIES,
) -> CoarseReport:
    """Clean some archives: withhold the broken ones, publish the rest, enter them as landed.

    Each archive is read once. Its text is staged beside the output and moved there when
    the whole batch is known; what the archive left there in a run that was broken off is
    replaced.
    """
    counts = F.col("is_doc"), F.col("is_doc") & (F.length("raw_content") >= min_len)

    def clean(records: DataFrame, seen: Observation) -> DataFrame:
        n_parsed, n_docs = (F.count_if(c) for c in counts)
        observed = records.observe(seen, n_parsed.alias("n_parsed"), n_docs.alias("n_docs"))
        return coarse_rows(observed, words, passage, paragraph, min_len, max_entries)

    folder = f"{out.rstrip('/')}/_staging-{uuid.uuid4().hex}"
    try:
        seen, unreadable = stage_batch(spark, paths, folder, newline, clean)
        notes = staged_notes(spark, folder)
        bad = {
            # Names of files are compared without their scheme, which readers spell differently.
            _bare(r["file"]): r["n"]
            for r in notes.where("note = 'bad_utf8'").groupBy("file").agg(F.count("*").alias("n")).collect()
        }
        read = [p for p in paths if p not in set(unreadable)]
        good = [p for p in read if _bare(p) not in bad]
        failed = [(p, "unreadable", 1) for p in unreadable]
        failed += [(p, "bad_utf8", bad[_bare(p)]) for p in read if _bare(p) in bad]
        report = CoarseReport(n_files=len(paths), n_failed=len(failed))
        if seen is not None:
            report.n_parsed, report.n_docs = seen.get["n_parsed"], seen.get["n_docs"]
        if good:
            heads = noted_headers(notes).select(
                "file",
                *[F.lit(0).alias(c) for c in ORDER],
                F.lit(TEXT_PART).alias("part"),
                header_text().alias("wet"),
            )
            if not heads.isEmpty():
                write_wet(heads, folder)
            names = spark.createDataFrame([(p,) for p in good], "file string")
            names = names.select(output_name(F.col("file")).alias("path"))
            publish(spark, folder, out, sorted({r["path"] for r in names.collect()}))
            mark_landed(names, out)
    finally:
        discard(spark, folder)
    withheld = [literal_path(p) for p in read if _bare(p) in bad]
    if withheld:  # their documents are not in the output, and not in the counts
        records = parse_noted(read_wet_rows(spark, withheld, newline))
        n_parsed, n_docs = records.agg(*[F.count_if(c) for c in counts]).first()
        report.n_parsed, report.n_docs = report.n_parsed - n_parsed, report.n_docs - n_docs
    write_failed(spark, failed, paths, out)
    return report


def run_coarse(
    spark: SparkSession,
    data: str,
    out: str,
    words: Sequence[str] | DataFrame = (),
    passage: PassageRules = PassageRules(),
    paragraph: ParagraphRules = ParagraphRules(),
    newline: str = "crlf",
    min_len: int = 1,
    batch_files: int = 10_000,
    max_entries: int = BROADCAST_ENTRIES,
) -> CoarseReport:
    """Clean every archive under ``data`` that has not landed under ``out`` yet.

    Works through the files in batches of bounded length; a run that was broken off
    goes on with the files that are not in the ledger. Files with bad text or a broken
    compression leave no output and are listed in ``out/_failed`` as JSON lines.
    """
    report = CoarseReport()
    words = settled(words, max_entries)
    files = list_archives(spark, data).withColumn("_name", output_name(F.col("path")))
    done = landed(spark, out).select(F.col("path").alias("_name"))
    for paths in path_batches(files.join(done, "_name", "left_anti"), batch_files):
        one = land_batch(
            spark, paths, out, words, passage, paragraph, newline, min_len, max_entries
        )
        for f in fields(CoarseReport):
            setattr(report, f.name, getattr(report, f.name) + getattr(one, f.name))
    return report
