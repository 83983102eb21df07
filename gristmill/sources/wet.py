"""Plain-text web archives ("WET"): reader, record parser, writer.

Framing. Records start at a line ``WARC/1.0``. The text source cuts the stream
at ``WARC/1.0<newline>WARC-Type: ``, so one row is one record, however files are
split, and every row ends with its own line break, the last one of a file too.
Marker lines the separator does not meet (other newline style, surrounding
blanks, another header next) are inside a row and are split there.

Parsing is one generator per row: pieces become structs, unwanted ones are
dropped inside the generator, and nothing is evaluated twice by filters above it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.functions.paths import base_name, netloc, plain_path, without_gz
from gristmill.functions.text import (
    WHITESPACE,
    WS_CLASS,
    has_rare_blank,
    is_blank,
    let,
    lines,
    lstrip,
    rstrip,
    second_word,
    shorter_than,
    strip,
    unix_newlines,
)
from gristmill.sources.listing import path_exists
from gristmill.sources.staging import stage
from gristmill.sources.wet_records import read_wet_records

NEWLINES = {"crlf": "\r\n", "lf": "\n"}
ANY_NEWLINE = "any"
TYPE_FIELD = "WARC-Type: "
DOC_COLUMNS = (
    "url",
    "date_download",
    "digest",
    "length",
    "nlines",
    "source_domain",
    "title",
    "raw_content",
)
# Columns that order the records of one file.
ORDER = ("block_start", "row_id", "piece")
# Blank lines between records, as the writer leaves them.
RECORD_END = "\r\n\n"


def record_separator(newline: str = "crlf") -> str:
    return "WARC/1.0" + NEWLINES[newline] + TYPE_FIELD


def split_records(value: Column) -> Column:
    """Array of records inside one row of the text source.

    A record is its lines after the marker line, joined by line feeds. A row
    that holds the marker itself (the start of a file in another newline style)
    loses its first line; any other row continues right after the separator.
    The blank row before the first marker of a file gives no record.
    """
    text = let(
        unix_newlines(value),
        lambda t: F.when(
            F.startswith(lstrip(t), F.lit("WARC/")), F.regexp_replace(t, r"\A[^\n]*(?:\n|\z)", "")
        )
        .when(is_blank(t), F.lit(""))
        .otherwise(F.concat(F.lit(TYPE_FIELD), t)),
    )
    marker = rf"(?md)^[{WS_CLASS}&&[^\n]]*WARC/1\.0[{WS_CLASS}&&[^\n]]*(?:\n|\z)"
    pieces = let(
        text,
        lambda t: F.when(F.contains(t, F.lit("WARC/1.0")), F.split(t, marker)).otherwise(
            F.array(t)
        ),
    )
    return F.transform(F.filter(pieces, lambda p: ~is_blank(p)), without_last_newline)


def without_last_newline(record: Column) -> Column:
    """Drop the line break that ends a record (blanks after it belong to an indented marker)."""

    def cut(t: Column) -> Column:
        return F.substring(t, F.lit(1), F.length(t) - 1)

    newline = F.lit("\n")
    return F.when(F.endswith(record, newline), cut(record)).otherwise(
        let(
            F.rtrim(record, F.lit(WHITESPACE.replace("\n", ""))),
            lambda t: F.when(F.endswith(t, newline), cut(t)).otherwise(record),
        )
    )


def _named(header: Column, name: str) -> Column:
    """First header line with the given field name."""
    return F.get(F.filter(header, lambda h: F.startswith(h, F.lit(name + ":"))), F.lit(0))


def parse_record(record: Column, *, by_name: bool = False) -> Column:
    """Struct of one record: kind, bad, header_text and the document columns.

    Header fields are found by position, as archives write them; ``by_name``
    looks them up by field name instead. Fields of a record that lacks one of
    them, or that has no body, are NULL; ``length`` is 0 when it is no number.
    """

    def fields(stripped: Column) -> Column:
        return let(
            F.array_position(stripped, "").cast("int"),
            lambda blank: let(
                F.slice(stripped, 1, F.when(blank > 0, blank - 1).otherwise(F.size(stripped))),
                lambda header: let(
                    F.when(
                        (blank > 0) & (blank < F.size(stripped)),
                        F.slice(stripped, blank + 1, F.size(stripped)),
                    ),
                    # One look at all header lines tells whether blanks are plain.
                    lambda body: let(
                        has_rare_blank(F.array_join(header, " ")),
                        lambda rare: parsed(stripped, header, body, rare),
                    ),
                ),
            ),
        )

    def parsed(stripped: Column, header: Column, body: Column, rare: Column) -> Column:
        def at(i: int, name: str) -> Column:
            line = _named(header, name) if by_name else F.get(header, F.lit(i))
            return second_word(line, rare)

        kind = at(0, "WARC-Type")
        last = _named(header, "Content-Length") if by_name else F.element_at(header, -1)
        n = F.size(body)
        tail_blank = (n >= 2) & (F.get(body, n - 1) == "") & (F.get(body, n - 2) == "")
        # The title is the first line; two blank lines at the end separate records.
        n_content = F.greatest(n - 1 - F.when(tail_blank, 2).otherwise(0), F.lit(0))
        return let(
            F.slice(body, F.lit(2), n_content),
            lambda content: F.struct(
                kind.alias("kind"),
                at(1, "WARC-Target-URI").alias("url"),
                at(2, "WARC-Date").alias("date_download"),
                at(5, "WARC-Block-Digest").alias("digest"),
                F.coalesce(second_word(last, rare).try_cast("bigint"), F.lit(0)).alias("length"),
                F.size(content).alias("nlines"),
                F.get(body, F.lit(0)).alias("title"),
                F.array_join(content, "\n").alias("raw_content"),
                F.when(
                    ~F.equal_null(kind, F.lit("conversion")), F.array_join(stripped, "\n")
                ).alias("record_text"),
            ),
        )

    return let(F.transform(lines(record), strip), fields)


def is_document(r: Column) -> Column:
    """A record with every needed header field, a body, and type ``conversion``."""
    return (
        (r["kind"] == "conversion")
        & r["url"].isNotNull()
        & r["date_download"].isNotNull()
        & r["digest"].isNotNull()
        & r["raw_content"].isNotNull()
    )


def parse_documents(
    rows: DataFrame, value: str = "value", min_len: int = 1, by_name: bool = False
) -> DataFrame:
    """Documents out of rows of archive text; other columns are kept."""
    others = [c for c in rows.columns if c != value]

    def wanted(r: Column) -> Column:
        return is_document(r) & ~shorter_than(r["raw_content"], min_len)

    parsed = F.transform(split_records(F.col(value)), lambda p: parse_record(p, by_name=by_name))
    docs = rows.select(*others, F.explode(F.filter(parsed, wanted)).alias("_r"))
    return docs.select(
        *others,
        *[
            netloc(F.col("_r.url")).alias(c) if c == "source_domain" else F.col(f"_r.{c}")
            for c in DOC_COLUMNS
        ],
    )


def parse_records(rows: DataFrame, value: str = "value", by_name: bool = False) -> DataFrame:
    """Every non-blank record with its validity, for headers, statistics and quarantine.

    ``bad`` names a reason to distrust the file, ``is_doc`` marks documents,
    ``piece`` counts records inside a row. ``record_text`` holds the stripped lines
    of records of another type than documents.
    """
    others = [c for c in rows.columns if c != value]
    parsed = F.transform(split_records(F.col(value)), lambda p: parse_record(p, by_name=by_name))
    valid = F.call_function("is_valid_utf8", F.col(value))
    flat = rows.select(
        *others, valid.alias("_utf8"), F.posexplode(parsed).alias("piece", "_r")
    )
    doc = F.coalesce(is_document(F.col("_r")), F.lit(False))
    return flat.select(
        *others,
        "piece",
        F.col("_r.kind").alias("kind"),
        doc.alias("is_doc"),
        F.when(~F.col("_utf8"), "bad_utf8").alias("bad"),
        F.col("_r.record_text").alias("record_text"),
        *[
            netloc(F.col("_r.url")).alias(c) if c == "source_domain" else F.col(f"_r.{c}")
            for c in DOC_COLUMNS
        ],
    )


def parse_noted(rows: DataFrame, value: str = "value", numbered: bool = False) -> DataFrame:
    """Every non-blank record, and a note on rows that say something of their file.

    As ``parse_records``, with two columns more. ``note`` is NULL for records,
    ``bad_utf8`` for a row with bytes that are no UTF-8, and ``open`` for a blank row that
    opens a file: the first record of the file is in the row after it. ``leads`` marks
    the first record where the row that opens the file holds it. ``numbered`` rows are
    records from their marker on, with their number in the block.
    """
    others = [c for c in rows.columns if c != value]
    valid = F.call_function("is_valid_utf8", F.col(value))
    starts = F.col("block_start") == 0

    def noted(ps: Column) -> Column:
        def note(name: str) -> Column:
            # Out of bounds: a NULL of the record's type.
            record = F.get(ps, F.lit(-1)).alias("r")
            return F.struct(record, F.lit(0).alias("piece"), F.lit(name).alias("note"))

        records = F.transform(
            ps,
            lambda p, i: F.struct(
                p.alias("r"), i.alias("piece"), F.lit(None).cast("string").alias("note")
            ),
        )
        holds = (F.lit("bad_utf8"), ~valid), (F.lit("open"), starts & is_blank(F.col(value)))
        notes = F.filter(
            F.array(note("bad_utf8"), note("open")),
            lambda n: F.coalesce(*[F.when(n["note"] == name, test) for name, test in holds]),
        )
        return F.concat(records, notes)

    parsed = F.transform(split_records(F.col(value)), lambda p: parse_record(p))
    marked = starts & F.startswith(lstrip(F.col(value)), F.lit("WARC/"))
    if numbered:
        marked = marked & (F.col("row_id") == 0)
    flat = rows.select(*others, marked.alias("_marked"), F.explode(let(parsed, noted)).alias("_n"))
    doc = F.coalesce(is_document(F.col("_n.r")), F.lit(False))
    return flat.select(
        *others,
        F.col("_n.piece").alias("piece"),
        F.col("_n.note").alias("note"),
        (F.col("_marked") & (F.col("_n.piece") == 0)).alias("leads"),
        F.col("_n.r.kind").alias("kind"),
        doc.alias("is_doc"),
        F.col("_n.r.record_text").alias("record_text"),
        *[
            netloc(F.col("_n.r.url")).alias(c) if c == "source_domain" else F.col(f"_n.r.{c}")
            for c in DOC_COLUMNS
        ],
    )


def read_wet_rows(spark: SparkSession, path, newline: str = "crlf") -> DataFrame:
    """Raw rows (file, block_start, row_id, value) of all archives under ``path``.

    Gzip or plain goes by the suffix. (file, block_start, row_id) orders records. With
    ``newline="any"`` archives may end their lines either way, also within one file: they
    are read by ``wet_records``, in Python.
    """
    if newline == ANY_NEWLINE:
        paths = [path] if isinstance(path, str) else path
        plain = [re.sub(r"\\(.)", r"\1", p) for p in paths]  # undoes literal_path
        return read_wet_records(spark, plain).drop("cut")
    raw = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{gz,wet}")
        .option("lineSep", record_separator(newline))
        .text(path)
    )
    return raw.select(*row_columns())


def row_columns() -> list[Column]:
    return [
        plain_path(F.col("_metadata.file_path")).alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
        F.col("value"),
    ]


def read_wet(
    spark: SparkSession, path, min_len: int = 1, newline: str = "crlf", by_name: bool = False
) -> DataFrame:
    """Documents of all archives under ``path``: ``file`` and the document columns."""
    rows = read_wet_rows(spark, path, newline).select("file", "value")
    return parse_documents(rows, "value", min_len, by_name)


def file_headers(rows: DataFrame) -> DataFrame:
    """First record of each file as (file, headers): all stripped lines before the second.

    Only one candidate per task and file is shuffled.
    """
    first = F.transform(
        split_records(F.col("value")),
        lambda p: F.array_join(F.transform(lines(p), strip), "\n"),
    )
    order = F.struct("block_start", "row_id")
    return (
        rows.select("file", order.alias("o"), F.get(first, F.lit(0)).alias("t"))
        .where("t IS NOT NULL")
        .groupBy("file")
        .agg(F.min_by("t", "o").alias("t"))
        .select("file", F.split(F.concat(F.lit("WARC/1.0\n"), "t"), "\n").alias("headers"))
    )


def parse_stats(records: DataFrame, min_len: int = 1, by: str | None = None) -> DataFrame:
    """Parsed and kept documents with their ratio, in all or per ``by`` column."""
    docs = records.where("is_doc")
    kept = F.count_if(F.length("raw_content") >= min_len)
    stats = (docs.groupBy(by) if by else docs.groupBy()).agg(
        F.count(F.lit(1)).alias("n_docs"), kept.alias("n_kept")
    )
    return stats.withColumn("kept_ratio", F.try_divide("n_kept", "n_docs"))


def bad_files(rows: DataFrame) -> DataFrame:
    """Files with bytes that are no UTF-8, as (file, reason, n_bad), from raw rows of archives.

    Only bytes are looked at: no record is parsed.
    """
    broken = ~F.call_function("is_valid_utf8", F.col("value"))
    return (
        rows.where(broken)
        .groupBy("file")
        .agg(F.lit("bad_utf8").alias("reason"), F.count(F.lit(1)).alias("n_bad"))
    )


def quarantine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split raw rows in those of sound files and the list of failed files.

    The list is staged: its size is then known, so the planner broadcasts a
    short one and joins a long one. Records are parsed afterwards, of sound files only.
    """
    failed = stage(bad_files(rows), "failed")
    return rows.join(failed.select("file"), "file", "left_anti"), failed


def to_wet_text(
    url="url",
    date="date_download",
    digest="digest",
    length="length",
    title="title",
    content="raw_content",
) -> Column:
    """One document as archive text, without the blank lines that follow it.

    Identifiers are fresh; the digest is written with one ``sha1:`` prefix.
    """
    return F.concat(
        F.concat_ws(
            "\r\n",
            F.lit("WARC/1.0"),
            F.lit("WARC-Type: conversion"),
            F.concat(F.lit("WARC-Target-URI: "), F.col(url)),
            F.concat(F.lit("WARC-Date: "), F.col(date)),
            F.concat(F.lit("WARC-Record-ID: <urn:uuid:"), F.uuid(), F.lit(">")),
            F.concat(F.lit("WARC-Refers-To: <urn:uuid:"), F.uuid(), F.lit(">")),
            F.concat(
                F.lit("WARC-Block-Digest: sha1:"), F.regexp_replace(F.col(digest), "^(sha1:)+", "")
            ),
            F.lit("Content-Type: text/plain"),
            F.concat(F.lit("Content-Length: "), F.col(length).cast("string")),
            F.lit(""),
            rstrip(F.col(title)),
            rstrip(F.col(content)),
        ),
        F.lit("\r\n"),
    )


def header_text(record_text="record_text") -> Column:
    """The file header as archive text: marker line, then the stripped lines."""
    body = F.replace(rstrip(F.col(record_text)), F.lit("\n"), F.lit("\r\n"))
    return F.concat(F.lit("WARC/1.0\r\n"), body, F.lit("\r\n"))


def output_name(file: Column) -> Column:
    """Name of the cleaned archive: base name without ``.gz``."""
    return without_gz(base_name(file))


#: Folders of a staged write: archive text, and what else was found of the files.
TEXT_PART, NOTE_PART = "text", "note"
NOTE = "file string, archive string, row_id long, piece int, note string, leads boolean, text string"


def note_json(record_text="record_text") -> Column:
    """What a note or the first record of a block says, as one line."""
    return F.to_json(
        F.struct(
            "file",
            output_name(F.col("file")).alias("archive"),
            "row_id",
            "piece",
            "note",
            "leads",
            F.col(record_text).alias("text"),
        )
    )


def staged_notes(spark: SparkSession, folder: str) -> DataFrame:
    """The notes of a staged write, with the columns of ``NOTE``."""
    path = f"{folder}/part={NOTE_PART}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], NOTE)
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", RECORD_END).text(path)
    return lines.select(F.from_json("value", NOTE).alias("n")).select("n.*")


def noted_headers(notes: DataFrame) -> DataFrame:
    """(file, record_text) of files that start with a record of a type of its own.

    Such a record is the first of the row that opens the file, or of the next row of the
    same task if that is blank.
    """
    found = notes.where("note IS NULL")
    opens = notes.where("note = 'open'").select("file", (F.col("row_id") + 1).alias("row_id"))
    after = found.where("NOT leads AND piece = 0").join(opens, ["file", "row_id"], "left_semi")
    return found.where("leads").unionByName(after).select("file", F.col("text").alias("record_text"))


def publish(spark: SparkSession, folder: str, out: str, names: list[str]) -> None:
    """Move the staged text of the named archives to ``out``, one by one.

    What an archive has there is replaced; nothing of other archives is touched.
    """
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    target = new_path(out)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(target)
    for name in names:
        part = f"archive={escape(name)}"
        staged_at, place = new_path(f"{folder}/part={TEXT_PART}/{part}"), new_path(f"{out}/{part}")
        files.delete(place, True)
        if files.exists(staged_at) and not files.rename(staged_at, place):
            raise OSError(f"could not move {staged_at.toString()} to {place.toString()}")


def write_wet(df: DataFrame, out: str, mode: str = "append") -> None:
    """Write archives to ``out/archive=<name>/``, in record order within each task.

    With mode ``overwrite`` only the archives that ``df`` holds are replaced. A column
    ``part``, if there is one, makes folders ``part=<part>`` above those of the archives.

    ``df`` has file, the columns of ``ORDER`` and ``wet`` (archive text of a header or
    a document). Rows stay in the task that read them: no shuffle, and a hot archive
    is written by as many tasks as read it. The task that read the start of a file
    has its header record, so the header leads that part.
    """
    by = [*(["part"] if "part" in df.columns else []), "archive"]
    (
        df.withColumn("archive", output_name(F.col("file")))
        .select(*by, *ORDER, "wet")
        .sortWithinPartitions(*by, *ORDER)
        .select(*by, F.col("wet").alias("value"))
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .option("lineSep", RECORD_END)
        .option("compression", "gzip")
        .text(out)
    )
