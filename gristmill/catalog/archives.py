"""Archive text: writing, parsing, headers, quarantine, resume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.catalog.common import (
    DEMO_WORDS,
    WS,
    sql_clean,
    sql_paragraphs,
    sql_passage_reason,
    sql_strip,
    table,
)
from gristmill.functions.paths import base_name, cut_of, netloc, without_gz
from gristmill.operators.manifest import anti_landed
from gristmill.plans.coarse import FAILED_FOLDER, clean_rows, land_batch, run_coarse
from gristmill.sources.listing import list_archives, name_archives, path_exists
from gristmill.sources.staging import new_folder
from gristmill.sources import wet
from gristmill.streaming.incremental import clean_stream, land_new, stream_wet, write_new


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the fields of an archive record."""
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(
            F.lit("https://user@"), "source", F.lit(".example.org:8080/"), F.col("doc_id")
        ).alias("url"),
        F.lit("2023-02-05T10:20:30Z").alias("date_download"),
        F.concat(F.lit("sha1:"), F.upper(F.md5("text"))).alias("digest"),
        F.col("n_chars").alias("length"),
        F.concat(F.lit("Title "), F.col("doc_id"), F.lit("  ")).alias("title"),
        F.col("text").alias("raw_content"),
        "source",
        "lang",
    )


def _archive_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of archive text per document, framed as the text source frames it."""
    record = F.concat(wet.to_wet_text(), F.lit(wet.RECORD_END))
    return _documents(spark, sf_dir).select(
        "doc_id", F.col("source").alias("file"), "lang", "length", record.alias("value")
    )


def _spoiled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows, with a byte that is no UTF-8 at the end of very long texts."""
    spoiled = F.concat(F.col("value").cast("binary"), F.unhex(F.lit("FF0A"))).cast("string")
    value = F.when(F.col("length") > 20_000, spoiled).otherwise(F.col("value"))
    return _archive_rows(spark, sf_dir).select("file", value.alias("value"))


def _archive_folder(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "archives")
    _documents(spark, sf_dir).select(wet.to_wet_text().alias("value")).write.option(
        "lineSep", wet.RECORD_END
    ).option("compression", "gzip").text(folder)
    return folder


STRIPPED = f"""array_to_string(list_transform(string_split(rtrim(text, {WS}), chr(10)),
    lambda p: {sql_strip('p')}), chr(10))"""
PARSED = f"""SELECT 'https://user@' || source || '.example.org:8080/' || doc_id AS url,
    '2023-02-05T10:20:30Z' AS date_download, 'sha1:' || upper(md5(text)) AS digest,
    n_chars AS length, len(string_split({STRIPPED}, chr(10)))::INTEGER AS nlines,
    'user@' || source || '.example.org:8080' AS source_domain, 'Title ' || doc_id AS title,
    {STRIPPED} AS raw_content, doc_id, source, lang
  FROM documents WHERE {STRIPPED} <> ''"""


def wet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wet.parse_documents(_archive_rows(spark, sf_dir).select("doc_id", "value"), "value")


def wet_files_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Through gzip files on disk; records are found again by the reader."""
    return wet.read_wet(spark, _archive_folder(spark, sf_dir)).drop("file")


def wet_any_newline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of either line end, and archives that mix both, in one read."""
    folder = new_folder(spark, "newlines")
    docs = _documents(spark, sf_dir).select("doc_id", wet.to_wet_text().alias("value"))
    unix = F.regexp_replace("value", "\r\n", "\n")
    mixed = F.when(F.col("doc_id") % 2 == 0, unix).otherwise(F.col("value"))
    written = (("crlf", F.col("value"), "\r\n\r\n"), ("lf", unix, "\n\n"), ("mixed", mixed, "\r\n\n"))
    for i, (name, value, end) in enumerate(written):
        part = docs.where(F.col("doc_id") % 3 == i).select(value.alias("value"))
        part.write.option("lineSep", end).option("compression", "gzip").text(f"{folder}/{name}")
    return wet.read_wet(spark, folder, newline=wet.ANY_NEWLINE).drop("file")


def wet_inner_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A marker line inside a body ends the record there."""
    rows = _archive_rows(spark, sf_dir).select(
        "doc_id", F.regexp_replace("value", r"\.\n", ".\n WARC/1.0 \n").alias("value")
    )
    return wet.parse_documents(rows, "value").select("doc_id", "title", "nlines", "raw_content")


def wet_parse_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed and kept documents per file, for a length limit."""
    records = wet.parse_records(_archive_rows(spark, sf_dir).select("file", "value"))
    stats = wet.parse_stats(records, min_len=1000, by="file")
    return stats.withColumn("kept_ratio", F.round("kept_ratio", 6))


def wet_bad_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with broken headers: type changed, date cut, length no number."""
    lang = F.col("lang")
    value = (
        F.when(lang == "fr", F.replace("value", F.lit("Type: conversion"), F.lit("Type: response")))
        .when(lang == "de", F.replace("value", F.lit("WARC-Date: 2023"), F.lit("WARC-Date:2023")))
        .when(lang == "es", F.replace("value", F.lit("Content-Length: "), F.lit("Content-Length: x")))
        .otherwise(F.col("value"))
    )
    rows = _archive_rows(spark, sf_dir).select("doc_id", value.alias("value"))
    return wet.parse_documents(rows, "value").select("doc_id", "date_download", "length")


def wet_file_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First record of every file, as header lines joined again."""
    rows = _archive_rows(spark, sf_dir).select(
        "file",
        F.lit(0).alias("block_start"),
        F.col("doc_id").alias("row_id"),
        F.regexp_replace("value", r"urn:uuid:[0-9a-f-]*", "urn:uuid:0").alias("value"),
    )
    heads = wet.file_headers(rows)
    # Blank lines between records end the last line of a head; they are cut on both sides.
    head = F.rtrim(F.array_join("headers", "|"), F.lit("|"))
    return heads.select("file", head.alias("head"))


def wet_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per sound file; a file with one unreadable byte is withheld."""
    good, _ = wet.quarantine(_spoiled_rows(spark, sf_dir))
    return wet.parse_records(good).where("is_doc").groupBy("file").agg(F.count(F.lit(1)).alias("n_docs"))


def wet_failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wet.bad_files(_spoiled_rows(spark, sf_dir))


def wet_to_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive text to cleaned documents in one narrow stage."""
    docs = wet.parse_documents(_archive_rows(spark, sf_dir).select("doc_id", "value"), "value")
    return clean_rows(docs.select("doc_id", "raw_content"), DEMO_WORDS).select(
        "doc_id", "n_kept", F.col("raw_content").alias("text")
    )


def coarse_run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole first stage on files: read, clean, write, read back."""
    out = new_folder(spark, "cleaned")
    run_coarse(spark, _archive_folder(spark, sf_dir), out, DEMO_WORDS)
    return wet.read_wet(spark, out).select("url", "title", "length", "raw_content")


#: Archives that documents are dealt to by their id.
BUCKETS = 4


#: Partitions that buckets are dealt to by hash; enough that each has one of its own.
BUCKET_TASKS = 64


def _bucket_archives(spark: SparkSession, sf_dir: str) -> str:
    """An archive for each bucket of ids. Each starts with a record of type ``metadata``;
    in the last bucket, very long texts end with a byte that is no UTF-8.

    A bucket is one file, and one task writes it; all are written at the same time, and
    plain, so that many tasks read each.
    """
    folder = new_folder(spark, "buckets")
    spoiled = F.concat(wet.to_wet_text().cast("binary"), F.unhex(F.lit("FF0A"))).cast("string")
    last = F.col("bucket") == BUCKETS - 1
    text = F.when(last & (F.col("length") > 20_000), spoiled).otherwise(wet.to_wet_text())
    docs = _documents(spark, sf_dir).withColumn("bucket", F.col("doc_id") % BUCKETS)
    start = F.lit("WARC/1.0\r\nWARC-Type: metadata\r\nWARC-Target-URI: bucket:")
    leads = spark.range(BUCKETS).select(
        F.col("id").alias("bucket"),
        F.lit(-1).cast("long").alias("doc_id"),
        F.concat(start, F.col("id").cast("string"), F.lit("\r\n\r\nnote\r\n")).alias("value"),
    )
    rows = docs.where(F.col("bucket") >= 0).select("bucket", "doc_id", text.alias("value"))
    (
        rows.unionByName(leads)
        .repartition(BUCKET_TASKS, "bucket")
        .sortWithinPartitions("bucket", "doc_id")
        .select("bucket", "value")
        .write.partitionBy("bucket")
        .option("lineSep", wet.RECORD_END)
        .text(folder)
    )
    name_archives(spark, folder)
    return folder


def coarse_other_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First records of archives that start with another type, out of the cleaned archives."""
    out = new_folder(spark, "cleaned")
    run_coarse(spark, _bucket_archives(spark, sf_dir), out, DEMO_WORDS)
    heads = wet.file_headers(wet.read_wet_rows(spark, out))
    head = F.rtrim(F.array_join("headers", "|"), F.lit("|"))
    return heads.where("headers[1] = 'WARC-Type: metadata'").select(head.alias("head"))


def coarse_failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run publishes of each bucket, or why it withholds the bucket's archive."""
    given, out = _bucket_archives(spark, sf_dir), new_folder(spark, "cleaned")
    run_coarse(spark, given, out, DEMO_WORDS)
    bucket = F.regexp_extract("url", r"(\d+)$", 1).cast("long") % BUCKETS
    sound = wet.read_wet(spark, out).groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.lit("published").alias("state")
    )
    listed = F.regexp_extract("file", r"/bucket=(\d+)/", 1).cast("long").alias("bucket")
    schema = "file string, reason string, n_bad long"
    if not path_exists(spark, f"{out}/{FAILED_FOLDER}"):
        return sound
    failed = spark.read.schema(schema).json(f"{out}/{FAILED_FOLDER}")
    return sound.unionByName(
        failed.select(listed, F.col("n_bad").alias("n"), F.col("reason").alias("state"))
    )


def incremental_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first stage as a file stream that takes what is there and stops."""
    out, state = new_folder(spark, "stream-out"), new_folder(spark, "stream-state")
    docs = stream_wet(spark, _archive_folder(spark, sf_dir)).select("url", "raw_content")
    write_new(clean_stream(docs, DEMO_WORDS), out, state).awaitTermination()
    return spark.read.schema("url string, n_kept int, raw_content string").parquet(out)


def coarse_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over part of the files, then one over all: every document lands once."""
    data, out = _archive_folder(spark, sf_dir), new_folder(spark, "resumed")
    first = sorted(r["path"] for r in list_archives(spark, data).collect())[::2]
    land_batch(spark, first, out, DEMO_WORDS)
    run_coarse(spark, data, out, DEMO_WORDS)
    run_coarse(spark, data, out, DEMO_WORDS)
    return wet.read_wet(spark, out).select("url", "title", "length", "raw_content")


def incremental_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stream through the batch stage, twice: each archive once, with its ledger."""
    out, state = new_folder(spark, "landed"), new_folder(spark, "state")
    given = _archive_folder(spark, sf_dir)
    for _ in range(2):
        land_new(spark, given, out, state, DEMO_WORDS).awaitTermination()
    return wet.read_wet(spark, out).select("url", "title", "length", "raw_content")


def url_netloc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", netloc(F.col("url")).alias("netloc"))


def _page_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive-like paths out of page urls."""
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.concat(
            F.lit("data/res/"),
            F.split_part(F.col("url"), F.lit("/"), F.lit(3)),
            F.lit("/seg/"),
            F.col("page_id"),
            F.lit(".warc.wet.gz"),
        ).alias("path"),
    )


PAGE_PATHS = """(SELECT page_id, 'data/res/' || split_part(url, '/', 3) || '/seg/' || page_id
    || '.warc.wet.gz' AS path FROM pages) AS p"""


def cut_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    return _page_paths(spark, sf_dir).select(
        "page_id", cut_of(path).alias("cut"), without_gz(base_name(path)).alias("file")
    )


def landed_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths not landed; landed files carry the name with or without ``.gz``."""
    paths = _page_paths(spark, sf_dir)
    path, name = F.col("path"), base_name(F.col("path"))
    landed = paths.select(
        F.when(F.contains(path, F.lit(".com/")), F.concat(F.lit("out/"), name))
        .when(F.contains(path, F.lit(".net/")), F.concat(F.lit("out/"), without_gz(name)))
        .otherwise(F.concat(F.lit("out/other-"), name))
        .alias("path")
    )
    return anti_landed(paths, landed)


QUERIES = {
    "wet_roundtrip": wet_roundtrip,
    "wet_files_roundtrip": wet_files_roundtrip,
    "wet_any_newline": wet_any_newline,
    "wet_inner_marker": wet_inner_marker,
    "wet_parse_stats": wet_parse_stats,
    "wet_bad_headers": wet_bad_headers,
    "wet_file_headers": wet_file_headers,
    "wet_quarantine": wet_quarantine,
    "wet_failed_files": wet_failed_files,
    "wet_to_clean": wet_to_clean,
    "coarse_run_files": coarse_run_files,
    "coarse_other_headers": coarse_other_headers,
    "coarse_failed_files": coarse_failed_files,
    "coarse_resume": coarse_resume,
    "incremental_quarantine": incremental_quarantine,
    "incremental_clean": incremental_clean,
    "url_netloc": url_netloc,
    "cut_names": cut_names,
    "landed_anti_join": landed_anti_join,
}

DOC_FIELDS = "url, date_download, digest, length, nlines, source_domain, title, raw_content"
TAGGED = f"(SELECT *, {sql_paragraphs('raw_content')} AS ps FROM ({PARSED}) AS a) AS t"
KEPT = f"(SELECT * FROM {TAGGED} WHERE {sql_passage_reason('raw_content')} IS NULL) AS s"
CLEAN = sql_clean(KEPT, "doc_id, url, title, length", "raw_content")
# Cleaned text as the archive keeps it: right-stripped, every line stripped.
REREAD = f"""array_to_string(list_transform(string_split(rtrim(raw_content, {WS}), chr(10)),
    lambda p: {sql_strip('p')}), chr(10))"""
# Body up to the first line that ends with a full stop, if another line follows.
FIRST_PART = f"""CASE WHEN contains(rtrim(text, {WS}), '.' || chr(10))
    THEN split_part(text, '.' || chr(10), 1) || '.' ELSE rtrim(text, {WS}) END"""

SQL = {
    "wet_roundtrip": f"SELECT doc_id, {DOC_FIELDS} FROM ({PARSED}) AS a",
    "wet_files_roundtrip": f"SELECT {DOC_FIELDS} FROM ({PARSED}) AS a",
    "wet_any_newline": f"SELECT {DOC_FIELDS} FROM ({PARSED}) AS a",
    "wet_inner_marker": f"""SELECT doc_id, 'Title ' || doc_id AS title,
        len(string_split(body, chr(10)))::INTEGER AS nlines, body AS raw_content
        FROM (SELECT doc_id, array_to_string(list_transform(string_split({FIRST_PART}, chr(10)),
                lambda p: {sql_strip('p')}), chr(10)) AS body FROM documents) AS b
        WHERE body <> ''""",
    "wet_parse_stats": f"""SELECT source AS file, count(*) AS n_docs,
        count(*) FILTER (length(raw_content) >= 1000) AS n_kept,
        round(count(*) FILTER (length(raw_content) >= 1000) / count(*), 6) AS kept_ratio
        FROM (SELECT * FROM ({PARSED}) AS a) AS b GROUP BY source""",
    "wet_bad_headers": f"""SELECT doc_id, date_download,
        CASE WHEN lang = 'es' THEN 0 ELSE length END AS length
        FROM ({PARSED}) AS a WHERE lang NOT IN ('fr', 'de')""",
    "wet_file_headers": f"""SELECT source AS file, rtrim(concat_ws('|', 'WARC/1.0',
        'WARC-Type: conversion', 'WARC-Target-URI: https://user@' || source || '.example.org:8080/' || doc_id,
        'WARC-Date: 2023-02-05T10:20:30Z', 'WARC-Record-ID: <urn:uuid:0>', 'WARC-Refers-To: <urn:uuid:0>',
        'WARC-Block-Digest: sha1:' || upper(md5(text)), 'Content-Type: text/plain',
        'Content-Length: ' || n_chars, '', 'Title ' || doc_id,
        replace({STRIPPED}, chr(10), '|')), '|') AS head
        FROM documents JOIN (SELECT source, min(doc_id) AS doc_id FROM documents GROUP BY source) AS m
        USING (source, doc_id)""",
    "wet_quarantine": f"""SELECT source AS file, count(*) AS n_docs FROM ({PARSED}) AS a
        WHERE source NOT IN (SELECT source FROM documents WHERE n_chars > 20000) GROUP BY source""",
    "wet_failed_files": """SELECT source AS file, 'bad_utf8' AS reason, count(*) AS n_bad
        FROM documents WHERE n_chars > 20000 GROUP BY source""",
    "wet_to_clean": f"SELECT doc_id, n_kept, raw_content AS text FROM ({CLEAN}) AS c",
    "coarse_run_files": f"""SELECT url, title, length, {REREAD} AS raw_content FROM ({CLEAN}) AS c""",
    "coarse_other_headers": f"""SELECT DISTINCT concat_ws('|', 'WARC/1.0', 'WARC-Type: metadata',
        'WARC-Target-URI: bucket:' || doc_id % {BUCKETS}, '', 'note') AS head FROM documents
        WHERE doc_id % {BUCKETS} <> {BUCKETS - 1} OR NOT EXISTS (SELECT 1 FROM documents
          WHERE n_chars > 20000 AND doc_id % {BUCKETS} = {BUCKETS - 1})""",
    "coarse_failed_files": f"""WITH bad AS (SELECT count(*) AS n FROM documents
          WHERE n_chars > 20000 AND doc_id % {BUCKETS} = {BUCKETS - 1})
        SELECT doc_id % {BUCKETS} AS bucket, count(*) AS n, 'published' AS state FROM ({CLEAN}) AS c
        WHERE doc_id % {BUCKETS} <> {BUCKETS - 1} OR (SELECT n FROM bad) = 0 GROUP BY doc_id % {BUCKETS}
        UNION ALL SELECT {BUCKETS - 1}, n, 'bad_utf8' FROM bad WHERE n > 0""",
    "incremental_clean": f"SELECT url, n_kept, raw_content FROM ({CLEAN}) AS c",
    "url_netloc": """SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)
        AS netloc FROM pages""",
    "cut_names": f"""SELECT page_id, split_part(path, '/', 3) AS cut,
        page_id || '.warc.wet' AS file FROM {PAGE_PATHS}""",
    "landed_anti_join": f"""SELECT page_id, path FROM {PAGE_PATHS}
        WHERE NOT contains(path, '.com/') AND NOT contains(path, '.net/')""",
}
SQL["coarse_resume"] = SQL["incremental_quarantine"] = SQL["coarse_run_files"]
