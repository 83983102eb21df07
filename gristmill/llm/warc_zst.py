"""Web archives in Zstandard frames with a dictionary of their own.

An archive starts with a skippable frame that holds the dictionary (plain, or
compressed itself), then follows one frame per record. The writer trains the
dictionary on the first payloads of the archive; the reader loads it, decodes frame
by frame and validates headers and lengths.

Payloads that occur more than once are stored once: ``plan_records`` finds, with
combined counts before the shuffle and an ordinary join on digests, which page
answers for the others; a hot digest is split by adaptive execution, as a row of
its own page always finds just one partner.

Defined results: NULL html is an empty payload. Broken archives give rows whose
``error`` tells what is wrong; nothing is dropped silently. Repeated pages (same id)
count as pages of their own.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.staging import stage

# Fixed values of the format: skippable frame of the dictionary, frame magic.
DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Payloads under this size are never stored as revisits.
MIN_REVISIT = 1_000
#: An archive is closed after so many bytes of payload.
ARCHIVE_BYTES = 8_000_000
#: The dictionary is trained on so many bytes from the start of an archive.
SAMPLE_BYTES = 1_000_000
DICTIONARY_BYTES = 16_384
CHUNK = 65_536
DATE = "2000-01-01T00:00:00Z"

RECORD_SCHEMA = (
    "archive string, position long, record_type string, record_id string, target_uri string, "
    "refers_to_id string, payload_digest string, payload_length long, payload binary, error string"
)


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, n_bytes, refers_to) for every page."""
    payload = F.coalesce(F.encode(F.col(html), "utf-8"), F.lit(b""))
    rows = pages.select(
        F.col(key).alias("page_id"), F.col(url).alias("url"), payload.alias("payload")
    ).withColumns(
        {"digest": F.sha1("payload"), "n_bytes": F.octet_length("payload").cast("long")}
    )
    large = F.col("n_bytes") >= MIN_REVISIT
    twins = (
        rows.where(large)
        .groupBy("digest")
        .agg(F.max("page_id").alias("answer"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("join_key"), "answer")
    )
    # Rows that can have no partner get keys of their own, which spreads them.
    own = F.concat(F.lit("-"), F.coalesce(F.col("page_id").cast("string"), F.uuid()))
    joined = rows.withColumn("join_key", F.when(large, F.col("digest")).otherwise(own)).join(
        twins, "join_key", "left"
    )
    other = F.col("answer").isNotNull() & ~F.equal_null(F.col("answer"), F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload", "digest", "n_bytes", F.when(other, F.col("answer")).alias("refers_to")
    )


def record_id(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record; revisits carry headers only, with the length of what they stand for."""
    kept = payload if refers_to is None else b""
    sha1 = base64.b32encode(bytes.fromhex(digest)).decode()
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", record_id(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", " ".join((url or "").split())),
        ("WARC-Payload-Digest", f"sha1:{sha1}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html; charset=utf-8"),
        ("Content-Length", str(len(kept))),
    ]
    if refers_to is not None:
        headers[2:2] = [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in headers]
    return b"\r\n".join(lines) + b"\r\n\r\n" + kept + b"\r\n\r\n"


def archive_bytes(records: list[bytes], level: int = 3) -> bytes:
    """The skippable frame with the dictionary, then one frame for each record."""
    import zstandard

    samples, size = [], 0
    for r in records:
        if size >= SAMPLE_BYTES:
            break
        samples.append(r[: SAMPLE_BYTES - size])
        size += len(samples[-1])
    try:
        held = zstandard.train_dictionary(DICTIONARY_BYTES, samples)
        content = held.as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few or too small samples to train on
        content = b"".join(samples)[:DICTIONARY_BYTES]
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packed = zstandard.ZstdCompressor(level=level).compress(content)
    head = DICTIONARY_MAGIC.to_bytes(4, "little") + len(packed).to_bytes(4, "little") + packed
    held.precompute_compress(level=level)
    writer = zstandard.ZstdCompressor(level=level, dict_data=held, write_checksum=True)
    return head + b"".join([writer.compress(r) for r in records])


def write_archives(plan: DataFrame) -> DataFrame:
    """Rows of ``plan_records`` as archives (archive, content); rows stay in their task."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, n, records, size = TaskContext.get().partitionId(), 0, [], 0

        def closed():
            name = f"pages-{task:05d}-{n:05d}.warc.zst"
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([archive_bytes(records)], pa.binary())],
                ["archive", "content"],
            )

        for batch in batches:
            for values in zip(*batch.columns, strict=True):
                records.append(record(*[v.as_py() for v in values]))
                size += len(records[-1])
                if size >= ARCHIVE_BYTES:
                    yield closed()
                    n, records, size = n + 1, [], 0
        if records:
            yield closed()

    rows = plan.select("page_id", "url", "payload", "digest", "refers_to")
    return rows.mapInArrow(pack, "archive string, content binary")


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archive files under a path as (archive, content), read by Spark."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zst").load(path)
    return files.select(F.col("path").alias("archive"), "content")


def frames(content: bytes) -> Iterator[bytes]:
    """Decoded frames of an archive; the dictionary comes from the leading skippable frame."""
    import zstandard

    view, at, held = memoryview(content), 0, None
    if len(view) >= 8 and int.from_bytes(view[:4], "little") == DICTIONARY_MAGIC:
        size = int.from_bytes(view[4:8], "little")
        at = 8 + size
        if at > len(view):
            raise ValueError("dictionary frame is cut off")
        data = bytes(view[8:at])
        if int.from_bytes(data[:4], "little") == FRAME_MAGIC:
            data = zstandard.ZstdDecompressor().decompress(data)
        held = zstandard.ZstdCompressionDict(data)
    reader = zstandard.ZstdDecompressor(dict_data=held)
    while at < len(view):
        magic = int.from_bytes(view[at : at + 4], "little")
        if magic & 0xFFFFFFF0 == 0x184D2A50:  # any other skippable frame
            at += 8 + int.from_bytes(view[at + 4 : at + 8], "little")
            continue
        if magic != FRAME_MAGIC:
            raise ValueError(f"no frame at byte {at}")
        frame, out = reader.decompressobj(), []
        while not frame.eof:
            piece = view[at : at + CHUNK]
            if not len(piece):
                raise ValueError("last frame is cut off")
            out.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
        yield b"".join(out)


def parse(data: bytes) -> dict:
    """Fields of one record; raises ValueError where headers or lengths are not in order."""
    head, blank, rest = data.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not blank or not lines[0].startswith(b"WARC/1."):
        raise ValueError("no record header")
    headers: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.decode().partition(":")
        if not colon or not name.strip():
            raise ValueError("header line without a colon")
        headers[name.strip().lower()] = value.strip()
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length"} - headers.keys()
    if missing:
        raise ValueError(f"missing {', '.join(sorted(missing))}")
    length = headers["content-length"]
    if not length.isdigit() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise ValueError("length does not fit the record")
    payload = rest[:-4]
    digest = None
    if "warc-payload-digest" in headers:
        kind, _, value = headers["warc-payload-digest"].partition(":")
        if kind != "sha1":
            raise ValueError("digest is not sha1")
        digest = base64.b32decode(value).hex()
    kind = headers["warc-type"]
    if kind == "revisit" and "warc-refers-to" not in headers:
        raise ValueError("revisit without a target")
    told = headers.get("x-payload-length", str(len(payload)))
    if not told.isdigit() or (kind != "revisit" and int(told) != len(payload)):
        raise ValueError("payload length does not fit")
    return {
        "record_type": kind,
        "record_id": headers["warc-record-id"],
        "target_uri": headers.get("warc-target-uri"),
        "refers_to_id": headers.get("warc-refers-to"),
        "payload_digest": digest,
        "payload_length": int(told),
        "payload": payload,
    }


def checked(data: bytes) -> dict:
    """``parse``, and the digest of the payload where it is there."""
    import hashlib

    found = parse(data)
    if found["record_type"] == "response" and found["payload_digest"] is not None:
        if hashlib.sha1(found["payload"]).hexdigest() != found["payload_digest"]:
            raise ValueError("digest does not fit the payload")
    return found


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record of (archive, content); an error ends its archive or marks its record."""
    fields = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                (f, pa.binary() if f == "payload" else pa.int64() if f in ("position", "payload_length") else pa.string())
                for f in fields
            ]
        )
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, size = [], 0
                for row in archive_rows(name.as_py(), content.as_py() or b""):
                    rows.append(row)
                    size += len(row.get("payload") or b"")
                    if size >= ARCHIVE_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return archives.select("archive", "content").mapInArrow(unpack, RECORD_SCHEMA)


def archive_rows(name: str, content: bytes) -> Iterator[dict]:
    import zstandard

    position = 0
    try:
        for data in frames(content):
            row = {"archive": name, "position": position}
            try:
                row |= checked(data)
            except ValueError as err:
                row["error"] = str(err)
            yield row
            position += 1
    except (ValueError, zstandard.ZstdError) as err:
        yield {"archive": name, "position": position, "error": f"archive: {err}"}


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the archives to the shared folder once and read every record back."""
    return read_archives(stage(write_archives(plan_records(pages, key, url, html)), "archives"))
