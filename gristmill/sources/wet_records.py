"""A reader of archives that needs to know nothing of their line ends.

Spark's text source cuts at one separator, so it has to be told how an archive ends its
lines. This Python data source reads lines, whatever ends them, and starts a record at each
line ``WARC/1.0``, also in archives that mix both kinds. Plain files are read in byte
ranges: a record belongs to the range that its marker starts in. Packed files are one range
each. Rows are those of ``wet.read_wet_rows``: (file, block_start, row_id, value), with
``row_id`` the number of the record in its range, and all that reads those reads these.

A record is held in memory up to a bound; what is beyond is read, counted and left out.
``cut`` says how many bytes that were. Files are opened through Arrow's file systems, so
paths are local ones or of a store that Arrow knows by its scheme.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMAT = "wet_records"
SCHEMA = "file string, block_start long, row_id long, value binary, cut long"
#: Bytes of a range, of a record, and of the records sent at a time.
SPLIT_BYTES = 128 << 20
RECORD_BYTES = 64 << 20
BATCH_BYTES = 8 << 20


def _source():
    """The data source class: a closure, so that tasks need not import this package."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Range(InputPartition):
        def __init__(self, path: str, start: int, end: int | None):
            self.path, self.start, self.end = path, start, end

    def file_system(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))

    def files_under(path: str) -> list[tuple[str, int]]:
        """(path, size) of the archives under a path, in order; hidden ones are left out."""
        from pyarrow import fs

        system, inside = file_system(path)
        prefix = path[: len(path) - len(inside)] if path.endswith(inside) else ""
        info = system.get_file_info(inside)
        if info.type == fs.FileType.NotFound:
            raise FileNotFoundError(path)
        found = [info]
        if info.type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(inside, recursive=True))
            root = len(inside.rstrip("/")) + 1
            found = [
                f
                for f in found
                if f.is_file
                and f.path.endswith((".gz", ".wet"))
                and not any(part[:1] in "._" for part in f.path[root:].split("/"))
            ]
        return sorted((prefix + f.path, f.size) for f in found)

    def lines(part: Range):
        """(position, line) from the first line that starts in the range, to the file's end."""
        import gzip
        import io

        system, inside = file_system(part.path)
        if part.path.endswith(".gz"):
            stream = gzip.GzipFile(fileobj=system.open_input_stream(inside, compression=None))
            at = 0
        else:
            stream = system.open_input_file(inside)
            at = part.start
            if at:
                stream.seek(at - 1)
        with io.BufferedReader(stream, 1 << 20) as given:
            if at:
                at += len(given.readline()) - 1
            for line in given:
                yield at, line
                at += len(line)

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.paths = json.loads(options["paths"])
            self.split = int(options.get("split_bytes", SPLIT_BYTES))
            self.most = int(options.get("record_bytes", RECORD_BYTES))

        def partitions(self):
            ranges = []
            for path, size in (f for p in self.paths for f in files_under(p)):
                if path.endswith(".gz"):
                    ranges.append(Range(path, 0, None))
                else:
                    starts = range(0, max(size, 1), self.split)
                    ranges += [Range(path, s, min(s + self.split, size)) for s in starts]
            return ranges or [Range("", 0, 0)]

        def records(self, part: Range):
            """(number, bytes, bytes left out) of the records whose marker is in the range."""
            number, held, size, cut = -1, [], 0, 0
            for at, line in lines(part):
                if line.strip() == b"WARC/1.0":
                    if number >= 0:
                        yield number, b"".join(held), cut
                    if part.end is not None and at >= part.end:
                        return
                    number, held, size, cut = number + 1, [], 0, 0
                elif number < 0:
                    continue  # of the range before, or in front of the first record
                room = self.most - size
                held.append(line[:room] if room < len(line) else line)
                size += min(len(line), room)
                cut += max(0, len(line) - room)
            if number >= 0:
                yield number, b"".join(held), cut

        def read(self, part: Range):
            import pyarrow as pa

            if not part.path:
                return
            names = ("row_id", "value", "cut")
            kinds = (pa.int64(), pa.binary(), pa.int64())

            def batch(rows):
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                own = [pa.array([part.path] * len(rows)), pa.array([part.start] * len(rows), pa.int64())]
                return pa.RecordBatch.from_arrays([*own, *columns], ["file", "block_start", *names])

            rows, size = [], 0
            for row in self.records(part):
                rows.append(row)
                size += len(row[1])
                if size >= BATCH_BYTES:
                    yield batch(rows)
                    rows, size = [], 0
            if rows:
                yield batch(rows)

    class WetRecords(DataSource):
        @classmethod
        def name(cls):
            return FORMAT

        def schema(self):
            return SCHEMA

        def reader(self, schema):
            return Reader(self.options)

    return WetRecords


def read_wet_records(
    spark: SparkSession,
    paths: list[str] | str,
    split_bytes: int = SPLIT_BYTES,
    record_bytes: int = RECORD_BYTES,
) -> DataFrame:
    """Rows (file, block_start, row_id, value, cut) of all archives under the paths."""
    given = [paths] if isinstance(paths, str) else list(paths)
    spark.dataSource.register(_source())
    rows = (
        spark.read.format(FORMAT)
        .option("paths", json.dumps(given))
        .option("split_bytes", split_bytes)
        .option("record_bytes", record_bytes)
        .load()
    )
    # Bytes are kept as they are: what is no UTF-8 is for the quarantine to find.
    return rows.withColumn("value", F.col("value").cast("string"))
