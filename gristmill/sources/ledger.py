"""Ledger of the inputs whose output is complete: a version per commit, compacted.

Each commit is a folder of its own beside the output, ``_landed/delta-<version>``, that
appears under its name at once, by a rename. After ``COMPACT_EVERY`` of them the next
commit leaves ``base-<version>`` as well, with all names up to there. A listing reads the
newest base and the commits after it, in one read; what an older base needs is deleted
when a newer one has been there for a round.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.sources.listing import path_exists

LEDGER = "_landed"
COMPACT_EVERY = 16
SCHEMA = "path string, commit string"
#: Writers that may take the same version at the same time before one gives up.
TRIES = 20

_ENTRY = re.compile(r"(base|delta)-(\d{9})\Z")


def _folder(out: str) -> str:
    return f"{out.rstrip('/')}/{LEDGER}"


def versions(spark: SparkSession, out: str) -> list[tuple[int, str]]:
    """(version, kind) of all entries, ascending; kind is ``base`` or ``delta``."""
    folder = _folder(out)
    if not path_exists(spark, folder):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(target)]
    found = [_ENTRY.match(name) for name in names]
    return sorted((int(m[2]), m[1]) for m in found if m)


def _name(version: int, kind: str) -> str:
    return f"{kind}-{version:09d}"


def live(found: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The newest base, if there is one, and the commits after it."""
    base = max((v for v, kind in found if kind == "base"), default=0)
    return [(v, k) for v, k in found if (v, k) == (base, "base") or (k == "delta" and v > base)]


def entries(spark: SparkSession, out: str) -> DataFrame:
    """(path, commit) of the inputs whose output is complete; none before the first commit."""
    folders = [f"{_folder(out)}/{_name(*entry)}" for entry in live(versions(spark, out))]
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(folders)


def landed(spark: SparkSession, out: str) -> DataFrame:
    """Names of the inputs whose output is complete, as ``path``."""
    return entries(spark, out).select("path").distinct()


def commits(spark: SparkSession, out: str) -> DataFrame:
    """Names of the commits whose rows are complete, as ``commit``."""
    return entries(spark, out).select("commit").where("commit IS NOT NULL").distinct()


def _commit(spark: SparkSession, names: DataFrame, out: str, entry: str) -> bool:
    """Write an entry aside and rename it; False if there is one of that name."""
    aside = f"{_folder(out)}/_{uuid.uuid4().hex}"
    names.select("path", "commit").write.json(aside)
    new_path = spark._jvm.org.apache.hadoop.fs.Path
    source, target = new_path(aside), new_path(f"{_folder(out)}/{entry}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    # A rename to a folder that is there would move the entry into it.
    if not files.exists(target) and files.rename(source, target):
        return True
    files.delete(source, True)
    return False


def mark_landed(names: DataFrame, out: str, commit: str | None = None) -> int:
    """Enter names (path) after their output is written; returns the version of the entry.

    ``commit`` is what tells the rows of this output, where they have a column for it. An
    input that is not entered is worked on again.
    """
    spark = names.sparkSession
    names = names.withColumn("commit", F.lit(commit).cast("string"))
    for _ in range(TRIES):
        version = max((v for v, _ in versions(spark, out)), default=0) + 1
        if _commit(spark, names, out, _name(version, "delta")):
            break
    else:
        raise RuntimeError(f"no version of {_folder(out)} was free")
    now = versions(spark, out)
    if sum(kind == "delta" for _, kind in live(now)) >= COMPACT_EVERY:
        compact(spark, out)
    return version


def compact(spark: SparkSession, out: str) -> None:
    """Write all names up to the newest commit as one base, and drop what no reader needs.

    Entries that the base before the new one still needs stay until the next round, for
    listings that have begun.
    """
    found = versions(spark, out)
    newest = max((v for v, kind in found if kind == "delta"), default=0)
    bases = [v for v, kind in found if kind == "base"]
    if not newest or newest in bases:
        return
    if not _commit(spark, entries(spark, out).distinct(), out, _name(newest, "base")):
        return
    keep_from = max(bases, default=0)
    files_of = spark._jvm.org.apache.hadoop.fs.Path
    for version, kind in found:
        if version < keep_from or (kind == "delta" and version <= keep_from):
            target = files_of(f"{_folder(out)}/{_name(version, kind)}")
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
