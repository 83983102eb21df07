"""Pieces shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FOLDS = 5
T = TypeVar("T")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    """True for the fold that no model may learn from; a NULL id is not held out."""
    return F.coalesce(fold(doc_id) == 0, F.lit(False))


def give_back() -> None:
    """Hand memory this process has freed back to the system, where its allocators can."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def freed(batches: Iterator[T]) -> Iterator[T]:
    """The batches of a task. Before the first, and after the last, unused memory goes back.

    Worker processes live on from task to task and from stage to stage; what they have
    freed, but keep, would count against the executors' memory of later stages.
    """
    give_back()
    yield from batches
    give_back()
