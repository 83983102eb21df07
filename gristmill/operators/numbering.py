"""Global row numbers without sorting everything in one task.

A window without ``partitionBy`` sends the whole table to one task. Here rows
are numbered inside ordered buckets, and each bucket is shifted by the number of
rows in the buckets before it; only bucket sizes pass through a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_rows(
    df: DataFrame,
    bucket: Column,
    order: Sequence[Column],
    name: str = "pos",
    total: str | None = None,
) -> DataFrame:
    """Add 0-based positions in the order (bucket, order).

    ``bucket`` has to be a prefix of the order that splits the rows finely;
    ``order`` should leave no ties. ``total`` optionally adds the row count.
    """
    b = df.withColumn("_bucket", bucket)
    sizes = b.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    # One row per bucket: small, so this window may run in one task.
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    starts = sizes.select(
        "_bucket",
        F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
        F.sum("_size").over(everything).alias("_total"),
    )
    inside = Window.partitionBy("_bucket").orderBy(*order)
    numbered = (
        b.withColumn("_rn", F.row_number().over(inside))
        .join(starts, "_bucket")
        .withColumn(name, F.col("_start") + F.col("_rn") - 1)
    )
    if total:
        numbered = numbered.withColumnRenamed("_total", total)
    return numbered.drop("_bucket", "_rn", "_start", "_total")


def renumber(
    df: DataFrame, pos: str = "pos", width: int = 65_536, total: str | None = None
) -> DataFrame:
    """Close the gaps in unique positions; a bucket holds at most ``width`` rows."""
    closed = number_rows(
        df.withColumnRenamed(pos, "_old_pos"),
        F.floor(F.col("_old_pos") / width),
        [F.col("_old_pos")],
        pos,
        total,
    )
    return closed.drop("_old_pos")
