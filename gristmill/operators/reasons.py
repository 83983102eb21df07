"""Ordered rules: the first one that holds names the reason for rejection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, Column]


def first_reason(rules: Iterable[Rule]) -> Column:
    """Name of the first rule whose condition is true, NULL when none is."""
    reason = None
    for name, cond in rules:
        reason = F.when(cond, name) if reason is None else reason.when(cond, name)
    return F.lit(None).cast("string") if reason is None else reason


def funnel(df: DataFrame, reason: str = "reason", kept: str = "kept") -> DataFrame:
    """Rows per reason; rows without one are counted as ``kept``.

    Counts are combined before the shuffle, so a reason that takes most of the
    rows sends one row per task.
    """
    return df.groupBy(F.coalesce(F.col(reason), F.lit(kept)).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )
