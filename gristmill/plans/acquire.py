"""Which archives to fetch, in which batch and by which worker."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from gristmill.operators.manifest import (
    BATCH_STEP,
    EXCLUDED_DUMPS,
    SHUFFLE_SEED,
    anti_landed,
    assign_splits,
    batch_manifest,
    exclude_substrings,
    seeded_shuffle,
)


def shuffled_manifest(
    manifest: DataFrame, excluded: Sequence[str] = EXCLUDED_DUMPS, seed: int = SHUFFLE_SEED
) -> DataFrame:
    """Leave out dumps, then shuffle; ``pos`` is the place after the shuffle."""
    kept = exclude_substrings(manifest, "path", excluded).withColumnRenamed("pos", "old_pos")
    return seeded_shuffle(kept, ["path", "old_pos"], seed).drop("old_pos")


def fetch_plan(
    shuffled: DataFrame,
    landed: DataFrame,
    start: int = 0,
    step: int = BATCH_STEP,
    k: int = 1,
    workers: int = 8,
) -> DataFrame:
    """Paths still to fetch from ``k`` batches, each with a batch and a worker number."""
    batches = batch_manifest(shuffled, start, step, k)
    return assign_splits(anti_landed(batches, landed), workers)
