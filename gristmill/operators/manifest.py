"""Path-manifest operators: index pages, slices, batches, splits, retries.

A manifest is a DataFrame with a unique 0-based ``pos`` and a ``path``; slicing,
batching and splitting are arithmetic on ``pos``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.html import first_link, inner_text, list_items
from gristmill.functions.paths import base_name
from gristmill.functions.text import strip
from gristmill.operators.numbering import number_rows, renumber

# Where dumps live and how an index page names them.
BASE_URL = "https://data.commoncrawl.org/crawl-data/"
DUMP_MARK = "s3://commoncrawl/crawl-data/CC-MAIN-"
MANIFEST_FILE = "/wet.paths.gz"
MIN_YEAR = 2019
SHUFFLE_SEED = 2023
EXCLUDED_DUMPS = ("CC-MAIN-2019", "CC-MAIN-2020")
BATCH_STEP = 10_000
MAX_TRIES = 5
RETRY_ROUNDS = 2


def extract_list_items(pages: DataFrame, html: str = "html") -> DataFrame:
    """One row per list item: other columns, item_no, item_html, item_text."""
    others = [c for c in pages.columns if c != html]
    items = pages.select(
        *others, F.posexplode(list_items(F.col(html))).alias("item_no", "item_html")
    )
    return items.withColumn("item_text", inner_text(F.col("item_html")))


def dump_entries(items: DataFrame) -> DataFrame:
    """Add date_label, dump_id and manifest_url; keep only items that name a dump."""
    named = items.where(F.contains("item_text", F.lit(DUMP_MARK)))
    part = F.get(F.split("item_text", "/"), F.lit(4))
    return named.select(
        "*",
        inner_text(first_link(F.col("item_html"))).alias("date_label"),
        strip(F.substring_index(strip(part), "–", 1)).alias("dump_id"),
    ).withColumn("manifest_url", F.concat(F.lit(BASE_URL), "dump_id", F.lit(MANIFEST_FILE)))


def year_of(label: Column) -> Column:
    """Last blank-separated part of a date label as a number, NULL if it is none."""
    return F.substring_index(label, " ", -1).try_cast("int")


def filter_min_year(df: DataFrame, year: int = MIN_YEAR, label: str = "date_label") -> DataFrame:
    return df.where(year_of(F.col(label)) >= year)


def dump_of(path: Column) -> Column:
    """Dump name inside a manifest path, NULL if there is none."""
    return F.nullif(F.regexp_extract(path, r"CC-MAIN-\d{4}-\d{2}", 0), F.lit(""))


def exclude_substrings(
    df: DataFrame, col: str = "path", substrings: Sequence[str] = EXCLUDED_DUMPS
) -> DataFrame:
    for s in substrings:
        df = df.where(~F.contains(col, F.lit(s)))
    return df


def seeded_shuffle(
    df: DataFrame, keys: Sequence[str], seed: int = SHUFFLE_SEED, name: str = "pos"
) -> DataFrame:
    """Full shuffle that gives the same order for the same seed and rows.

    Rows are ordered by a digest of the seed and ``keys``, which together must
    identify a row: equal paths at different places then spread over all buckets.
    """
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    keyed = df.withColumn("_digest", digest)
    order = [F.col("_digest"), *[F.col(k) for k in keys]]
    return number_rows(keyed, F.substring("_digest", 1, 3), order, name).drop("_digest")


def slice_manifest(df: DataFrame, start: int = 0, end: int = -1, pos: str = "pos") -> DataFrame:
    """Rows at positions [start, end); ``end=-1`` means to the end."""
    if start < 0 or end < -1:
        raise ValueError("start must be >= 0 and end >= -1")
    kept = df.where(F.col(pos) >= start)
    return kept if end == -1 else kept.where(F.col(pos) < end)


def batch_manifest(
    df: DataFrame, start: int = 0, step: int = BATCH_STEP, k: int = 1, pos: str = "pos"
) -> DataFrame:
    """``k`` batches of ``step`` rows from ``start``, with number and label."""
    kept = slice_manifest(df, start, start + step * k, pos)
    batch = F.floor((F.col(pos) - start) / step)
    first = F.floor((start + batch * step) / step)
    return kept.withColumn("batch", batch.cast("int")).withColumn(
        "batch_label",
        F.concat(
            first.cast("string"),
            F.lit("w_"),
            F.floor((start + (batch + 1) * step) / step).cast("string"),
            F.lit("w"),
        ),
    )


def assign_splits(df: DataFrame, k: int, pos: str = "pos") -> DataFrame:
    """Cut the rows in ``k`` contiguous parts; the first ``n % k`` get one more.

    Positions may have gaps. With fewer rows than parts, the later parts are empty.
    """
    dense = renumber(df.withColumn("_dense", F.col(pos)), "_dense", total="_n")
    small = F.floor(F.col("_n") / k)
    longer = F.col("_n") % k
    in_longer = longer * (small + 1)
    split = F.when(
        F.col("_dense") < in_longer, F.floor(F.try_divide(F.col("_dense"), small + 1))
    ).otherwise(longer + F.floor(F.try_divide(F.col("_dense") - in_longer, small)))
    return dense.withColumn("split", split.cast("int")).drop("_dense", "_n")


def anti_landed(
    manifest: DataFrame, landed: DataFrame, path: str = "path", landed_path: str = "path"
) -> DataFrame:
    """Paths not landed yet.

    A path has landed when a file with its base name exists, or with its base
    name without ``.gz``. Two equi-joins; an OR in one join would be pairwise.
    """
    names = landed.select(base_name(F.col(landed_path)).alias("_name")).distinct()
    named = manifest.withColumn("_name", base_name(F.col(path)))
    open_ = named.join(names, "_name", "left_anti")
    return (
        open_.withColumn("_name", F.replace(F.col("_name"), F.lit(".gz"), F.lit("")))
        .join(names, "_name", "left_anti")
        .drop("_name")
    )


def first_success(
    attempts: DataFrame, path: str = "path", try_no: str = "try", ok: str = "ok"
) -> DataFrame:
    """Per path: tries made and the number of the first good one (NULL if none)."""
    return attempts.groupBy(path).agg(
        F.count(F.lit(1)).alias("n_tries"),
        F.min(F.when(F.col(ok), F.col(try_no))).alias("first_ok"),
    )


def failed_after(
    attempts: DataFrame,
    max_tries: int = MAX_TRIES,
    rounds: int = 1,
    path: str = "path",
    try_no: str = "try",
    ok: str = "ok",
) -> DataFrame:
    """Paths without success in ``rounds`` rounds of ``max_tries`` tries (from 1)."""
    allowed = attempts.where(F.col(try_no) <= max_tries * rounds)
    return first_success(allowed, path, try_no, ok).where("first_ok IS NULL").drop("first_ok")


def retry_rounds(
    attempts: DataFrame,
    max_tries: int = MAX_TRIES,
    rounds: int = RETRY_ROUNDS,
    path: str = "path",
    try_no: str = "try",
    ok: str = "ok",
) -> DataFrame:
    """Per round: paths tried and paths still failing after it."""
    per_path = first_success(attempts, path, try_no, ok).select(
        F.ceil(F.col("first_ok") / max_tries).alias("ok_round")
    )
    open_rounds = F.sequence(
        F.lit(1), F.least(F.coalesce(F.col("ok_round"), F.lit(rounds)), F.lit(rounds)).cast("int")
    )
    return (
        per_path.select("ok_round", F.explode(open_rounds).alias("round"))
        .groupBy("round")
        .agg(
            F.count(F.lit(1)).alias("tried"),
            F.count_if(F.col("ok_round").isNull() | (F.col("ok_round") > F.col("round"))).alias(
                "failed"
            ),
        )
    )

