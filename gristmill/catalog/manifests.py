"""Manifest operators, with page urls as the paths of a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill.catalog.common import table
from gristmill.functions.paths import local_name
from gristmill.operators import manifest as m
from gristmill.operators.numbering import renumber
from gristmill.plans.acquire import fetch_plan, shuffled_manifest
from gristmill.sources.staging import new_folder
from gristmill.sources.manifests import read_manifests, write_manifest


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that name a dump, with their position."""
    n = F.col("page_id")
    return table(spark, sf_dir, "pages").select(
        n.alias("pos"),
        F.concat(
            F.lit("crawl-data/CC-MAIN-"),
            (2018 + n % 6).cast("string"),
            F.lit("-10/"),
            F.split_part(F.col("url"), F.lit("/"), F.lit(3)),
            F.lit("/"),
            n.cast("string"),
            F.lit(".warc.wet.gz"),
        ).alias("path"),
    )


MANIFEST = """(SELECT page_id AS pos, 'crawl-data/CC-MAIN-' || (2018 + page_id % 6) || '-10/'
    || split_part(url, '/', 3) || '/' || page_id || '.warc.wet.gz' AS path FROM pages) AS m"""


def html_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    return m.extract_list_items(pages).select("page_id", "item_no", "item_text")


NESTED = (
    "<ul class=a><li>one<ol><li>two &#233;</li><LI id=x>three &#x20AC;&#0;</ol></li><li>open",
    "<li><b>five &amp;#65;</b></ul>rest",
)


def html_nested_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that are nested, left open or full of references, after each page."""
    page = F.concat("html", F.lit(NESTED[0]), F.col("page_id").cast("string"), F.lit(NESTED[1]))
    pages = table(spark, sf_dir, "pages").select("page_id", page.alias("html"))
    return m.extract_list_items(pages).select("page_id", "item_no", "item_text")


MONTHS = ("January", "June", "November")


def _index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one item more, which names a dump."""
    n = F.col("page_id")
    month = F.element_at(F.array(*[F.lit(x) for x in MONTHS]), (n % 3 + 1).cast("int"))
    year = (2014 + n % 10).cast("string")
    item = F.concat(
        F.lit("<ul><li class='d'><b>s3://commoncrawl/crawl-data/CC-MAIN-"),
        year,
        F.lit("-"),
        n.cast("string"),
        F.lit("</b> &#8211; <a href='/x'>"),
        month,
        F.lit(" "),
        year,
        F.lit("</a></li></ul>"),
    )
    return table(spark, sf_dir, "pages").select("page_id", F.concat("html", item).alias("html"))


def dump_index_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = m.dump_entries(m.extract_list_items(_index_pages(spark, sf_dir)))
    return m.filter_min_year(entries).select("page_id", "date_label", "dump_id", "manifest_url")


def manifest_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.col("path")
    return _manifest(spark, sf_dir).select(
        "pos", m.dump_of(path).alias("dump"), local_name(path).alias("local_name")
    )


def manifest_exclude(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.exclude_substrings(_manifest(spark, sf_dir))


def manifest_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shuffled_manifest(_manifest(spark, sf_dir))


def manifest_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.slice_manifest(_manifest(spark, sf_dir), 40, -1)


def manifest_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.batch_manifest(_manifest(spark, sf_dir), start=20, step=10, k=7)


def manifest_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.assign_splits(_manifest(spark, sf_dir), 8)


def manifest_splits_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits of what is left after dumps were excluded."""
    return m.assign_splits(m.exclude_substrings(_manifest(spark, sf_dir)), 7)


def manifest_renumber(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New positions over many small buckets, ids of the events table."""
    events = table(spark, sf_dir, "events").select("event_id")
    return renumber(events.withColumn("pos", F.col("event_id") * 3), width=64)


def manifest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write two manifests, read them back as one in input order."""
    folder = new_folder(spark, "manifests")
    paths = _manifest(spark, sf_dir)
    write_manifest(paths.withColumn("pos", -F.col("pos")), folder + "/b")
    write_manifest(paths, folder + "/a")
    return read_manifests(spark, [folder + "/b", folder + "/a"])


def fetch_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exclude, shuffle, batch, skip landed files, split: the way to the workers."""
    paths = _manifest(spark, sf_dir)
    landed = paths.where(F.contains("path", F.lit(".org/"))).select("path")
    return fetch_plan(shuffled_manifest(paths), landed, start=10, step=50, k=2, workers=3)


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as download attempts: ten tries per path."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.floor(n / 10).alias("path"),
        (n % 10 + 1).alias("try"),
        (F.col("event_type") == "purchase").alias("ok"),
    )


ATTEMPTS = """(SELECT event_id // 10 AS path, event_id % 10 + 1 AS try,
    event_type = 'purchase' AS ok FROM events) AS a"""


def failed_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.failed_after(_attempts(spark, sf_dir))


def failed_after_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.failed_after(_attempts(spark, sf_dir), rounds=m.RETRY_ROUNDS)


def retry_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return m.retry_rounds(_attempts(spark, sf_dir))


QUERIES = {
    "html_list_items": html_list_items,
    "html_nested_items": html_nested_items,
    "dump_index_entries": dump_index_entries,
    "manifest_names": manifest_names,
    "manifest_exclude": manifest_exclude,
    "manifest_shuffle": manifest_shuffle,
    "manifest_slice": manifest_slice,
    "manifest_batches": manifest_batches,
    "manifest_splits": manifest_splits,
    "manifest_splits_gaps": manifest_splits_gaps,
    "manifest_renumber": manifest_renumber,
    "manifest_files": manifest_files,
    "fetch_assignment": fetch_assignment,
    "failed_after": failed_after,
    "failed_after_rounds": failed_after_rounds,
    "retry_rounds": retry_rounds,
}

TEXT = "regexp_replace(item, '(?s)<[^>]*>', '', 'g')"
for _entity, _char in (
    ("&nbsp;", " "),
    ("&ndash;", "–"),
    ("&#8211;", "–"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "''"),
    ("&amp;", "&"),
):
    TEXT = f"replace({TEXT}, '{_entity}', '{_char}')"
TEXT = TEXT.replace("item,", "replace(replace(item, '&#233;', 'é'), '&#x20AC;', '€'),", 1)


def _items(html: str) -> str:
    """Start tags become a mark to split at; what follows an end is cut off."""
    return f"""SELECT page_id, (item_no - 1)::INTEGER AS item_no, {TEXT} AS item_text
        FROM (SELECT page_id, unnest(items) AS item, generate_subscripts(items, 1) AS item_no
              FROM (SELECT page_id, list_transform(
                      string_split(regexp_replace({html}, '(?i)<li(\\s[^>]*)?>', chr(1), 'g'), chr(1))[2:],
                      lambda x: regexp_extract(x, '(?is)^(.*?)(</li|</ul|</ol|$)', 1)) AS items
                    FROM pages) AS p) AS x"""


KEPT = f"""(SELECT pos, path FROM {MANIFEST}
    WHERE NOT contains(path, 'CC-MAIN-2019') AND NOT contains(path, 'CC-MAIN-2020')) AS k"""
SHUFFLED = f"""(SELECT path, row_number() OVER (ORDER BY md5('2023:' || path || ':' || pos), path, pos) - 1
    AS pos FROM {KEPT}) AS s"""

SQL = {
    "html_list_items": _items("html"),
    "html_nested_items": _items(f"html || '{NESTED[0]}' || page_id || '{NESTED[1]}'"),
    "dump_index_entries": """SELECT page_id, month || ' ' || year AS date_label,
        'CC-MAIN-' || year || '-' || page_id AS dump_id,
        'https://data.commoncrawl.org/crawl-data/CC-MAIN-' || year || '-' || page_id || '/wet.paths.gz'
          AS manifest_url
        FROM (SELECT page_id, ['January', 'June', 'November'][page_id % 3 + 1] AS month,
                2014 + page_id % 10 AS year FROM pages) AS p WHERE year >= 2019""",
    "manifest_names": f"""SELECT pos, 'CC-MAIN-' || (2018 + pos % 6) || '-10' AS dump,
        split_part(path, '/', 4) || '_' || split_part(path, '/', 5) AS local_name
        FROM (SELECT pos, 'x/' || path AS path FROM {MANIFEST}) AS q""",
    "manifest_exclude": f"SELECT pos, path FROM {KEPT}",
    "manifest_shuffle": f"SELECT path, pos FROM {SHUFFLED}",
    "manifest_slice": f"SELECT pos, path FROM {MANIFEST} ORDER BY pos OFFSET 40",
    "manifest_batches": f"""SELECT pos, path, ((pos - 20) // 10)::INTEGER AS batch,
        (pos // 10) || 'w_' || (pos // 10 + 1) || 'w' AS batch_label
        FROM {MANIFEST} WHERE pos >= 20 AND pos < 90""",
    "manifest_splits": f"""SELECT pos, path, (ntile(8) OVER (ORDER BY pos) - 1)::INTEGER AS split
        FROM {MANIFEST}""",
    "manifest_splits_gaps": f"""SELECT pos, path, (ntile(7) OVER (ORDER BY pos) - 1)::INTEGER AS split
        FROM {KEPT}""",
    "manifest_renumber": """SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS pos
        FROM events""",
    "manifest_files": f"""SELECT row_number() OVER (ORDER BY o, q) - 1 AS pos, path,
        'CC-MAIN-' || split_part(split_part(path, 'CC-MAIN-', 2), '/', 1) AS dump,
        split_part(path, '/', 4) AS file_name
        FROM (SELECT 1 AS o, -pos AS q, path FROM {MANIFEST} UNION ALL
              SELECT 2, pos, path FROM {MANIFEST}) AS u""",
    "fetch_assignment": f"""SELECT pos, path, batch, batch_label,
        (ntile(3) OVER (ORDER BY pos) - 1)::INTEGER AS split
        FROM (SELECT pos, path, ((pos - 10) // 50)::INTEGER AS batch,
                ((10 + (pos - 10) // 50 * 50) // 50) || 'w_'
                  || ((10 + ((pos - 10) // 50 + 1) * 50) // 50) || 'w' AS batch_label
              FROM {SHUFFLED} WHERE pos >= 10 AND pos < 110
                AND NOT contains(path, '.org/')) AS b""",
    "failed_after": f"""SELECT path, count(*) AS n_tries FROM {ATTEMPTS}
        WHERE try <= 5 GROUP BY path HAVING NOT bool_or(ok)""",
    "failed_after_rounds": f"""SELECT path, count(*) AS n_tries FROM {ATTEMPTS}
        WHERE try <= 10 GROUP BY path HAVING NOT bool_or(ok)""",
    "retry_rounds": f"""WITH p AS (SELECT path, min(CASE WHEN ok THEN try END) AS first_ok
          FROM {ATTEMPTS} GROUP BY path)
        SELECT 1 AS round, count(*) AS tried, count(*) FILTER (coalesce(first_ok, 99) > 5) AS failed FROM p
        UNION ALL
        SELECT 2, count(*), count(*) FILTER (coalesce(first_ok, 99) > 10) FROM p
        WHERE coalesce(first_ok, 99) > 5""",
}
