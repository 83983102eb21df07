"""URL and path helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def netloc(url: Column) -> Column:
    """Network location with user-info, port and letter case kept; '' if none.

    ``parse_url(.., 'HOST')`` is no substitute: it drops user-info and port and
    gives NULL for hosts or paths it thinks malformed.
    """
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def without_gz(name: Column) -> Column:
    """Drop one ``.gz`` suffix."""
    return F.regexp_replace(name, r"\.gz\z", "")


def local_name(path: Column, parts: int = 2, sep: str = "_") -> Column:
    """Last ``parts`` path elements joined by ``sep``."""
    return F.replace(F.substring_index(path, "/", -parts), F.lit("/"), F.lit(sep))


def path_part(path: Column, from_end: int) -> Column:
    """n-th path element counted from the end, NULL when the path is shorter."""
    return F.try_element_at(F.split(path, "/"), F.lit(-from_end))


def cut_of(path: Column) -> Column:
    """Name of the dump a stage-2 file belongs to: third element from the end."""
    return path_part(path, 3)


def plain_path(path: Column) -> Column:
    """A file path of Spark's metadata column without percent signs, as file systems list it.

    Only percent escapes are undone, a plus sign stays what it is.
    """
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """A path as a reader takes it, with the characters of patterns escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)
