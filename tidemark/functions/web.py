"""URL parts, tolerant of scheme-less addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions._cols import ColumnOrName, as_col

__all__ = ["url_host", "url_path", "url_parameter"]


def _before(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def url_host(url: ColumnOrName) -> Column:
    """Text between the scheme (http, https, android-app; optional) and the first ``/`` or ``?``."""
    bare = F.regexp_replace(as_col(url), "(?:android-app|https?)://", "")
    return _before(_before(bare, "/"), "?")


def url_path(url: ColumnOrName) -> Column:
    """Text behind the first slash up to ``?``; without a slash, what stands before the ``?`` is dropped."""
    bare = F.regexp_replace(as_col(url), "https?://", "")
    slash = F.instr(bare, "/")
    cut = F.when(slash > 0, slash).otherwise(F.instr(bare, "?") - 1)
    return _before(F.substring(bare, cut + 1, F.length(bare)), "?")


def url_parameter(url: ColumnOrName, name: str) -> Column:
    """Value of a query parameter; NULL when absent or empty."""
    value = F.split_part(as_col(url), F.lit(f"{name}="), F.lit(2))
    return F.nullif(_before(value, "&"), F.lit(""))
