"""String predicates and projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_whitespace(c: str | Column) -> Column:
    """Strip all leading/trailing whitespace (Spark's ``trim`` strips spaces only)."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def contains_ci(c: str | Column, needle: str) -> Column:
    """Case-insensitive literal substring test; null text counts as ''."""
    return F.lower(F.coalesce(_col(c), F.lit(""))).contains(needle.lower())


def fixed_width(c: str | Column, width: int) -> Column:
    """First ``width`` characters, null shown as ''."""
    return F.substring(F.coalesce(_col(c), F.lit("")), 1, width)
