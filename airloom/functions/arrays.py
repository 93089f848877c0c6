"""Nested array access that never throws under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_result(c: str | Column) -> Column:
    """First element of a ``results`` array, or null when empty or null."""
    return F.get(_col(c), 0)


def first_match_id(sensors: str | Column, parameter_id: int) -> Column:
    """Id of the first sensor whose ``parameter.id`` matches, else null."""
    matching = F.filter(_col(sensors), lambda s: s["parameter"]["id"] == F.lit(parameter_id))
    return F.get(matching, 0)["id"]
