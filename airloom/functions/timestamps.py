"""Timestamp parsing and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A timestamp string must start with a full calendar date; Spark's lenient
# cast would otherwise read "10:00" as today and "2026" as January 1st.
DATE_SHAPE = r"^\d{4}-\d{2}-\d{2}([T ].*)?$"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc(c: str | Column) -> Column:
    """Parse one raw timestamp string per row; invalid text gives null.

    Offsets are converted to UTC; zone-less text is read as UTC (the session
    zone). The result is a zone-less UTC wall-clock ``timestamp_ntz``.
    Unlike a whole-column format guess, each row is parsed on its own.
    """
    text = F.trim(_col(c))
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("timestamp")).cast("timestamp_ntz")


def reading_day(c: str | Column) -> Column:
    """The ``YYYY-MM-DD`` day of a raw UTC string: its first ten characters."""
    return F.substring(_col(c), 1, 10)


def week_start(c: str | Column) -> Column:
    """Monday 00:00 of the week holding ``c``, as ``timestamp_ntz``."""
    return F.date_trunc("week", _col(c)).cast("timestamp_ntz")
