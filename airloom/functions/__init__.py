"""Column expressions shared by the operators (all built-in, JVM-side)."""

from airloom.functions.arrays import first_match_id, first_result
from airloom.functions.strings import contains_ci, fixed_width, trim_whitespace
from airloom.functions.timestamps import parse_utc, reading_day, week_start
from airloom.functions.values import (
    exact_avg,
    is_below_floor,
    is_sentinel,
    is_valid_value,
    rounded_pct,
)

__all__ = [
    "contains_ci",
    "exact_avg",
    "first_match_id",
    "first_result",
    "fixed_width",
    "is_below_floor",
    "is_sentinel",
    "is_valid_value",
    "parse_utc",
    "reading_day",
    "rounded_pct",
    "trim_whitespace",
    "week_start",
]
