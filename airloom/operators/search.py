"""Location catalogue search (finding station ids to backfill)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions.strings import contains_ci, fixed_width
from airloom.options import PARAMETER_ID


def search_locations(
    catalogue: DataFrame,
    country: str,
    parameter_id: int = PARAMETER_ID,
    limit: int | None = None,
    order_col: str = "id",
) -> DataFrame:
    """Locations of one ISO country with a sensor for ``parameter_id``.

    All of them, or the first ``limit`` in catalogue order (``order_col``).
    """
    has_param = F.exists("sensors", lambda s: s["parameter"]["id"] == F.lit(parameter_id))
    found = catalogue.where((F.col("country.code") == F.lit(country)) & has_param)
    return found if limit is None else found.orderBy(order_col).limit(limit)


def find_locations(
    catalogue: DataFrame,
    country: str,
    search: str | None = None,
    limit: int | None = None,
    parameter_id: int = PARAMETER_ID,
    limit_before_search: bool = False,
) -> DataFrame:
    """Catalogue search with an optional case-insensitive substring filter.

    The needle is a literal (no LIKE or regex) matched against name or
    locality, null counting as ''. ``limit`` cuts what was found; with
    ``limit_before_search`` it cuts the country's locations before the text
    filter, as the source tool does, so later matches are not found. Output:
    id, name (35 chars), locality (25 chars), country code ('' when null).
    """
    matches = F.lit(True)
    if search:
        matches = contains_ci("name", search) | contains_ci("locality", search)
    if limit_before_search:
        found = search_locations(catalogue, country, parameter_id, limit).where(matches)
    else:
        found = search_locations(catalogue.where(matches), country, parameter_id, limit)
    return found.select(
        F.col("id"),
        fixed_width("name", 35).alias("name"),
        fixed_width("locality", 25).alias("locality"),
        F.coalesce(F.col("country.code"), F.lit("")).alias("country"),
    )
