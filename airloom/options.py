"""Options that hold the rule values and the variants of the metric layer.

All settings are explicit, frozen and passed to the operators; nothing is
read from the environment.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, replace

# ---------------------------------------------------------------------------
# Fixed values (must equal the source pipeline's for equal results):
#   parameter id 2 is named "pm25", unit "µg/m³"
#   readings below 0 are invalid; sentinel values -1, -999, 9999, 99999
#   readings above 500 are flagged as extreme outliers (kept)
#   WHO 24-hour PM2.5 guideline 15 µg/m³ (breach is strictly greater)
#   API page size cap 1000 rows
#   backfill window 60 days
# ---------------------------------------------------------------------------
PARAMETER_ID = 2
PARAMETER_NAME = "pm25"
PARAMETER_UNIT = "µg/m³"
MIN_VALID_VALUE = 0.0
SENTINEL_VALUES = (-1.0, -999.0, 9999.0, 99999.0)
MAX_PLAUSIBLE_VALUE = 500.0
WHO_PM25_24H_GUIDELINE = 15.0
PAGE_SIZE_CAP = 1000
BACKFILL_DAYS = 60


@dataclass(frozen=True)
class QualityRules:
    """Validity, outlier and dedup rules applied by ``clean_readings``.

    ``dedup_key="raw"`` compares the timestamp as the raw string (so ``…Z``
    and ``…+00:00`` are different readings, as in the source pipeline);
    ``"instant"`` compares the parsed instant instead.
    ``dedup_scope="partition"`` deduplicates within each raw ``date``
    partition (one curation run per date); ``"global"`` across all dates,
    where the earliest landing day wins, then landing order within it.
    """

    min_valid: float = MIN_VALID_VALUE
    sentinels: tuple[float, ...] = SENTINEL_VALUES
    max_plausible: float = MAX_PLAUSIBLE_VALUE
    dedup_key: str = "raw"
    dedup_scope: str = "partition"

    def __post_init__(self) -> None:
        if self.dedup_key not in ("raw", "instant"):
            raise ValueError(f"dedup_key must be 'raw' or 'instant', got {self.dedup_key!r}")
        if self.dedup_scope not in ("partition", "global"):
            raise ValueError(
                f"dedup_scope must be 'partition' or 'global', got {self.dedup_scope!r}"
            )


@dataclass(frozen=True)
class FlattenOptions:
    """How a raw nested reading becomes a flat row.

    ``canonical``: id from ``locationsId``; timestamp from ``datetime.utc`` when
    ``datetime`` is an object, from top-level ``date_utc`` when ``datetime`` is
    a non-empty scalar, else null; parameter and unit are constants.
    ``deployed``: id from ``locationsId`` else ``locationId``; timestamp from
    ``datetime`` else ``date`` (objects only); unit read from the record.
    """

    profile: str = "canonical"
    parameter: str = PARAMETER_NAME
    unit: str | None = PARAMETER_UNIT

    def __post_init__(self) -> None:
        if self.profile not in ("canonical", "deployed"):
            raise ValueError(f"profile must be 'canonical' or 'deployed', got {self.profile!r}")


@dataclass(frozen=True)
class MetricOptions:
    """Variant switches of the metric views (see the two profiles below)."""

    exclude_outliers: bool = True
    lookback_days: int | None = None
    require_nonblank_city: bool = False
    guideline: float = WHO_PM25_24H_GUIDELINE
    parameter: str = PARAMETER_NAME
    # Reference day for ``lookback_days``; None means ``current_date()``.
    as_of: _dt.date | str | None = None
    # Exact averages: sum the values as DECIMAL(38,8), so the result does not
    # depend on summation order (equal across engines and partitionings).
    exact: bool = False
    # Trend LAG partitioning: by city only (source behaviour, country breaks
    # ties) or by (city, country).
    partition_by_country: bool = False
    # Trend: compare only with the calendar week just before (gaps give null).
    require_adjacent_week: bool = False

    @classmethod
    def athena(cls, **overrides) -> "MetricOptions":
        """Views as queried in production: outliers kept, last 8 days, blank city dropped."""
        base = dict(exclude_outliers=False, lookback_days=7, require_nonblank_city=True)
        base.update(overrides)
        return cls(**base)

    @classmethod
    def warehouse(cls, **overrides) -> "MetricOptions":
        """Warehouse views: outliers excluded, no date window, null city dropped."""
        base = dict(exclude_outliers=True, lookback_days=None, require_nonblank_city=False)
        base.update(overrides)
        return cls(**base)

    def trend(self) -> "MetricOptions":
        """Trend views never apply the date window."""
        return replace(self, lookback_days=None)
