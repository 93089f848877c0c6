"""Historical measurements: reshape, bound in time, cap, and land by reading day."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from airloom.functions.timestamps import parse_utc, reading_day


def _day(value: _dt.date | str) -> Column:
    text = value.isoformat() if isinstance(value, _dt.date) else str(value)
    return F.lit(text).cast("date")


def reshape_measurements(
    results: DataFrame,
    sensors: DataFrame,
    result_col: str = "result",
    datetime_from: _dt.date | str | None = None,
    datetime_to: _dt.date | str | None = None,
    inclusive_to: bool = False,
) -> DataFrame:
    """Measurement results -> reading records shaped like latest readings.

    ``results`` has ``sensor_id`` and a measurement struct; ``sensors`` maps
    ``location_id`` to its resolved ``sensor_id`` (``resolve_sensor``). The
    inner join drops measurements of sensors no location resolved to, and
    a location without a sensor yields nothing. ``datetime_from`` /
    ``datetime_to`` bound the reading time by calendar day, half-open unless
    ``inclusive_to``. Output: location_id, sensor_id, value, date_utc (raw
    UTC string), datetime (struct with ``utc``), page, pos.
    """
    r = F.col(result_col)
    shaped = results.select(
        "sensor_id",
        "page",
        "pos",
        r["value"].alias("value"),
        r["period"]["datetimeFrom"]["utc"].alias("date_utc"),
    )
    matched = shaped.join(
        sensors.where(F.col("sensor_id").isNotNull()).select("location_id", "sensor_id"),
        "sensor_id",
    )
    ts = F.to_date(parse_utc("date_utc"))
    if datetime_from is not None:
        matched = matched.where(ts >= _day(datetime_from))
    if datetime_to is not None:
        upper = _day(datetime_to)
        matched = matched.where(ts <= upper if inclusive_to else ts < upper)
    return matched.select(
        "location_id",
        "sensor_id",
        "value",
        "date_utc",
        F.struct(F.col("date_utc").alias("utc")).alias("datetime"),
        "page",
        "pos",
    )


def cap_per_location(
    df: DataFrame,
    n: int,
    order_cols: Sequence[str | Column] = ("page", "pos"),
    key: str = "location_id",
) -> DataFrame:
    """Keep the first ``n`` readings of each location in fetch order.

    ``row_number() <= n`` is planned with a partial ``WindowGroupLimit``
    (up to ``spark.sql.optimizer.windowGroupLimitThreshold``), so a
    location with a huge history ships at most ``n`` rows per map task.
    """
    w = Window.partitionBy(key).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def backfill_rows(shaped: DataFrame, dim: DataFrame) -> DataFrame:
    """Backfill records with their reading day and station metadata.

    Readings with a null or empty ``utc`` are skipped; the landing
    partition ``date`` is the reading's own UTC day (first ten characters),
    not the day the backfill runs. Each location's one dimension row is
    attached to all its measurements. ``run_id`` names the landing
    ``backfill_location_<id>``, which sorts before ``run_…`` landings, so
    backfill wins keep-first ties as with lexicographic key listing.
    """
    ok = shaped.where(F.length("date_utc") > 0)
    d = dim.select(
        F.col("location_id").alias("_dim_id"),
        F.struct("name", "city", "country").alias("location_meta"),
    )
    joined = ok.join(d, ok["location_id"] == d["_dim_id"], "left").drop("_dim_id")
    return joined.select(
        reading_day("date_utc").alias("date"),
        F.concat(F.lit("backfill_location_"), F.col("location_id").cast("string")).alias(
            "run_id"
        ),
        *[c for c in joined.columns if c not in ("date",)],
    )


def counts_by_day(rows: DataFrame) -> DataFrame:
    """Files a backfill writes: one per (date, location), with its row count."""
    return rows.groupBy("date", "location_id").agg(F.count(F.lit(1)).alias("readings"))
