"""Curated Parquet sink: idempotent per-date overwrite."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.schema import CURATED_COLUMNS
from airloom.storage import delete, folders


def drop_dates(spark: SparkSession, root: str, keep: Iterable[str]) -> list[str]:
    """Delete the ``date`` partitions that are not in ``keep``; returns their dates."""
    kept = set(keep)
    dates = [f.removeprefix("date=") for f in folders(spark, root) if f.startswith("date=")]
    gone = [d for d in dates if d not in kept]
    for d in gone:
        delete(spark, f"{root.rstrip('/')}/date={d}")
    return gone


def write_curated(df: DataFrame, root: str, compression: str = "snappy") -> None:
    """Replace exactly the ``date`` partitions present in ``df``.

    Dynamic partition overwrite: dates absent from ``df`` are untouched, and
    a frame with no rows writes nothing, so an earlier good partition
    survives a rerun whose rows were all invalid. Rows are rebalanced by
    ``date`` (AQE sizes the output files) and sorted by ``date_utc`` within
    each file, so row-group statistics can skip by time.
    """
    out = df.select(*CURATED_COLUMNS, F.col("date").cast("string").alias("date"))
    (
        out.hint("rebalance", "date")
        .sortWithinPartitions("date", "date_utc")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", compression)
        .partitionBy("date")
        .parquet(root)
    )


def write_warehouse(df: DataFrame, root: str, buckets: int = 64) -> None:
    """Warehouse layout: a ``load_date`` column, files clustered by
    ``location_id`` and sorted by ``date_utc`` (distribution and sort keys).

    ``REBALANCE(location_id)`` clusters stations into files like a
    distribution key, and AQE splits the partition of a station holding a
    large share of rows instead of writing it from one task; ``buckets`` is
    the initial number of partitions.
    """
    (
        df.select(*CURATED_COLUMNS)
        .withColumn("load_date", F.current_date())
        .hint("rebalance", buckets, "location_id")
        .sortWithinPartitions("location_id", "date_utc")
        .write.mode("append")
        .parquet(root)
    )
