"""Dimension (station cache) versions: never overwrite the path being read."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from airloom.operators.dimension import DIM_COLUMNS
from airloom.schema import LOCATION_DIM
from airloom.storage import delete, exists, folders

# Committed versions that are kept: the newest and some that readers may still use.
KEEP_VERSIONS = 5


def _committed(spark: SparkSession, root: str) -> list[str]:
    """Paths of the versions whose write finished (``_SUCCESS`` comes last), oldest first."""
    names = [f for f in folders(spark, root) if f.startswith("v=")]
    paths = [f"{root.rstrip('/')}/{n}" for n in names]
    return [p for p in paths if exists(spark, f"{p}/_SUCCESS")]


def write_dimension(dim: DataFrame, root: str) -> str:
    """Write a new version directory ``root/v=<id>`` and return its path.

    The upsert reads the current version while it writes the next one, so
    the two must be different paths; readers pick the latest committed
    version with ``read_dimension``. Versions sort by a time-ordered id; all
    but the newest ``KEEP_VERSIONS`` are deleted.
    """
    spark = dim.sparkSession
    version = f"{root.rstrip('/')}/v={time.time_ns():020d}{uuid.uuid4().hex[:8]}"
    dim.select(*DIM_COLUMNS).write.mode("errorifexists").parquet(version)
    for old in _committed(spark, root)[:-KEEP_VERSIONS]:
        delete(spark, old)
    return version


def read_dimension(spark: SparkSession, root: str) -> DataFrame:
    """The latest committed version under ``root`` (empty when there is none).

    Only the version folders are listed; one that a failed or running write
    left without its ``_SUCCESS`` mark is not read.
    """
    versions = _committed(spark, root)
    if not versions:
        return spark.createDataFrame([], LOCATION_DIM)
    return spark.read.schema(LOCATION_DIM).parquet(versions[-1])
