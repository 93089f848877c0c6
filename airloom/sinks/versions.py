"""Curated table in committed versions: readers see a run whole or not at all.

``<root>/data/v=<id>/date=D/`` holds what a run wrote; ``<root>/manifest/<n>``
says which version each date is read from, and is the pointer: a run writes
its data first and the next manifest last. A run that dies in between leaves
data that no manifest names. Two runs that start from one manifest cannot
both write the next: the second fails and is run again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.schema import CURATED_COLUMNS, CURATED_PARTITIONED
from airloom.sinks.curated import write_curated
from airloom.storage import delete, exists, folders

MANIFEST = "date string, version string"
KEEP_MANIFESTS = 5  # older ones go, with the data that only they name


def _manifests(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the committed manifests, oldest first."""
    base = f"{root.rstrip('/')}/manifest"
    return sorted(int(f) for f in folders(spark, base) if f.isdigit() and exists(spark, f"{base}/{f}/_SUCCESS"))


def _read_manifest(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    rows = spark.read.schema(MANIFEST).parquet(f"{root.rstrip('/')}/manifest/{number:012d}").collect()
    return {r["date"]: r["version"] for r in rows}  # one row per date


def current(spark: SparkSession, root: str) -> dict[str, str]:
    """The version of each date of the table (days, not rows)."""
    numbers = _manifests(spark, root)
    return _read_manifest(spark, root, numbers[-1]) if numbers else {}


def write_version(df: DataFrame, root: str) -> str:
    """Write curated rows as a new version, which nothing reads yet; returns its id."""
    version = f"{time.time_ns():020d}{uuid.uuid4().hex[:8]}"
    write_curated(df, f"{root.rstrip('/')}/data/v={version}")
    return version


def publish(spark: SparkSession, root: str, version: str, dates: Iterable[str], keep_others: bool = True) -> None:
    """Switch ``dates`` to ``version`` by writing the next manifest.

    Other dates keep theirs, or leave the table (``keep_others=False``).
    """
    numbers = _manifests(spark, root)
    before = _read_manifest(spark, root, numbers[-1]) if numbers else {}
    now = {**(before if keep_others else {}), **{d: version for d in dates}}
    rows = spark.createDataFrame(sorted(now.items()), MANIFEST)
    number = numbers[-1] + 1 if numbers else 0
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{root.rstrip('/')}/manifest/{number:012d}")
    _clean(spark, root)


def _clean(spark: SparkSession, root: str) -> None:
    """Drop old manifests, and versions older than any that is still named.

    Newer ones may belong to a run that has not switched yet.
    """
    numbers = _manifests(spark, root)
    kept = numbers[-KEEP_MANIFESTS:]
    for n in numbers[:-KEEP_MANIFESTS]:
        delete(spark, f"{root.rstrip('/')}/manifest/{n:012d}")
    named = {v for n in kept for v in _read_manifest(spark, root, n).values()}
    for f in folders(spark, f"{root.rstrip('/')}/data"):
        if f.startswith("v=") and f[2:] not in named and named and f[2:] < min(named):
            delete(spark, f"{root.rstrip('/')}/data/{f}")


def read_versioned(spark: SparkSession, root: str) -> DataFrame:
    """The table as the last committed manifest has it (empty without one)."""
    now = current(spark, root)
    if not now:
        return spark.createDataFrame([], CURATED_PARTITIONED)
    base = f"{root.rstrip('/')}/data"
    paths = [f"{base}/v={v}/date={d}" for d, v in sorted(now.items())]
    rows = spark.read.schema(CURATED_PARTITIONED).option("basePath", base).parquet(*paths)
    return rows.select(*CURATED_COLUMNS, F.col("date"))
