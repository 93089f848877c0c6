"""The run log of a landing root: which landing holds each (date, run)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.storage import exists, folders

ENTRY = "date string, run_id string, rows long, landing string"


def _log(root: str) -> str:
    # The underscore hides the log from scans of the root.
    return f"{root.rstrip('/')}/_runs"


def entry_path(root: str, landing: str) -> str:
    return f"{_log(root)}/{landing}"


def _done(spark: SparkSession, root: str) -> list[str]:
    """Entries whose write has finished (``_SUCCESS`` comes last)."""
    entries = [entry_path(root, f) for f in folders(spark, _log(root))]
    return [e for e in entries if exists(spark, f"{e}/_SUCCESS")]


def any_entry(spark: SparkSession, root: str) -> bool:
    return bool(_done(spark, root))


def committed(spark: SparkSession, root: str) -> DataFrame:
    """(date, run_id, rows, landing) of every committed landing, none without a log.

    An entry counts once its write has finished.
    """
    done = _done(spark, root)
    return spark.read.schema(ENTRY).parquet(*done) if done else spark.createDataFrame([], ENTRY)


def latest(spark: SparkSession, root: str) -> DataFrame:
    """(date, run_id, landing): the landing whose lines hold for each (date, run)."""
    return committed(spark, root).groupBy("date", "run_id").agg(F.max("landing").alias("landing"))
