"""Approximate distinct counts that merge: one set of sketches per landing date.

An exact distinct count reads every reading again; a sketch of each date is
small, is replaced when the date changes, and adds up to the count of any
set of dates. Counts use HyperLogLog; the coverage compares two counts of
one set of ids, so it uses theta sketches, which sample the same ids.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.storage import exists, folders

LG_HLL, LG_THETA = 14, 14
SKETCHES = "ids binary, seen binary, resolved binary, date string"


def hll_error(sigmas: float = 3.0) -> float:
    """Relative error of a merged count that is exceeded in some 0.3 % of cases (3 sigmas)."""
    return sigmas * 1.04 / 2 ** (LG_HLL / 2)


def theta_error(sigmas: float = 3.0) -> float:
    """The same for a count by theta sketches, and for the coverage in absolute terms."""
    return sigmas / 2 ** (LG_THETA / 2)


def station_sketches(readings: DataFrame, city: Column, id_col: str = "location_id") -> DataFrame:
    """Sketches of the station ids of each ``date``: all, and those with a ``city``.

    Null ids are no stations. Partial sketches are merged, so a date or
    station with many readings costs one sketch per task.
    """
    known = readings.where(F.col(id_col).isNotNull())
    with_city = F.when(city.isNotNull(), F.col(id_col))
    return known.groupBy(F.col("date").cast("string").alias("date")).agg(
        F.hll_sketch_agg(F.col(id_col), LG_HLL).alias("ids"),
        F.theta_sketch_agg(F.col(id_col), LG_THETA).alias("seen"),
        F.theta_sketch_agg(with_city, LG_THETA).alias("resolved"),
    ).select("ids", "seen", "resolved", "date")


def update_sketches(sketches: DataFrame, root: str) -> None:
    """Replace the sketches of the dates present; other dates keep theirs."""
    (
        sketches.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("date").parquet(root)
    )


def read_sketches(spark: SparkSession, root: str, dates: Sequence[str] | None = None) -> DataFrame:
    there = exists(spark, root) and any(f.startswith("date=") for f in folders(spark, root))
    rows = spark.read.schema(SKETCHES).parquet(root) if there else spark.createDataFrame([], SKETCHES)
    return rows if dates is None else rows.where(F.col("date").isin(list(dates)))


def distinct_locations_approx(sketches: DataFrame) -> DataFrame:
    """One row: the estimated number of stations over all dates of ``sketches``."""
    n = F.hll_sketch_estimate(F.hll_union_agg("ids"))
    return sketches.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("distinct_locations"))


def coverage_approx(sketches: DataFrame) -> DataFrame:
    """One row: estimated stations, resolved stations and their share (null without stations)."""
    of = lambda c: F.coalesce(F.theta_sketch_estimate(F.theta_union_agg(c, LG_THETA)), F.lit(0)).cast("bigint")
    counts = sketches.agg(of("seen").alias("distinct_locations"), of("resolved").alias("resolved_locations"))
    share = F.col("resolved_locations").cast("double") / F.nullif(F.col("distinct_locations"), F.lit(0))
    return counts.withColumn("coverage", share)
