"""Metric views from mergeable partial states, one set per landing date.

A partial holds what the views need of one (landing date, city, country,
reading day): the decimal sum and count of values, the rows and the
breaches. Partials of a date depend on that date's curated rows alone, so a
late landing replaces the partials of its own date and nothing else; the
views add partials up and equal the views over the whole table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.functions.values import rounded_pct
from airloom.operators.metrics import _as_of, metric_base
from airloom.options import MetricOptions
from airloom.storage import delete, exists, folders

PARTIALS = (
    "city string, country string, reading_date date, value_sum decimal(38,8), value_count long, unfit long, "
    "row_count long, breaches long, date string"
)


def partials(curated: DataFrame, opts: MetricOptions = MetricOptions.warehouse()) -> DataFrame:
    """Partial states of curated rows (with their landing ``date``).

    All filters of ``opts`` apply here but the date window, which moves and
    is applied when a view is read.
    """
    value = F.col("value").try_cast("decimal(38,8)")
    return (
        metric_base(curated, opts.trend())
        .groupBy("city", "country", F.to_date("date_utc").alias("reading_date"), F.col("date").cast("string").alias("date"))
        .agg(
            F.try_sum(value).alias("value_sum"),
            F.count("value").alias("value_count"),
            F.count_if(F.col("value").isNotNull() & value.isNull()).alias("unfit"),
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col("value") > F.lit(float(opts.guideline))).alias("breaches"),
        )
    )


def update_partials(spark: SparkSession, curated: DataFrame, root: str, dates: Sequence[str], opts: MetricOptions = MetricOptions.warehouse()) -> None:
    """Replace the partials of ``dates`` by those of the curated table.

    Reads only those partitions. A date without rows loses its partials;
    other dates keep their files.
    """
    dates = list(dates)
    made = partials(curated.where(F.col("date").isin(dates)), opts)
    (
        made.hint("rebalance", "date").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(root)
    )
    held = {f.removeprefix("date=") for f in folders(spark, root) if f.startswith("date=")}
    for d in held.intersection(dates):
        if curated.where(F.col("date") == d).isEmpty():
            delete(spark, f"{root.rstrip('/')}/date={d}")


def read_partials(spark: SparkSession, root: str) -> DataFrame:
    there = exists(spark, root) and any(f.startswith("date=") for f in folders(spark, root))
    return spark.read.schema(PARTIALS).parquet(root) if there else spark.createDataFrame([], PARTIALS)


def _average() -> Column:
    """The exact average of merged partials, as ``values.exact_avg`` of their rows."""
    total, count = F.try_sum("value_sum"), F.sum("value_count")
    unfit = (F.sum("unfit") > 0) | (total.isNull() & (count > 0))
    wrong = F.raise_error(F.lit("a value or sum does not fit DECIMAL(38,8)")).cast("double")
    return F.when(unfit, wrong).otherwise(total.cast("double") / F.nullif(count, F.lit(0)))


def _window(state: DataFrame, opts: MetricOptions) -> DataFrame:
    if opts.lookback_days is None:
        return state
    return state.where(F.col("reading_date") >= F.date_sub(_as_of(opts), opts.lookback_days))


def daily_avg(state: DataFrame, opts: MetricOptions = MetricOptions.warehouse()) -> DataFrame:
    """``metrics.daily_avg`` (exact) from partials."""
    by = _window(state, opts).groupBy("city", "country", "reading_date")
    return by.agg(_average().alias("avg_pm25"), F.sum("row_count").alias("reading_count"))


def breach_rate(state: DataFrame, opts: MetricOptions = MetricOptions.warehouse()) -> DataFrame:
    """``metrics.breach_rate`` from partials."""
    rows, breaches = F.sum("row_count"), F.sum("breaches")
    by = _window(state, opts).groupBy("city", "country", "reading_date")
    return by.agg(rows.alias("total_readings"), breaches.alias("breaches"), rounded_pct(breaches, rows).alias("breach_pct"))


def weekly_avg(state: DataFrame) -> DataFrame:
    """``metrics.weekly_avg`` (exact) from partials; never date-windowed."""
    week = F.date_trunc("week", "reading_date").cast("timestamp_ntz").alias("week_start")
    return state.groupBy("city", "country", week).agg(_average().alias("avg_pm25"))
