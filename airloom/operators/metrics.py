"""Metric views over the curated table.

Each view is a hash aggregate (partial per task, final after one shuffle on
the group keys); the trend adds one window on the small weekly result.
Group keys are city-level, so a city holding a large share of the rows
costs only its partial-aggregate rows in the exchange.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.functions.strings import trim_whitespace
from airloom.functions.timestamps import week_start
from airloom.functions.values import exact_avg, rounded_pct
from airloom.options import MetricOptions

DAILY_COLUMNS = ["city", "country", "reading_date", "avg_pm25", "reading_count"]
BREACH_COLUMNS = ["city", "country", "reading_date", "total_readings", "breaches", "breach_pct"]
TREND_COLUMNS = [
    "city",
    "country",
    "week_start",
    "avg_pm25",
    "prev_week_avg_pm25",
    "pct_change_wow",
]
OUTLIER_COLUMNS = [
    "location_id",
    "location_name",
    "city",
    "country",
    "value",
    "unit",
    "date_utc",
]


def _avg(opts: MetricOptions) -> Column:
    return exact_avg("value") if opts.exact else F.avg("value")


def _as_of(opts: MetricOptions) -> Column:
    if opts.as_of is None:
        return F.current_date()
    if isinstance(opts.as_of, _dt.date):
        return F.lit(opts.as_of.isoformat()).cast("date")
    return F.lit(str(opts.as_of)).cast("date")


def metric_base(curated: DataFrame, opts: MetricOptions) -> DataFrame:
    """The WHERE clause shared by the views.

    Filters are plain column predicates, so Catalyst pushes them into the
    Parquet scan (``parameter``, ``city``, ``is_extreme_outlier`` and the
    ``date_utc`` lower bound).
    """
    cond = (F.col("parameter") == F.lit(opts.parameter)) & F.col("city").isNotNull()
    if opts.require_nonblank_city:
        cond = cond & (trim_whitespace("city") != F.lit(""))
    if opts.exclude_outliers:
        # Three-valued: a null flag is excluded, as NOT NULL is not true.
        cond = cond & ~F.col("is_extreme_outlier")
    if opts.lookback_days is not None:
        # Inclusive lower bound, no upper bound: 8 calendar days for 7.
        cond = cond & (F.to_date("date_utc") >= F.date_sub(_as_of(opts), opts.lookback_days))
    return curated.where(cond)


def daily_avg(curated: DataFrame, opts: MetricOptions = MetricOptions.warehouse()) -> DataFrame:
    """Average and count of readings per (city, country, UTC day)."""
    return (
        metric_base(curated, opts)
        .groupBy("city", "country", F.to_date("date_utc").alias("reading_date"))
        .agg(_avg(opts).alias("avg_pm25"), F.count(F.lit(1)).alias("reading_count"))
    )


def breach_rate(
    curated: DataFrame, opts: MetricOptions = MetricOptions.warehouse()
) -> DataFrame:
    """Share of readings strictly above the guideline per (city, country, day)."""
    breaches = F.sum(F.when(F.col("value") > F.lit(float(opts.guideline)), 1).otherwise(0))
    total = F.count(F.lit(1))
    return (
        metric_base(curated, opts)
        .groupBy("city", "country", F.to_date("date_utc").alias("reading_date"))
        .agg(
            total.alias("total_readings"),
            breaches.cast("bigint").alias("breaches"),
            rounded_pct(breaches, total).alias("breach_pct"),
        )
    )


def weekly_avg(curated: DataFrame, opts: MetricOptions = MetricOptions.warehouse()) -> DataFrame:
    """Average per (city, country, Monday-started week); never date-windowed."""
    return (
        metric_base(curated, opts.trend())
        .groupBy("city", "country", week_start("date_utc").alias("week_start"))
        .agg(_avg(opts).alias("avg_pm25"))
    )


def wow_trend(
    curated: DataFrame, opts: MetricOptions = MetricOptions.warehouse(), ordered: bool = False
) -> DataFrame:
    """Week-over-week change of the weekly average.

    The previous value is the previous *present* week of the same city
    (``LAG``). Partitioning by city only interleaves same-named cities of
    different countries; ``country`` is added to the order to make ties
    deterministic. One window operator serves all three LAG uses.
    ``ordered`` sorts by (city, week_start, country) for presentation.
    """
    weekly = weekly_avg(curated, opts)
    part = ["city", "country"] if opts.partition_by_country else ["city"]
    w = Window.partitionBy(*part).orderBy("week_start", "country")
    prev = F.lag("avg_pm25").over(w)
    if opts.require_adjacent_week:
        prev_week = F.lag("week_start").over(w)
        prev = F.when(prev_week == F.col("week_start") - F.expr("INTERVAL 7 DAYS"), prev)
    out = weekly.select(
        "city",
        "country",
        "week_start",
        "avg_pm25",
        prev.alias("prev_week_avg_pm25"),
        rounded_pct(F.col("avg_pm25") - prev, prev).alias("pct_change_wow"),
    )
    return out.orderBy("city", "week_start", "country") if ordered else out


def flagged_outliers(
    curated: DataFrame, opts: MetricOptions = MetricOptions.warehouse(), ordered: bool = True
) -> DataFrame:
    """Flagged readings for review (no city filter), newest first."""
    out = curated.where(
        (F.col("parameter") == F.lit(opts.parameter)) & F.col("is_extreme_outlier")
    ).select(*OUTLIER_COLUMNS)
    return out.orderBy(F.col("date_utc").desc()) if ordered else out


VIEWS = {
    "vw_daily_avg_pm25_by_city": daily_avg,
    "vw_who_threshold_breach_rate": breach_rate,
    "vw_wow_pm25_trend": wow_trend,
    "vw_flagged_outliers": flagged_outliers,
}


def publish_views(
    spark: SparkSession, curated: DataFrame, opts: MetricOptions = MetricOptions.warehouse()
) -> list[str]:
    """Register the metric views as temporary views; returns their names.

    The ``athena`` profile has no flagged-outlier view.
    """
    names = []
    for name, view in VIEWS.items():
        if name == "vw_flagged_outliers" and not opts.exclude_outliers:
            spark.catalog.dropTempView(name)  # of an earlier publication
            continue
        if name == "vw_wow_pm25_trend":
            # Only the warehouse trend view is ordered (city, week_start).
            df = view(curated, opts, ordered=opts.exclude_outliers)
        else:
            df = view(curated, opts)
        df.createOrReplaceTempView(name)
        names.append(name)
    curated.createOrReplaceTempView("curated_readings")
    return names
