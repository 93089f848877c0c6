"""Metric views: profiles, boundaries, trend semantics, plan shape."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from airloom.operators import metrics as M
from airloom.plans.explain import plan_text
from airloom.options import MetricOptions
from airloom.schema import CURATED


def curated(spark, rows):
    """rows: (location_id, city, country, value, 'YYYY-MM-DD HH:MM:SS', outlier)."""
    data = [
        (i, f"loc-{i}", city, country, "pm25", v, "u",
         dt.datetime.fromisoformat(ts), flag)
        for i, city, country, v, ts, flag in rows
    ]
    return spark.createDataFrame(data, CURATED)


def test_daily_avg_warehouse_excludes_outliers_and_null_city(spark):
    df = curated(spark, [
        (1, "A", "X", 10.0, "2024-01-02 01:00:00", False),
        (2, "A", "X", 20.0, "2024-01-02 05:00:00", False),
        (3, "A", "X", 900.0, "2024-01-02 06:00:00", True),
        (4, None, "X", 5.0, "2024-01-02 06:00:00", False),
        (5, "  ", "X", 7.0, "2024-01-02 06:00:00", False),
    ])
    got = {(r.city, r.reading_date.isoformat()): (r.avg_pm25, r.reading_count)
           for r in M.daily_avg(df, MetricOptions.warehouse()).collect()}
    assert got == {("A", "2024-01-02"): (15.0, 2), ("  ", "2024-01-02"): (7.0, 1)}


def test_daily_avg_athena_keeps_outliers_drops_blank_and_old(spark):
    df = curated(spark, [
        (1, "A", "X", 10.0, "2024-01-30 01:00:00", False),
        (2, "A", "X", 900.0, "2024-01-30 02:00:00", True),
        (3, "A", "X", 1.0, "2024-01-22 23:59:59", False),
        (4, "A", "X", 2.0, "2024-01-23 00:00:00", False),
        (5, "\t ", "X", 7.0, "2024-01-30 06:00:00", False),
        (6, "A", "X", 3.0, "2024-02-05 00:00:00", False),
    ])
    opts = MetricOptions.athena(as_of="2024-01-30")
    got = {r.reading_date.isoformat(): (r.avg_pm25, r.reading_count)
           for r in M.daily_avg(df, opts).collect()}
    # Inclusive 7-day lower bound (8 calendar days), no upper bound.
    assert got == {"2024-01-30": (455.0, 2), "2024-01-23": (2.0, 1), "2024-02-05": (3.0, 1)}


def test_breach_rate_is_strict_and_rounded(spark):
    df = curated(spark, [
        (1, "A", "X", 15.0, "2024-01-02 01:00:00", False),
        (2, "A", "X", 15.1, "2024-01-02 02:00:00", False),
        (3, "A", "X", 30.0, "2024-01-02 03:00:00", False),
    ])
    r = M.breach_rate(df).first()
    assert (r.total_readings, r.breaches, r.breach_pct) == (3, 2, 66.7)
    assert dict(M.breach_rate(df).dtypes)["breach_pct"] == "double"


def test_week_over_week_trend(spark):
    # Weeks starting Mon 2024-01-01, 01-08, (gap 01-15), 01-22; then a 0 week.
    df = curated(spark, [
        (1, "A", "X", 10.0, "2024-01-03 00:00:00", False),
        (2, "A", "X", 20.0, "2024-01-09 00:00:00", False),
        (3, "A", "X", 10.0, "2024-01-24 00:00:00", False),
        (4, "B", "Y", 0.0, "2024-01-03 00:00:00", False),
        (5, "B", "Y", 5.0, "2024-01-10 00:00:00", False),
    ])
    rows = M.wow_trend(df).orderBy("city", "week_start").collect()
    a = [(r.week_start.isoformat()[:10], r.prev_week_avg_pm25, r.pct_change_wow)
         for r in rows if r.city == "A"]
    assert a == [("2024-01-01", None, None), ("2024-01-08", 10.0, 100.0),
                 ("2024-01-22", 20.0, -50.0)]
    b = [r.pct_change_wow for r in rows if r.city == "B"]
    assert b == [None, None]  # previous week is 0: no percentage


def test_trend_adjacent_week_option(spark):
    df = curated(spark, [
        (1, "A", "X", 10.0, "2024-01-09 00:00:00", False),
        (2, "A", "X", 20.0, "2024-01-24 00:00:00", False),
    ])
    rows = M.wow_trend(df, MetricOptions.warehouse(require_adjacent_week=True)).collect()
    assert all(r.prev_week_avg_pm25 is None for r in rows)


def test_same_city_two_countries_is_deterministic(spark):
    df = curated(spark, [
        (1, "Paris", "FR", 10.0, "2024-01-03 00:00:00", False),
        (2, "Paris", "US", 30.0, "2024-01-03 00:00:00", False),
        (3, "Paris", "FR", 20.0, "2024-01-10 00:00:00", False),
    ])
    rows = M.wow_trend(df).orderBy("week_start", "country").collect()
    # Ordered by (week_start, country) within city: FR, US, then FR of week 2.
    assert [r.prev_week_avg_pm25 for r in rows] == [None, 10.0, 30.0]
    rows = M.wow_trend(df, MetricOptions.warehouse(partition_by_country=True)).orderBy(
        "country", "week_start").collect()
    assert [r.prev_week_avg_pm25 for r in rows] == [None, 10.0, None]


def test_flagged_outliers_have_no_city_filter_and_newest_first(spark):
    df = curated(spark, [
        (1, None, "X", 800.0, "2024-01-02 01:00:00", True),
        (2, "A", "X", 900.0, "2024-01-03 01:00:00", True),
        (3, "A", "X", 9.0, "2024-01-03 01:00:00", False),
    ])
    assert [r.location_id for r in M.flagged_outliers(df).collect()] == [2, 1]


def test_exact_average_is_order_independent(spark):
    vals = [0.1] * 7 + [0.2] * 3
    df = curated(spark, [(i, "A", "X", v, "2024-01-02 01:00:00", False)
                         for i, v in enumerate(vals)])
    r = M.daily_avg(df.repartition(3), MetricOptions.warehouse(exact=True)).first()
    assert r.avg_pm25 == pytest.approx(0.13, abs=0) or r.avg_pm25 == 1.3 / 10


def test_publish_views(spark):
    df = curated(spark, [(1, "A", "X", 10.0, "2024-01-02 01:00:00", False)])
    names = M.publish_views(spark, df, MetricOptions.warehouse())
    assert "vw_flagged_outliers" in names
    assert spark.sql("SELECT count(*) AS n FROM vw_daily_avg_pm25_by_city").first().n == 1
    assert "vw_flagged_outliers" not in M.publish_views(spark, df, MetricOptions.athena())


def test_metric_filters_reach_the_parquet_scan(spark, tmp_path):
    df = curated(spark, [(1, "A", "X", 10.0, "2024-01-02 01:00:00", False)])
    df.withColumn("date", F.lit("2024-01-02")).write.partitionBy("date").parquet(
        str(tmp_path / "cur"))
    from airloom.sources.curated import read_curated

    scan = read_curated(spark, str(tmp_path / "cur"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_text(M.daily_avg(scan, MetricOptions.athena(as_of="2024-01-30")))
    pushed = plan.split("PushedFilters: ")[1].split("\n")[0]
    assert "EqualTo(parameter,pm25)" in pushed
    assert "IsNotNull(city)" in pushed
    assert "GreaterThanOrEqual(date_utc" in pushed
    # Unused columns are pruned from the scan.
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "location_name" not in read_schema and "unit" not in read_schema


def test_trend_uses_one_window_for_all_lags(spark):
    df = curated(spark, [(1, "A", "X", 10.0, "2024-01-03 00:00:00", False)])
    plan = plan_text(M.wow_trend(df, MetricOptions.warehouse(require_adjacent_week=True)))
    tree = plan.split("\n\n")[0]
    assert sum(1 for line in tree.splitlines() if line.strip().lstrip("+- ").startswith("Window ")) == 1


def test_exact_average_has_one_rule(spark):
    rows = [(i, "A", "X", 0.00000001 * i + 10**9, "2024-01-30 01:00:00", True) for i in range(5)]
    opts = MetricOptions.athena(as_of="2024-01-30", exact=True)
    got = M.daily_avg(curated(spark, rows), opts).first().avg_pm25
    assert abs(got - (10**9 + 0.00000002)) < 1e-6
    too_large = curated(spark, [(1, "A", "X", 1e36, "2024-01-30 01:00:00", True)])
    with pytest.raises(Exception, match="DECIMAL"):
        M.daily_avg(too_large, opts).collect()


def test_view_column_contracts(spark):
    df = curated(spark, [(1, "A", "X", 10.0, "2024-01-02 01:00:00", True)])
    assert M.daily_avg(df).columns == M.DAILY_COLUMNS
    assert M.breach_rate(df).columns == M.BREACH_COLUMNS
    assert M.wow_trend(df).columns == M.TREND_COLUMNS
    assert M.flagged_outliers(df).columns == M.OUTLIER_COLUMNS
