"""Hot keys: results stay whole and exact; plans pre-reduce before shuffling."""

import datetime as dt

from pyspark.sql import functions as F

from airloom.operators import clean as C
from airloom.operators import dimension as D
from airloom.operators import metrics as M
from airloom.options import MetricOptions
from airloom.plans.explain import plan_text


def flat_rows(spark, n=3000):
    """A third of the rows are copies of one reading (station 1, one time)
    spread over many files; the rest are distinct readings."""
    rows = []
    for i in range(n):
        if i % 3 == 0:
            rows.append((f"run_{i % 50:03d}", i, 1, "pm25", 10.0 + (i % 7), "2025-10-16T10:00:00Z"))
        else:
            ts = (dt.datetime(2025, 10, 16) + dt.timedelta(minutes=i)).strftime("%Y-%m-%dT%H:%M:%SZ")
            rows.append((f"run_{i % 50:03d}", i, 2 + i % 5, "pm25", float(i % 100), ts))
    df = spark.createDataFrame(
        rows, "_file string, _pos long, location_id long, parameter string, value double, "
              "date_utc string")
    return df.select(
        "_file", "_pos", "location_id", F.lit("n").alias("location_name"),
        F.lit("C").alias("city"), F.lit("K").alias("country"), "parameter", "value",
        F.lit("u").alias("unit"), "date_utc").repartition(8)


def test_hot_duplicate_key_keeps_first_copy(spark):
    cur = C.clean_readings(flat_rows(spark)).cache()
    assert cur.count() == 2000 + 1
    hot = cur.where("location_id = 1").collect()
    # First copy in landing order: file run_000, position 0 -> value 10.0.
    assert [r.value for r in hot] == [10.0]
    cur.unpersist()


def test_partial_limit_runs_before_the_exchange(spark):
    plan = plan_text(C.clean_readings(flat_rows(spark)))
    tree = plan.split("\n\n")[0]
    exchange_line = next(i for i, l in enumerate(tree.splitlines()) if "Exchange" in l and
                         "Broadcast" not in l and i > 0 and "WindowGroupLimit" in
                         tree.splitlines()[i - 2] + tree.splitlines()[i - 1])
    below = "\n".join(tree.splitlines()[exchange_line:])
    assert "WindowGroupLimit" in below


def test_hot_station_daily_average_is_exact(spark):
    rows = []
    for i in range(3000):
        loc = 1 if i % 3 == 0 else 2 + i % 50
        ts = dt.datetime(2025, 10, 16) + dt.timedelta(seconds=i)
        rows.append((loc, "n", "Hot" if loc == 1 else f"c{loc}", "K", "pm25", float(i % 10), "u",
                     ts, False))
    df = spark.createDataFrame(rows, "location_id long, location_name string, city string, "
                                     "country string, parameter string, value double, "
                                     "unit string, date_utc timestamp_ntz, "
                                     "is_extreme_outlier boolean").repartition(8)
    got = {r.city: (r.avg_pm25, r.reading_count)
           for r in M.daily_avg(df, MetricOptions.warehouse(exact=True)).collect()}
    hot_vals = [float(i % 10) for i in range(0, 3000, 3)]
    assert got["Hot"] == (sum(hot_vals) / len(hot_vals), 1000)
    plan = plan_text(M.daily_avg(df, MetricOptions.warehouse(exact=True)))
    assert plan.count("HashAggregate") >= 2  # partial aggregation before the exchange


def test_null_ids_spread_in_lookup_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        readings = spark.range(3000).select(
            F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 100)
            .cast("bigint").alias("location_id"),
            F.col("id").cast("double").alias("value"))
        dim = spark.range(100).select(
            F.col("id").alias("location_id"), F.lit("n").alias("name"),
            F.concat(F.lit("c"), F.col("id").cast("string")).alias("city"),
            F.lit("K").alias("country"))
        out = D.enrich(readings, dim)
        assert "SortMergeJoin" in plan_text(out)
        rows = out.collect()
        assert len(rows) == 3000
        assert sum(r.location_meta.city is None for r in rows) == 1000
        assert all(r.location_meta.city == f"c{r.location_id}" for r in rows
                   if r.location_id is not None)
        # Null-id rows land in many shuffle partitions, not one (AQE would
        # merge this tiny shuffle, so partition merging is off here).
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        parts = (D.enrich(readings, dim).where(F.col("location_id").isNull())
                 .select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_hot_station_partition_is_split_by_aqe(spark, tmp_path):
    """A third of the readings on one station: the sort-merge lookup join is
    re-planned by AQE with the skewed partition split (test-sized thresholds)."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        readings = spark.range(30000).select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 1000 + 2)
            .cast("bigint").alias("location_id"),
            F.col("id").cast("double").alias("value"))
        spark.range(1100).select(
            F.col("id").alias("location_id"), F.lit("n").alias("name"),
            F.concat(F.lit("c"), F.col("id").cast("string")).alias("city"),
            F.lit("K").alias("country")).write.parquet(str(tmp_path / "dim"))
        out = D.enrich(readings, spark.read.parquet(str(tmp_path / "dim")))
        rows = out.collect()
        assert len(rows) == 30000
        assert all(r.location_meta.city == f"c{r.location_id}" for r in rows)
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    import os

    from airloom.schema import CURATED_PARTITIONED
    from airloom.sinks.curated import write_curated

    rows = [(i, "n", "C", "K", "pm25", float(i), "u",
             dt.datetime(2025, 10, 16) + dt.timedelta(seconds=i), False,
             "2025-10-16" if i % 10 else "2025-10-17")
            for i in range(20000)]
    df = spark.createDataFrame(rows, CURATED_PARTITIONED).repartition(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        write_curated(df, str(tmp_path / "cur"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    hot = [f for f in os.listdir(tmp_path / "cur" / "date=2025-10-16") if f.endswith(".parquet")]
    assert len(hot) > 1
    assert spark.read.parquet(str(tmp_path / "cur")).count() == 20000
