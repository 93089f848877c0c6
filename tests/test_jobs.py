"""Composite jobs, dimension versions, CSV export, legacy files, append stream."""

import datetime as dt
import json
import os

import pandas as pd
from pyspark.sql import functions as F

from airloom.operators import clean as C
from airloom.plans import jobs as J
from airloom.schema import RAW_READING
from airloom.sinks.csv import export_csv
from airloom.sinks.dimension import read_dimension
from airloom.sinks.raw import reading_record, write_raw
from airloom.sources.curated import read_legacy_curated
from airloom.sources.raw import read_raw
from airloom.streaming.incremental import clean_append_stream


def _pages(spark, value=10.0):
    results = [{"locationsId": i % 4 + 1, "value": value + i, "datetime": {"utc": f"2025-10-16T{10 + i // 4}:00:00Z"}} for i in range(8)]
    rows = [(p + 1, json.dumps({"results": results[p * 4 : p * 4 + 4]})) for p in range(2)]
    return spark.createDataFrame(rows, "page long, text string")


def test_enrich_job_lands_readings_with_metadata_and_updates_cache(spark, tmp_path, monkeypatch):
    from airloom.sources import pages as P

    monkeypatch.setattr(P, "PAGE_SIZE_CAP", 4)
    raw, root = str(tmp_path / "raw"), str(tmp_path / "dim")
    known = [(1, "old 1", "Porto", "PT"), (90, "old 90", None, "NO")]
    cache = spark.createDataFrame(known, "location_id long, name string, city string, country string")
    rows = [(i, json.dumps({"results": [{"name": f"new {i}", "locality": f"town {i}", "country": {"code": "EE"}}]})) for i in (1, 2, 3, 4, 5)]
    details = spark.createDataFrame(rows, "location_id long, text string")
    failed = spark.createDataFrame([(3,)], "location_id long")

    def run(pages, cache, run_id="run_100000"):
        return J.enrich_job(pages, details, cache, raw, run_id, "2025-10-16", root, failed)

    dim = run(_pages(spark), cache)
    wanted = {1: "old 1", 90: "old 90", 2: "new 2", 4: "new 4"}  # 3 failed, 5 was not read
    assert {r.location_id: r.name for r in dim.collect()} == wanted
    assert {r.location_id: r.name for r in read_dimension(spark, root).collect()} == wanted

    def landed():
        flat = C.flatten_readings(read_raw(spark, raw, layout="lines")).collect()
        return sorted((r.value, r.location_id, r.city, r.date_utc) for r in flat)

    towns = {1: "Porto", 2: "town 2", 3: None, 4: "town 4"}
    first = [(10.0 + i, i % 4 + 1, towns[i % 4 + 1], f"2025-10-16T{10 + i // 4}:00:00Z") for i in range(8)]
    assert landed() == first
    # No new station: no new version. The same run again replaces itself, another run is added.
    assert run(_pages(spark), read_dimension(spark, root)) is not None
    assert len(os.listdir(root)) == 1 and landed() == first
    run(_pages(spark, 50.0), read_dimension(spark, root), "run_110000")
    assert len(landed()) == 16


def test_curate_reports_counts_from_the_same_job(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    df = spark.createDataFrame(
        [("2025-10-16", "r", 0, 1, 5.0, "2025-10-16T10:00:00Z"),
         ("2025-10-17", "r", 1, 2, 800.0, "2025-10-17T10:00:00Z")],
        "date string, run_id string, pos long, id long, v double, utc string")
    write_raw(df.select("date", "run_id", "pos",
                        reading_record(F.col("id"), F.col("v"), F.col("utc")).alias("record")),
              raw)
    counts = J.curate(spark, raw, out)
    assert counts == {"rows_curated": 2, "flagged": 1, "first_date": "2025-10-16",
                      "last_date": "2025-10-17", "rows_read": 2, "malformed_records": 0,
                      "malformed_files": 0}
    nothing = J.curate(spark, str(tmp_path / "none"), str(tmp_path / "cur0"))
    assert (nothing["rows_curated"], nothing["rows_read"], nothing["first_date"]) == (0, 0, None)
    export_csv(spark, out, ["2025-10-17"], str(tmp_path / "csv"))
    text = spark.read.option("header", True).csv(str(tmp_path / "csv")).collect()
    assert [(r.location_id, r.value, r.date) for r in text] == [("2", "800.0", "2025-10-17")]


def test_legacy_pandas_files(spark, tmp_path):
    root = tmp_path / "legacy" / "date=2025-10-16"
    os.makedirs(root)
    pdf = pd.DataFrame({
        "location_id": [1.0, None], "location_name": ["a", None], "city": ["A", None],
        "country": ["US", None], "parameter": ["pm25", "pm25"], "value": [5.0, 6.0],
        "unit": ["u", "u"],
        "date_utc": pd.to_datetime(["2025-10-16T10:00:00Z", "2025-10-16T11:30:00.5Z"], utc=True,
                                   format="ISO8601"),
        "is_extreme_outlier": [False, False],
    })
    pdf.to_parquet(root / "readings.parquet", index=False)
    rows = read_legacy_curated(spark, str(tmp_path / "legacy")).orderBy("value").collect()
    assert [(r.location_id, r.date_utc, r.date) for r in rows] == [
        (1, dt.datetime(2025, 10, 16, 10, 0), "2025-10-16"),
        (None, dt.datetime(2025, 10, 16, 11, 30, 0, 500000), "2025-10-16"),
    ]
    assert dict(read_legacy_curated(spark, str(tmp_path / "legacy")).dtypes)["location_id"] \
        == "bigint"


def test_append_stream_variant(spark, tmp_path):
    src = tmp_path / "in"
    os.makedirs(src)
    recs = [{"locationsId": 1, "value": 5.0, "datetime": {"utc": "2025-10-16T10:00:00Z"}},
            {"locationsId": 1, "value": 6.0, "datetime": {"utc": "2025-10-16T10:00:00Z"}},
            {"locationsId": 2, "value": -1.0, "datetime": {"utc": "2025-10-16T10:00:00Z"}}]
    with open(src / "a.json", "w") as fh:
        fh.write("\n".join(json.dumps(r) for r in recs))
    stream = spark.readStream.schema(RAW_READING).json(str(src))
    flat = C.flatten_readings(stream.select(F.struct(*stream.columns).alias("record")))
    q = (clean_append_stream(flat).writeStream.format("memory").queryName("append_out")
         .option("checkpointLocation", str(tmp_path / "ck")).outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    rows = spark.sql("SELECT * FROM append_out").collect()
    assert len(rows) == 1 and rows[0].location_id == 1


def test_warehouse_layout(spark, tmp_path):
    from airloom.sinks.curated import write_warehouse
    from airloom.schema import CURATED

    rows = [(i % 3, "n", "C", "K", "pm25", float(i), "u", dt.datetime(2025, 10, 16, i % 24), False)
            for i in range(50)]
    write_warehouse(spark.createDataFrame(rows, CURATED), str(tmp_path / "wh"), buckets=4)
    back = spark.read.parquet(str(tmp_path / "wh"))
    assert back.count() == 50 and "load_date" in back.columns


def test_pages_of_a_run_are_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    page = json.dumps({"results": [{"locationsId": i, "value": 1.0, "datetime": {"utc": "2025-01-01T00:00:00Z"}} for i in (3, 4)]})
    pages = spark.createDataFrame([(1, page)], "page int, text string").withColumn("text", counted("text"))
    details = spark.createDataFrame([(3, '{"results":[{"name":"three"}]}')], "location_id long, text string")
    cache = spark.createDataFrame([], "location_id long, name string, city string, country string")
    J.enrich_job(pages, details, cache, str(tmp_path / "raw"), "run_1", "2025-01-01", str(tmp_path / "dim"))
    assert seen.value == 1
    rows = read_raw(spark, str(tmp_path / "raw"), layout="lines").select("record.locationsId", "record.location_meta.name").collect()
    assert sorted(map(tuple, rows)) == [(3, "three"), (4, None)]
