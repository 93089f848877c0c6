"""The job runner on landed files."""

import json
import os

from airloom.__main__ import main
from airloom.sinks.dimension import read_dimension
from airloom.sources.curated import read_curated
from airloom.sources.raw import read_raw
from landings import reading


def test_curate_views_and_find(spark, tmp_path):
    raw = tmp_path / "raw" / "date=2025-10-16"
    os.makedirs(raw)
    (raw / "run_090000.json").write_text(json.dumps([reading(id=1, value=20.0), reading(id=6)],
                                                    indent=2))
    out = str(tmp_path / "cur")
    main(["curate", "--raw", str(tmp_path / "raw"), "--out", out])
    assert read_curated(spark, out).count() == 2
    streamed = str(tmp_path / "streamed")
    main(["stream", "--raw", str(tmp_path / "raw"), "--out", streamed,
          "--checkpoint", str(tmp_path / "ck")])
    assert read_curated(spark, streamed).count() == 2
    main(["views", "--curated", out, "--out", str(tmp_path / "views"),
          "--profile", "warehouse"])
    daily = spark.read.parquet(str(tmp_path / "views" / "vw_daily_avg_pm25_by_city"))
    assert [(r.avg_pm25, r.reading_count) for r in daily.collect()] == [(15.75, 2)]
    cat = tmp_path / "cat.json"
    cat.write_text("\n".join(json.dumps(r) for r in [
        {"id": 5, "name": "Harbour", "locality": "Nova Gorica", "country": {"code": "SI"},
         "sensors": [{"id": 9, "parameter": {"id": 2, "name": "pm25"}}]},
        {"id": 6, "name": "Other", "locality": "Celje", "country": {"code": "SI"},
         "sensors": [{"id": 8, "parameter": {"id": 2, "name": "pm25"}}]}]))
    main(["find", "--catalogue", str(cat), "--country", "SI", "--search", "va gor",
          "--out", str(tmp_path / "found")])
    found = spark.read.option("header", True).csv(str(tmp_path / "found")).collect()
    assert [r.id for r in found] == ["5"]


def test_backfill_and_ingest(spark, tmp_path):
    det, meas, pages = (tmp_path / f"{n}.json" for n in ("details", "meas", "pages"))
    det.write_text("\n".join(json.dumps({"location_id": i, "results": [
        {"name": f"s{i}", "locality": f"town {i}", "country": {"code": "EE"},
         "sensors": [{"id": i + 500, "parameter": {"id": 2, "name": "p"}}]}]}) for i in (6, 8)))
    days = ["2026-05-01", "2026-05-20", "2026-05-21", "2026-05-22"]
    meas.write_text("\n".join(json.dumps({"sensor_id": i + 500, "page": 1, "results": [
        {"value": 5.0, "period": {"datetimeFrom": {"utc": f"{d}T23:00:00Z"}}} for d in days]})
        for i in (6, 8)))
    main(["backfill", "--measurements", str(meas), "--details", str(det), "--days", "2",
          "--as-of", "2026-05-21", "--stations", "8", "--out", str(tmp_path / "bf")])
    landed = read_raw(spark, str(tmp_path / "bf"), layout="lines").collect()
    assert sorted((r.date, r.record.locationsId) for r in landed) == [
        ("2026-05-20", 8), ("2026-05-21", 8)]
    pages.write_text(json.dumps({"page": 1, "results": [
        {"locationsId": i, "value": 7.0, "datetime": {"utc": "2026-08-03T10:00:00Z"}}
        for i in (6, 8, 9)]}))
    main(["ingest", "--pages", str(pages), "--details", str(det),
          "--dimension", str(tmp_path / "dim"), "--raw", str(tmp_path / "runs")])
    towns = sorted(r.city for r in read_dimension(spark, str(tmp_path / "dim")).collect())
    assert towns == ["town 6", "town 8"]
    assert read_raw(spark, str(tmp_path / "runs"), layout="lines").count() == 3
