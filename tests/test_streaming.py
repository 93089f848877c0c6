"""Incremental curation: new files re-curate whole dates; reruns do nothing."""

from pyspark.sql import functions as F

from airloom.sinks.raw import reading_record, write_raw
from airloom.sources.curated import read_curated
from airloom.streaming import incremental
from airloom.streaming.incremental import curate_incremental


def land(spark, root, rows):
    df = spark.createDataFrame(rows, "date string, run_id string, pos long, id long, v double, "
                                     "utc string")
    write_raw(df.select("date", "run_id", "pos",
                        reading_record(F.col("id"), F.col("v"), F.col("utc"),
                                       F.lit("n"), F.lit("C"), F.lit("K")).alias("record")),
              root)


def test_incremental_curation(spark, tmp_path):
    raw, out, ck = (str(tmp_path / p) for p in ("raw", "cur", "ck"))
    land(spark, raw, [("2025-10-16", "run_2", 0, 1, 9.0, "2025-10-16T10:00:00Z"),
                      ("2025-10-16", "run_2", 1, 2, 3.0, "2025-10-16T10:00:00Z")])
    assert curate_incremental(spark, raw, out, ck) == ["2025-10-16"]
    assert read_curated(spark, out).count() == 2
    # Nothing new: nothing processed.
    assert curate_incremental(spark, raw, out, ck) == []
    # An earlier run landing later for the same date and key wins keep-first,
    # and the date keeps its other rows.
    land(spark, raw, [("2025-10-16", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z")])
    assert curate_incremental(spark, raw, out, ck) == ["2025-10-16"]
    got = sorted((r.location_id, r.value) for r in read_curated(spark, out).collect())
    assert got == [(1, 5.0), (2, 3.0)]


def test_incremental_curation_of_array_landings(spark, tmp_path):
    import json
    import os

    from landings import reading

    raw, out, ck = (str(tmp_path / p) for p in ("raw", "cur", "ck"))

    def land(date, name, records):
        d = os.path.join(raw, f"date={date}")
        os.makedirs(d, exist_ok=True)
        with open(os.path.join(d, name), "w") as fh:
            fh.write(json.dumps(records, indent=2))

    land("2025-10-16", "run_100000.json", [reading(id=1, value=9.0), reading(id=2, value=3.0)])
    assert curate_incremental(spark, raw, out, ck, layout="array") == ["2025-10-16"]
    assert curate_incremental(spark, raw, out, ck, layout="array") == []
    land("2025-10-16", "run_090000.json", [reading(id=1, value=5.0)])
    land("2025-10-17", "run_090000.json", [reading(id=3, value=4.0, utc="2025-10-17T01:00:00Z")])
    assert curate_incremental(spark, raw, out, ck, layout="array") == ["2025-10-16", "2025-10-17"]
    got = sorted((r.date, r.location_id, r.value) for r in read_curated(spark, out).collect())
    assert got == [("2025-10-16", 1, 5.0), ("2025-10-16", 2, 3.0), ("2025-10-17", 3, 4.0)]


def stations_of(spark, out):
    return sorted((r.date, r.location_id) for r in read_curated(spark, out).collect())


def test_stream_keeps_what_other_roots_landed(spark, tmp_path):
    raw, more, out, ck = (str(tmp_path / p) for p in ("raw", "backfill", "cur", "ck"))
    land(spark, raw, [("2025-10-16", "run_1", 0, 1, 9.0, "2025-10-16T10:00:00Z")])
    land(spark, more, [("2025-10-16", "backfill_location_2", 0, 2, 9.0, "2025-10-16T10:00:00Z")])
    assert curate_incremental(spark, [raw, more], out, ck) == ["2025-10-16"]
    land(spark, raw, [("2025-10-16", "run_2", 0, 3, 9.0, "2025-10-16T10:00:00Z")])
    assert curate_incremental(spark, [raw, more], out, ck) == ["2025-10-16"]
    assert stations_of(spark, out) == [("2025-10-16", i) for i in (1, 2, 3)]
    land(spark, more, [("2025-10-17", "backfill_location_4", 0, 4, 9.0, "2025-10-17T10:00:00Z")])
    assert curate_incremental(spark, [raw, more, str(tmp_path / "none")], out, ck) == ["2025-10-17"]
    assert stations_of(spark, out)[-1] == ("2025-10-17", 4)


def test_failed_curation_is_made_up_for(spark, tmp_path, monkeypatch):
    import pytest

    raw, out, ck = (str(tmp_path / p) for p in ("raw", "cur", "ck"))
    land(spark, raw, [("2025-10-16", "run_1", 0, 1, 9.0, "2025-10-16T10:00:00Z")])

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "curate", fail)
        with pytest.raises(RuntimeError):
            curate_incremental(spark, raw, out, ck)
    assert curate_incremental(spark, raw, out, ck) == ["2025-10-16"]
    assert stations_of(spark, out) == [("2025-10-16", 1)]
    assert curate_incremental(spark, raw, out, ck) == []


def test_global_scope_empties_dates_of_stale_copies(spark, tmp_path):
    from airloom.options import QualityRules

    raw, out, ck = (str(tmp_path / p) for p in ("raw", "cur", "ck"))
    rules = QualityRules(dedup_scope="global")
    land(spark, raw, [("2025-10-17", "run_1", 0, 1, 9.0, "2025-10-16T10:00:00Z")])
    curate_incremental(spark, raw, out, ck, rules=rules)
    assert stations_of(spark, out) == [("2025-10-17", 1)]
    land(spark, raw, [("2025-10-16", "run_1", 0, 1, 9.0, "2025-10-16T10:00:00Z")])
    curate_incremental(spark, raw, out, ck, rules=rules)
    assert stations_of(spark, out) == [("2025-10-16", 1)]
