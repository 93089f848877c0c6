"""Landings only add files; curated runs are seen whole or not at all."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from airloom.__main__ import main
from airloom.options import QualityRules
from airloom.plans import jobs as J
from airloom.sinks.raw import new_landing, reading_record, replace_runs, write_raw
from airloom.sinks.versions import current, publish, read_versioned, write_version
from airloom.sources.curated import read_curated
from airloom.sources.raw import read_raw
from landings import reading

DAY = "2025-11-09"


def run_rows(spark, run_id, values, date=DAY):
    rows = [(date, run_id, i, 40 + i, float(v), f"{date}T{i:02d}:00:00Z") for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "date string, run_id string, pos long, id long, v double, utc string")
    return df.select("date", "run_id", "pos", reading_record(F.col("id"), F.col("v"), F.col("utc")).alias("record"))


def files(root):
    found = {}
    for folder, _, names in os.walk(root):
        for n in names:
            if not n.startswith((".", "_")):
                path = os.path.join(folder, n)
                with open(path, "rb") as f:
                    found[path] = hashlib.sha256(f.read()).hexdigest()
    return found


def landed(spark, root, **kw):
    return sorted((r._file.rsplit("/", 1)[-1], r._pos, r.record and r.record.value) for r in read_raw(spark, root, **kw).collect())


def test_landings_keep_every_byte_of_others(spark, tmp_path):
    root = tmp_path / "raw"
    day = root / f"date={DAY}"
    os.makedirs(day)
    # One array of the source pipeline, one file of lines of another writer, with a broken line.
    extra = reading(id=3, value="12.5", coordinates={"latitude": 1}, sensorsId=77)
    (day / "run_030000.json").write_text(json.dumps([extra, reading(id=4)]))
    (day / "part-other.json").write_text(json.dumps({"run_id": "other", "pos": 0, "record": extra}) + "\n{broken\n")
    before = files(root)
    replace_runs(run_rows(spark, "mine", [1, 2, 3]), str(root))
    replace_runs(run_rows(spark, "mine", [7, 8]), str(root))
    after = files(root)
    assert all(after[p] == h for p, h in before.items())
    seen = read_raw(spark, str(root), layout="auto", with_raw=True, with_corrupt=True)
    assert sum(r._corrupt for r in seen.collect()) == 1
    mine = [(r._pos, r.record.value) for r in seen.collect() if r._file == "mine"]
    assert sorted(mine) == [(0, 7.0), (1, 8.0)]
    kept = seen.where(F.try_variant_get("raw", "$.coordinates.latitude", "int") == 1)
    assert kept.where(F.try_variant_get("raw", "$.value", "string") == "12.5").count() == 2


def test_only_committed_landings_and_only_their_days_replace(spark, tmp_path):
    root = str(tmp_path / "raw")
    other_day = "2025-11-10"
    replace_runs(run_rows(spark, "a", [1]).unionByName(run_rows(spark, "a", [2], other_day)), root)
    write_raw(run_rows(spark, "a", [9]), root, landing=new_landing())  # dies before its log entry
    assert landed(spark, root, layout="lines") == [("a", 0, 1.0), ("a", 0, 2.0)]
    counts = replace_runs(run_rows(spark, "a", [5, 6], other_day), root)
    assert [tuple(r) for r in counts.collect()] == [(other_day, "a", 2)]
    assert landed(spark, root, layout="lines") == [("a", 0, 1.0), ("a", 0, 5.0), ("a", 1, 6.0)]
    assert replace_runs(run_rows(spark, "a", [1]).limit(0), root).count() == 0
    assert len(landed(spark, root, layout="lines")) == 3


def test_a_first_landing_that_dies_reads_as_none(spark, tmp_path):
    root = str(tmp_path / "raw")
    write_raw(run_rows(spark, "a", [1, 2]), root, landing=new_landing())
    assert landed(spark, root, layout="lines") == [] and landed(spark, root, layout="auto") == []


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_ingested_runs_are_curated_with_defaults(spark, tmp_path, layout):
    pages, details = tmp_path / "pages.json", tmp_path / "details.json"
    results = [{"locationsId": i, "value": float(i), "datetime": {"utc": f"2025-11-09T0{i}:00:00Z"}, "odd": [i]} for i in (1, 2, 3)]
    pages.write_text(json.dumps({"page": 1, "results": results}))
    details.write_text(json.dumps({"location_id": 2, "results": [{"name": "two", "locality": "Lucca", "country": {"code": "IT"}}]}))
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    for _ in range(2):
        main(["ingest", "--pages", str(pages), "--details", str(details), "--dimension", str(tmp_path / "dim"),
              "--raw", raw, "--run-id", "run_x", "--layout", layout])
    main(["curate", "--raw", raw, "--out", out])
    assert sorted((r.location_id, r.city) for r in read_curated(spark, out).collect()) == [(1, None), (2, "Lucca"), (3, None)]
    odd = read_raw(spark, raw, layout="auto", with_raw=True).select(F.try_variant_get("raw", "$.odd[0]", "int").alias("x"))
    assert sorted(r.x for r in odd.collect()) == [1, 2, 3]


@pytest.mark.parametrize("versioned", [False, True])
@pytest.mark.parametrize("scope", ["partition", "global"])
def test_a_run_over_nothing_erases_nothing(spark, tmp_path, scope, versioned):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    replace_runs(run_rows(spark, "a", [1, 2]), raw)
    rules = QualityRules(dedup_scope=scope)
    read = read_versioned if versioned else read_curated
    J.curate(spark, raw, out, rules=rules, versioned=versioned)
    os.makedirs(tmp_path / "empty")
    replace_runs(run_rows(spark, "bad", [-1, 9999]), str(tmp_path / "invalid"))
    for nothing in ("missing", "empty", "invalid"):
        J.curate(spark, str(tmp_path / nothing), out, rules=rules, versioned=versioned)
        assert read(spark, out).count() == 2


def test_a_run_that_dies_before_its_switch_is_not_seen(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    replace_runs(run_rows(spark, "a", [1, 2]).unionByName(run_rows(spark, "a", [3], "2025-11-10")), raw)
    J.curate(spark, raw, out, versioned=True)
    first = current(spark, out)
    reader = read_versioned(spark, out)
    dead = write_version(reader.withColumn("value", F.lit(0.0)), out)
    assert sorted(r.value for r in read_versioned(spark, out).collect()) == [1.0, 2.0, 3.0]
    replace_runs(run_rows(spark, "a", [4], "2025-11-10"), raw)
    J.curate(spark, raw, out, dates=["2025-11-10"], versioned=True)
    now = current(spark, out)
    assert now[DAY] == first[DAY] and now["2025-11-10"] not in (first["2025-11-10"], dead)
    assert sorted(r.value for r in read_versioned(spark, out).collect()) == [1.0, 2.0, 4.0]
    # A reader that began before the switch still has its files.
    assert sorted(r.value for r in reader.collect()) == [1.0, 2.0, 3.0]


def test_two_runs_from_one_manifest_cannot_both_switch(spark, tmp_path):
    out = str(tmp_path / "out")
    publish(spark, out, "v1", ["2025-11-09"])
    from airloom.sinks import versions

    stale = versions._manifests
    versions._manifests = lambda *a: []  # a run that saw the table before the first switch
    try:
        with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
            publish(spark, out, "v2", ["2025-11-10"])
    finally:
        versions._manifests = stale
    assert current(spark, out) == {"2025-11-09": "v1"}


@pytest.mark.parametrize("size", [3, 4, 11, 50])
def test_a_large_run_lands_in_several_arrays_and_keeps_its_positions(spark, tmp_path, monkeypatch, size):
    from airloom.sinks import raw as sink
    from airloom.sources.raw import read_raw

    monkeypatch.setattr(sink, "ARRAY_RECORDS", size)
    root, day = str(tmp_path / "raw"), tmp_path / "raw" / "date=2025-01-01"
    records = lambda n: spark.range(n).selectExpr("(id * 7) % 11 AS pos", "named_struct('value', cast(id as double)) AS record")
    files = lambda: sorted(p.name for p in day.iterdir() if not p.name.startswith("."))
    sink.write_run_array(records(11), root, "2025-01-01", "run_1")
    assert len(files()) == -(-11 // size) and files()[0] == "run_1.json"
    arrays = [json.loads((day / f).read_text()) for f in files()]
    assert max(map(len, arrays)) <= size
    got = read_raw(spark, root, layout="auto").orderBy("_file", "_pos").select("_pos", "record.value").collect()
    want = [float(i) for i in sorted(range(11), key=lambda i: i * 7 % 11)]
    assert [tuple(r) for r in got] == list(enumerate(want)) and sum(arrays, []) == [{"value": v} for v in want]
    sink.write_run_array(records(2), root, "2025-01-01", "run_10")
    sink.write_run_array(records(2), root, "2025-01-01", "run_1")  # again, with fewer: no old part stays
    assert files() == ["run_1.json", "run_10.json"]
    sink.write_run_array(records(0), root, "2025-01-01", "run_1")
    assert json.loads((day / "run_1.json").read_text()) == []
