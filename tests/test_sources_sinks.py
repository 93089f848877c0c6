"""Raw landing scans (both layouts), curated sink semantics, table registration."""

import json
import os

import pytest
from pyspark.sql import functions as F

from airloom.plans import jobs as J
from airloom.sinks.raw import reading_record, write_raw
from airloom.sources.curated import read_curated, register_table
from airloom.sources.raw import read_raw, read_raw_dates
from landings import reading


def land_array(root, date, name, records, indent=2):
    d = os.path.join(root, f"date={date}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as fh:
        fh.write(json.dumps(records, indent=indent))


def test_array_layout_reads_pretty_printed_files_in_order(spark, tmp_path):
    root = str(tmp_path / "raw")
    land_array(root, "2025-10-16", "run_090000.json", [reading(id=1), reading(id=2, value=3.0)])
    land_array(root, "2025-10-16", "run_100000.json", [reading(id=3)], indent=None)
    with open(os.path.join(root, "date=2025-10-16", "notes.txt"), "w") as fh:
        fh.write("not json")
    df = read_raw(spark, root)
    assert dict(df.dtypes)["date"] == "string"
    rows = df.select("date", "_file", "_pos", "record.locationsId").collect()
    got = sorted((r._file.rsplit("/", 1)[1], r._pos, r.locationsId) for r in rows)
    # _pos orders the rows within a file.
    assert [(f, i) for f, _, i in got] == [("run_090000.json", 1), ("run_090000.json", 2),
                                           ("run_100000.json", 3)]
    assert {r.date for r in rows} == {"2025-10-16"}


def test_array_layout_keeps_legacy_date_key(spark, tmp_path):
    root = str(tmp_path / "raw")
    legacy = {"locationId": 7, "value": 2.0, "date": {"utc": "2025-10-16T10:00:00Z"}}
    land_array(root, "2025-10-16", "run_1.json", [legacy])
    from airloom.operators import clean as C
    from airloom.options import FlattenOptions

    row = C.flatten_readings(read_raw(spark, root), opts=FlattenOptions(profile="deployed")).first()
    assert (row.date, row.location_id, row.date_utc) == ("2025-10-16", 7, "2025-10-16T10:00:00Z")


def test_missing_root_gives_empty_frame(spark, tmp_path):
    df = read_raw(spark, str(tmp_path / "nothing"))
    assert df.count() == 0 and df.columns == ["date", "_file", "_pos", "record"]
    assert read_curated(spark, str(tmp_path / "nothing")).count() == 0


ODD_ARRAY = """[{"locationsId": 1, "value": "12.5", "datetime": {"utc": "2025-10-16T10:00:00Z"}},
 {"locationsId": 4.0, "value": 2.5, "datetime": {"utc": "2025-10-16T10:00:00Z"}},
 {"locationsId": "7", "value": 1e2, "location_meta": {"name": 3}, "datetime": {"utc": "2025-10-16T10:00:00Z"}},
 {"locationsId": 4.5, "value": true, "location_meta": "x"}, 5, null,
 {"locationsId": 9, "value": 3, "datetime": {"utc": "2025-10-16T10:00:00Z"}}]"""


def odd_landing(root):
    land_array(root, "2025-10-16", "run_1.json", [reading(id=1)])
    folder = os.path.join(root, "date=2025-10-16")
    for name, text in {"run_2": ODD_ARRAY, "run_3": "[{not json", "run_4": ODD_ARRAY[:200], "run_5": '{"locationsId": 1}', "run_6": "[]"}.items():
        with open(os.path.join(folder, f"{name}.json"), "w") as fh:
            fh.write(text)


def test_one_odd_value_harms_no_other(spark, tmp_path):
    root = str(tmp_path / "raw")
    odd_landing(root)
    rows = read_raw(spark, root, with_corrupt=True).collect()
    by_file = {}
    for r in sorted(rows, key=lambda r: (r._file, r._pos or 0)):
        by_file.setdefault(r._file.rsplit("/", 1)[1], []).append(r)
    got = [(r._pos, r._corrupt, r.record and r.record.locationsId, r.record and r.record.value) for r in by_file["run_2.json"]]
    assert got == [(0, False, 1, None), (1, False, 4, 2.5), (2, False, 7, 100.0), (3, False, None, None), (4, True, None, None), (5, True, None, None), (6, False, 9, 3.0)]
    for name in ("run_3.json", "run_4.json", "run_5.json"):  # one marked row for a whole file
        assert [(r._pos, r._corrupt) for r in by_file[name]] == [(None, True)]
    assert "run_6.json" not in by_file and len(rows) == 11


def test_rows_do_not_depend_on_the_columns(spark, tmp_path):
    root = str(tmp_path / "raw")
    odd_landing(root)
    df = read_raw(spark, root)
    n = len(df.collect())
    assert df.count() == n == len(df.select("date").collect()) == len(df.select("record.locationsId").collect()) == len(df.select("record.value").collect())


def test_failfast_fails(spark, tmp_path):
    root = str(tmp_path / "raw")
    odd_landing(root)
    with pytest.raises(Exception):
        read_raw(spark, root, mode="FAILFAST").collect()


def test_unreadable_parts_are_counted(spark, tmp_path):
    root, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    odd_landing(root)
    counts = J.curate(spark, root, out, layout="array")
    assert (counts["rows_read"], counts["malformed_records"], counts["malformed_files"]) == (11, 2, 3)
    assert sorted(r.location_id for r in read_curated(spark, out).collect()) == [1, 4, 7, 9]


def test_date_selection_rejects_prefixes(spark, tmp_path):
    root = str(tmp_path / "raw")
    land_array(root, "2025-10-16", "run_1.json", [reading(id=1)])
    land_array(root, "2025-10-17", "run_1.json", [reading(id=2)])
    assert read_raw_dates(spark, root, ["2025-10-17"]).count() == 1
    with pytest.raises(ValueError):
        read_raw_dates(spark, root, ["2026-08"])


def _lines(spark, root, rows):
    df = spark.createDataFrame(rows, "date string, run_id string, pos long, id long, v double, "
                                     "utc string")
    write_raw(df.select("date", "run_id", "pos",
                        reading_record(F.col("id"), F.col("v"), F.col("utc"),
                                       F.lit("n"), F.lit("C"), F.lit("K")).alias("record")),
              root)


def test_lines_layout_round_trip_and_curate(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    _lines(spark, raw, [("2025-10-16", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z"),
                        ("2025-10-16", "run_2", 0, 1, 9.0, "2025-10-16T10:00:00Z"),
                        ("2025-10-17", "run_1", 1, 2, -1.0, "2025-10-17T10:00:00Z")])
    J.curate(spark, raw, out)
    rows = read_curated(spark, out).collect()
    assert [(r.date, r.location_id, r.value) for r in rows] == [("2025-10-16", 1, 5.0)]
    # 2025-10-17 had no valid row: no partition written.
    assert [d for d in os.listdir(out) if d.startswith("date=")] == ["date=2025-10-16"]


def test_rerun_is_idempotent_and_empty_rerun_keeps_partition(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    _lines(spark, raw, [("2025-10-16", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z")])
    J.curate(spark, raw, out)
    J.curate(spark, raw, out)
    assert read_curated(spark, out).count() == 1
    bad = str(tmp_path / "raw_bad")
    _lines(spark, bad, [("2025-10-16", "run_9", 0, 1, -1.0, "2025-10-16T11:00:00Z")])
    J.curate(spark, bad, out)
    assert [r.value for r in read_curated(spark, out).collect()] == [5.0]


def test_dynamic_overwrite_replaces_only_present_dates(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    _lines(spark, raw, [("2025-10-16", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z"),
                        ("2025-10-17", "run_1", 1, 2, 6.0, "2025-10-17T10:00:00Z")])
    J.curate(spark, raw, out)
    again = str(tmp_path / "raw2")
    _lines(spark, again, [("2025-10-17", "run_2", 0, 2, 7.0, "2025-10-17T10:00:00Z")])
    J.curate(spark, again, out)
    got = {r.date: r.value for r in read_curated(spark, out).collect()}
    assert got == {"2025-10-16": 5.0, "2025-10-17": 7.0}


def test_register_table_discovers_new_partitions(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    _lines(spark, raw, [("2025-10-16", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z")])
    J.curate(spark, raw, out)
    t = register_table(spark, "cur_t1", out)
    assert t.count() == 1
    _lines(spark, raw, [("2025-10-18", "run_1", 0, 3, 6.0, "2025-10-18T10:00:00Z")])
    J.curate(spark, raw, out, dates=["2025-10-18"])
    assert register_table(spark, "cur_t1", out).count() == 2
    spark.sql("DROP TABLE cur_t1")


def test_global_scope_curates_first_landing_across_dates(spark, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "cur")
    _lines(spark, raw, [("2025-10-16", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z"),
                        ("2025-10-17", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z")])
    from airloom.options import QualityRules

    J.curate(spark, raw, out, rules=QualityRules(dedup_scope="global"))
    assert [(r.date, r.location_id) for r in read_curated(spark, out).collect()] == [
        ("2025-10-16", 1)]
    J.curate(spark, raw, str(tmp_path / "cur2"))
    assert read_curated(spark, str(tmp_path / "cur2")).count() == 2


def test_array_layout_order_survives_file_packing(spark, tmp_path):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    root = str(tmp_path / "raw")
    for d in range(2):
        for f in range(6):
            land_array(root, f"2026-08-2{d}", f"run_{f:03d}.json",
                       [reading(id=f, value=float(i), utc=f"2026-08-2{d}T00:00:{i:02d}Z")
                        for i in range(40)], indent=1)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = read_raw(spark, root)
        assert df.rdd.getNumPartitions() < 12  # several files share a task
        w = Window.partitionBy("_file").orderBy("_pos")
        ranked = df.select("_file", "_pos", F.col("record.value").alias("v")).withColumn(
            "rank", F.row_number().over(w) - 1)
        assert ranked.where(F.col("rank").cast("double") != F.col("v")).count() == 0
        assert ranked.count() == 480
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", str(4 * 1024 * 1024))


def test_lines_layout_malformed_policy(spark, tmp_path):
    raw = str(tmp_path / "raw")
    _lines(spark, raw, [("2025-10-16", "run_1", 0, 1, 5.0, "2025-10-16T10:00:00Z")])
    with open(os.path.join(raw, "date=2025-10-16", "broken.json"), "w") as fh:
        fh.write('{"run_id": "run_2", "pos": 0, "record": {not json\n\n{"run_id": "run_3", "pos": 1, "record": {"value": "x", "locationsId": 3.0}}\n')
    df = read_raw(spark, raw, layout="lines", with_corrupt=True)
    rows = df.collect()
    assert df.count() == 3 and sorted(r._corrupt for r in rows) == [False, False, True]
    assert [(r.record.locationsId, r.record.value) for r in rows if r._file == "run_3"] == [(3, None)]
    with pytest.raises(Exception):
        read_raw(spark, raw, layout="lines", mode="FAILFAST").collect()


def test_table_name_follows_its_root(spark, tmp_path):
    for n in (1, 2):
        raw, out = str(tmp_path / f"raw{n}"), str(tmp_path / f"cur{n}")
        _lines(spark, raw, [("2025-10-16", "run_1", i, i, 5.0, "2025-10-16T10:00:00Z") for i in range(n)])
        J.curate(spark, raw, out)
        assert register_table(spark, "cur_moved", out).count() == n
    assert read_curated(spark, str(tmp_path / "cur1")).count() == 1
    spark.sql("DROP TABLE cur_moved")


def test_partial_run_in_global_scope_is_refused(spark, tmp_path):
    from airloom.options import QualityRules

    with pytest.raises(ValueError):
        J.curate(spark, str(tmp_path / "raw"), str(tmp_path / "cur"), dates=["2025-10-16"], rules=QualityRules(dedup_scope="global"))


def test_landing_writes_few_files_per_day(spark, tmp_path):
    raw = str(tmp_path / "raw")
    rows = [(f"2026-08-{1 + i % 20:02d}", "run_1", i, i, 5.0, "2025-10-16T10:00:00Z") for i in range(400)]
    df = spark.createDataFrame(rows, "date string, run_id string, pos long, id long, v double, utc string").repartition(16)
    write_raw(df.select("date", "run_id", "pos", reading_record(F.col("id"), F.col("v"), F.col("utc")).alias("record")), raw)
    files = [f for d in os.listdir(raw) if d.startswith("date=") for f in os.listdir(os.path.join(raw, d)) if f.endswith(".json")]
    assert len(files) == 20


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from airloom.session import shared_dir

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError):
        shared_dir(Session())


def test_a_line_is_parsed_once_and_not_shuffled_without_a_log(spark, tmp_path):
    from airloom.operators import clean

    day = tmp_path / "raw" / "date=2025-10-16"
    day.mkdir(parents=True)
    (day / "part-0.json").write_text(json.dumps({"run_id": "r", "pos": 1, "record": reading(id=1)}) + "\n")
    flat = clean.flatten_readings(read_raw(spark, str(tmp_path / "raw"), layout="lines"))
    plan = clean.drop_invalid(flat)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "Join" not in plan
    assert clean.drop_invalid(flat).count() == 1
