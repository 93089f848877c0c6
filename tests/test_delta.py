"""Delta curation and mergeable metric state against full runs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from airloom.operators import metric_state as MS
from airloom.operators import metrics as M
from airloom.options import MetricOptions, QualityRules
from airloom.plans import jobs as J
from airloom.sinks.raw import new_landing, reading_record, replace_runs, write_raw
from airloom.sources.curated import read_curated
from airloom.sources.run_log import entry_path
from airloom.streaming.delta import compact, curate_delta, read_delta, winners

DAYS = ["2025-03-02", "2025-03-03"]


def rows(spark, run_id, seed, n=40, days=DAYS, cities=True):
    r = random.Random(seed)
    data = []
    for i in range(n):
        day = r.choice(days)
        utc = r.choice([f"{day}T{r.randrange(4):02d}:00:00Z", f"{day}T01:00:00Z", "no time", None])
        station = r.choice([11, 12, 13, None])
        data.append((day, run_id, i, station, r.choice([-1.0, 3.25, 17.5, 600.0, float(i)]), utc, f"town {station}" if cities else None))
    df = spark.createDataFrame(data, "date string, run_id string, pos long, id long, v double, utc string, city string")
    record = reading_record(F.col("id"), F.col("v"), F.col("utc"), F.lit("n"), F.col("city"), F.lit("EE"))
    return df.select("date", "run_id", "pos", record.alias("record"))


def table(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


def full(spark, raw, out):
    J.curate(spark, raw, out)
    return table(read_curated(spark, out))


def test_delta_equals_full_runs(spark, tmp_path):
    raw, root, ck = (str(tmp_path / n) for n in ("raw", "table", "ck"))
    steps = [
        ("b", rows(spark, "run_b", 1)),
        ("a, before it in order", rows(spark, "run_a", 2)),
        ("c, one day", rows(spark, "run_c", 3, days=DAYS[:1])),
        ("a again, fewer", rows(spark, "run_a", 2).where("pos % 3 = 0")),
        ("a again, more", rows(spark, "run_a", 4, 60)),
    ]
    for n, (name, part) in enumerate(steps):
        replace_runs(part, raw)
        got = curate_delta(spark, raw, root, ck)
        assert table(read_delta(spark, root)) == full(spark, raw, str(tmp_path / f"full{n}")), name
        assert (got["rebuilt"] > 0) == name.startswith("a again")
    # Nothing new: nothing is read, nothing changes.
    assert curate_delta(spark, raw, root, ck) == {"candidates": 0, "changed": 0, "rebuilt": 0}
    before = table(read_delta(spark, root))
    compact(spark, root, DAYS)
    keys = ["date", "location_id", "parameter", "date_utc"]
    assert table(read_delta(spark, root)) == before
    assert winners(spark, root).groupBy(*keys).count().where("count > 1").count() == 0


def test_work_follows_the_new_rows(spark, tmp_path):
    raw, root, ck = (str(tmp_path / n) for n in ("raw", "table", "ck"))
    replace_runs(rows(spark, "run_a", 5, 400), raw)
    first = curate_delta(spark, raw, root, ck)
    replace_runs(rows(spark, "run_b", 5, 400), raw)  # later copies of the same keys
    second = curate_delta(spark, raw, root, ck)
    assert first["changed"] == first["candidates"] > 0
    assert second["candidates"] == first["candidates"] and second["changed"] == 0
    replace_runs(rows(spark, "run_c", 6, 1), raw)
    assert curate_delta(spark, raw, root, ck)["candidates"] <= 1


def test_landing_committed_after_the_stream_saw_its_lines(spark, tmp_path):
    raw, root, ck = (str(tmp_path / n) for n in ("raw", "table", "ck"))
    replace_runs(rows(spark, "run_a", 7), raw)
    landing, part = new_landing(), rows(spark, "run_0", 8)
    write_raw(part, raw, landing=landing)
    curate_delta(spark, raw, root, ck)
    assert table(read_delta(spark, root)) == full(spark, raw, str(tmp_path / "f0"))
    counts = part.groupBy("date", "run_id").agg(F.count(F.lit(1)).alias("rows")).withColumn("landing", F.lit(landing))
    counts.write.parquet(entry_path(raw, landing))
    assert curate_delta(spark, raw, root, ck)["rebuilt"] == 2
    assert table(read_delta(spark, root)) == full(spark, raw, str(tmp_path / "f1"))
    assert curate_delta(spark, raw, root, ck)["rebuilt"] == 0


def test_a_rebuild_without_its_voids_does_not_count(spark, tmp_path):
    raw, root, ck = (str(tmp_path / n) for n in ("raw", "table", "ck"))
    replace_runs(rows(spark, "run_a", 9), raw)
    curate_delta(spark, raw, root, ck)
    before = table(read_delta(spark, root))
    dead = winners(spark, root).drop("batch").withColumns({"_file": F.lit("0"), "value": F.lit(1.0)})
    dead.write.partitionBy("date").parquet(f"{root}/winners/batch=rebuilt-0")
    assert table(read_delta(spark, root)) == before


def test_global_scope_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        curate_delta(spark, str(tmp_path), str(tmp_path / "t"), str(tmp_path / "c"), rules=QualityRules(dedup_scope="global"))


@pytest.mark.parametrize("profile", ["warehouse", "athena"])
def test_partials_merge_to_the_views(spark, tmp_path, profile):
    raw, out, state = (str(tmp_path / n) for n in ("raw", "out", "state"))
    make = MetricOptions.athena if profile == "athena" else MetricOptions.warehouse
    opts = make(exact=True, **({"as_of": "2025-03-08"} if profile == "athena" else {}))
    assert MS.daily_avg(MS.read_partials(spark, state), opts).collect() == []
    for n, days in enumerate((DAYS, DAYS[1:], DAYS[:1])):
        replace_runs(rows(spark, f"run_{n}", n, 60, days), raw)
        J.curate(spark, raw, out, dates=days)
        held = {d: os.path.getmtime(f"{state}/date={d}") for d in DAYS if os.path.exists(f"{state}/date={d}")}
        MS.update_partials(spark, read_curated(spark, out), state, days, opts)
        assert all(os.path.getmtime(f"{state}/date={d}") == t for d, t in held.items() if d not in days)
        cur, now = read_curated(spark, out), MS.read_partials(spark, state)
        assert table(MS.daily_avg(now, opts)) == table(M.daily_avg(cur, opts))
        assert table(MS.breach_rate(now, opts)) == table(M.breach_rate(cur, opts))
        assert table(MS.weekly_avg(now)) == table(M.weekly_avg(cur, opts))
    MS.update_partials(spark, read_curated(spark, out).where(F.col("date") != DAYS[0]), state, DAYS[:1], opts)
    assert {r.date for r in MS.read_partials(spark, state).collect()} == {DAYS[1]}
