"""Search by postings, merged sketches, limits by prefix sums, legacy files of unlike footers."""

import datetime as dt
import json
import os
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from airloom.operators import search as S
from airloom.operators import search_index as SI
from airloom.operators import sketches as SK
from airloom.operators.ordering import with_sum_before
from airloom.schema import LOCATION_RESULT, READINGS_PAGE
from airloom.sources import pages as P
from airloom.sources.curated import read_legacy_curated


def catalogue(spark):
    names = ["Åker", "aa aa", None, "", "x", "Aab%_", "lake Åland", "aaa", "Å"]
    sensors = [{"id": 1, "parameter": {"id": 2, "name": "p"}}]
    rows = [(i, n, names[-i - 1], {"code": "FI", "name": "f"}, sensors) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, LOCATION_RESULT)


@pytest.mark.parametrize("needle", [None, "", "a", "Å", "aa", "aaa", "a a", "%_", "ÅLAND", "aab%", "zzz", "aa aa a"])
def test_search_by_postings_is_the_scan(spark, tmp_path, needle):
    cat, root = catalogue(spark), str(tmp_path / "postings")
    SI.write_postings(cat, root)
    want = sorted(map(tuple, S.find_locations(cat, "FI", needle).collect()))
    assert sorted(map(tuple, SI.find_indexed(cat, root, "FI", needle).collect())) == want
    assert SI.find_indexed(cat, root, "SE", needle).collect() == []


def test_search_reads_the_lists_of_the_needle_only(spark, tmp_path):
    root = str(tmp_path / "postings")
    SI.write_postings(catalogue(spark), root)
    plan = SI.candidates(spark, root, "land")._jdf.queryExecution().toString()
    assert "In(gram" in plan or "gram IN" in plan or "gram#" in plan and "PushedFilters: [In(gram" in plan
    assert SI.candidates(spark, str(tmp_path / "none"), "land").collect() == []


def readings(spark, ids, date):
    rows = [(date, i, "c" if i is not None and i % 3 else None) for i in ids]
    return spark.createDataFrame(rows, "date string, location_id long, city string")


def test_sketches_of_dates_merge_and_are_replaced(spark, tmp_path):
    root, r = str(tmp_path / "sketches"), random.Random(1)
    days = {d: [r.randrange(60_000) for _ in range(20_000)] + [None] * 50 for d in ("d1", "d2", "d3")}
    write = lambda d, ids: SK.update_sketches(SK.station_sketches(readings(spark, ids, d), F.col("city")), root)
    write("d2", [-5])
    for d, ids in days.items():
        write(d, ids)
    for some in (["d2"], ["d1", "d3"], list(days)):
        seen = {i for d in some for i in days[d]} - {None}
        kept = SK.read_sketches(spark, root, some)
        n = SK.distinct_locations_approx(kept).first()[0]
        assert abs(n - len(seen)) <= SK.hll_error() * len(seen)
        got, want = SK.coverage_approx(kept).first(), len([i for i in seen if i % 3]) / len(seen)
        assert abs(got.distinct_locations - len(seen)) <= SK.theta_error() * len(seen)
        assert abs(got.coverage - want) <= SK.theta_error()
    none = SK.read_sketches(spark, str(tmp_path / "nothing"))
    assert SK.distinct_locations_approx(none).first()[0] == 0
    assert tuple(SK.coverage_approx(none).first()) == (0, 0, None)


@pytest.mark.parametrize("sizes", [[4, 4, 4, 4], [4, 4, 2, 4], [4, 0, 4], [3], [], [4, None, 4], [4, 4, 4, 1]])
@pytest.mark.parametrize("limit", [1, 4, 5, 8, 100])
def test_limit_by_prefix_sums_is_the_fetch(spark, monkeypatch, sizes, limit):
    monkeypatch.setattr(P, "PAGE_SIZE_CAP", 4)
    size = min(limit, 4)
    pages, fetched = [], []
    for p, n in enumerate(sizes):
        results = [{"locationsId": p * 10 + i, "value": 1.0} for i in range(min(n or 0, size))]
        pages.append((p + 1, "no json" if n is None else json.dumps({"results": results})))
    for p, (_, text) in enumerate(pages):
        results = json.loads(text)["results"] if text != "no json" else []
        fetched += [(p + 1, i, r["locationsId"]) for i, r in enumerate(results)]
        if len(results) < size or len(fetched) >= limit:
            break
    df = spark.createDataFrame(pages, "page long, text string").repartition(3)
    rows = P.results_of(df, READINGS_PAGE, limit).select("page", "pos", "result.locationsId")
    assert sorted(map(tuple, rows.collect())) == fetched[:limit]


def test_sums_before(spark):
    rows = [(i * 37 % 101, i % 5 or None) for i in range(101)]
    df = spark.createDataFrame(rows, "k int, v long").repartition(6)
    total, want = 0, {}
    for k, v in sorted(rows):
        want[k] = total
        total += v or 0
    assert {r.k: r.before for r in with_sum_before(df, "v", "k").collect()} == want
    assert with_sum_before(df.limit(0), "v", "k").collect() == []


def test_legacy_files_of_unlike_footers(spark, tmp_path):
    def day(date, **columns):
        folder = tmp_path / "legacy" / f"date={date}"
        os.makedirs(folder)
        base = {"location_id": [1, 2], "location_name": ["a", None], "city": ["A", "B"], "country": ["SE", "SE"], "parameter": ["pm25"] * 2,
                "value": [5.0, 6.0], "unit": ["u", "u"], "date_utc": pd.to_datetime([f"{date}T01:00:00Z", f"{date}T02:30:00.25Z"], utc=True, format="ISO8601"),
                "is_extreme_outlier": [False, True]}
        pd.DataFrame({k: v for k, v in (base | columns).items() if v is not ...}).to_parquet(folder / "readings.parquet", index=False)

    day("2025-06-01")
    day("2025-06-02", location_id=[1.0, None])
    day("2025-06-03", city=[None, None])
    day("2025-06-04", unit=...)
    day("2025-06-05", date_utc=pd.to_datetime(["2025-06-05T01:00:00", "2025-06-05T02:30:00.25"], format="ISO8601").astype("datetime64[us]"))
    setting = spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", None)
    rows = read_legacy_curated(spark, str(tmp_path / "legacy")).collect()
    assert spark.conf.get("spark.sql.legacy.parquet.nanosAsLong", None) in (setting, "false")
    assert len(rows) == 10
    by = {(r.date[-1], r.value): r for r in rows}
    for d in "12345":
        assert by[d, 6.0].date_utc == dt.datetime(2025, 6, int(d), 2, 30, 0, 250000) and by[d, 6.0].is_extreme_outlier
    assert by["2", 6.0].location_id is None and by["1", 6.0].location_id == 2
    assert by["3", 5.0].city is None and by["4", 5.0].unit is None and by["5", 5.0].unit == "u"
    assert read_legacy_curated(spark, str(tmp_path / "nothing")).collect() == []


def test_stations_of_a_sequence_share_a_list(spark):
    """The index has a row per sequence and batch of stations, not one per station."""
    rows = [(i, f"Customer#{i:06d}", "Ås" if i % 2 else None, {"code": "FI", "name": "f"}, []) for i in range(400)]
    cat = spark.createDataFrame([*rows, (None, "Customer", "x", None, [])], LOCATION_RESULT)
    lists = SI.postings(cat).collect()
    of = lambda gram: sorted(i for r in lists if r["gram"] == gram for i in r["ids"])
    assert len(lists) < 400 * 4
    assert of("cus") == of("#") == list(range(400)) and of("ås") == list(range(1, 400, 2)) and of("x") == []
    grams = lambda t: {t[a : a + n] for n in (1, 2, 3) for a in range(len(t) - n + 1)}
    for i in (0, 17, 399):
        want = grams(f"customer#{i:06d}") | (grams("ås") if i % 2 else set())
        assert {r["gram"] for r in lists if i in r["ids"]} == want
