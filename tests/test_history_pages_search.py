"""Page envelopes, history and backfill, catalogue search."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from airloom.operators import dimension as D
from airloom.operators import history as H
from airloom.operators import search as S
from airloom.plans import jobs as J
from airloom.schema import LOCATION_PAGE, LOCATION_RESULT, MEASUREMENT_PAGE, READINGS_PAGE
from airloom.sinks.raw import order_key
from airloom.sources.pages import explode_pages, latest_readings, parse_envelope
from airloom.sources.raw import read_raw

START = dt.datetime(2026, 3, 1, 22)


def page_frame(spark, sizes):
    """Pages 1, 2, ... of that many readings each; the value counts on through all pages."""
    rows, n = [], 0
    for page, size in enumerate(sizes, 1):
        rows.append((page, json.dumps({"results": [{"locationsId": page, "value": float(n + i)} for i in range(size)]})))
        n += size
    return parse_envelope(spark.createDataFrame(rows, "page long, text string").repartition(3), "text", READINGS_PAGE)


def values(df):
    return [r.result.value for r in df.orderBy("page", "pos").collect()]


@pytest.mark.parametrize(
    "sizes, page_size, limit, kept",
    [
        ([4, 4, 4], 4, None, 12),
        ([4, 2, 4], 4, None, 6),  # a short page is the last one
        ([4, 0, 4], 4, None, 4),
        ([4, 4, 4], 4, 5, 5),
        ([4, 2, 4], None, None, 10),
        ([0], 4, None, 0),
    ],
)
def test_pages_stop_and_limit(spark, sizes, page_size, limit, kept):
    got = explode_pages(page_frame(spark, sizes), page_size=page_size, limit=limit)
    assert len(values(got)) == kept and values(got) == sorted(values(got))


def test_a_fetch_without_limit_returns_everything(spark):
    pages = page_frame(spark, [1000, 1000, 300])
    assert latest_readings(pages).count() == 2300
    assert values(latest_readings(pages, 1100)) == [float(i) for i in range(1100)]


def test_order_key_does_not_collide(spark):
    rows = [(p, i) for p in (1, 2, 3) for i in (0, 1, 999, 1000, 1001, 2**31 - 1)]
    df = spark.createDataFrame(rows, "page long, pos long").withColumn("k", order_key(F.col("page"), F.col("pos")))
    assert [(r.page, r.pos) for r in df.orderBy("k").collect()] == rows


# -- history of several stations: sensor = station * 10 + 2, one reading an hour ------


def history(spark, hours, page_size=7):
    """hours: {station: hours after START}; None and '' stand for themselves."""
    rows = []
    for station, own in hours.items():
        for at in range(0, len(own), page_size):
            results = []
            for h in own[at : at + page_size]:
                utc = h if h is None or h == "" else (START + dt.timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M:%SZ")
                results.append({"value": float(h or 0), "period": {"datetimeFrom": {"utc": utc}}})
            rows.append((station * 10 + 2, at // page_size + 1, json.dumps({"results": results})))
    return spark.createDataFrame(rows, "sensor_id long, page long, text string")


def station_details(spark, ids, without_sensor=()):
    rows = []
    for i in ids:
        sensors = [] if i in without_sensor else [{"id": i * 10 + 2, "parameter": {"id": 2, "name": "p"}}]
        rows.append((i, json.dumps({"results": [{"name": f"s{i}", "locality": f"town {i % 3}", "country": {"code": "EE"}, "sensors": sensors}]})))
    return spark.createDataFrame(rows, "location_id long, text string")


def landed(spark, root):
    rows = read_raw(spark, root, layout="lines").collect()
    return sorted((r.date, r._file, r.record.value) for r in rows)


def test_reshape_and_day_bounds(spark):
    sensors = D.resolve_sensor(parse_envelope(station_details(spark, [3, 4, 5], [4]), "text", LOCATION_PAGE), 2)
    pages = parse_envelope(history(spark, {3: [0, 1, 2, 26], 4: [0], 9: [0]}), "text", MEASUREMENT_PAGE)
    results = explode_pages(pages, group_cols=["sensor_id"])

    def got(**bounds):
        return sorted((r.location_id, r.value) for r in H.reshape_measurements(results, sensors, **bounds).collect())

    assert got() == [(3, 0.0), (3, 1.0), (3, 2.0), (3, 26.0)]  # 4 has no sensor, 9 no station
    assert got(datetime_from="2026-03-02") == [(3, 2.0), (3, 26.0)]
    assert got(datetime_from="2026-03-01", datetime_to="2026-03-02") == [(3, 0.0), (3, 1.0)]
    assert got(datetime_from=dt.date(2026, 3, 2), datetime_to="2026-03-03", inclusive_to=True) == [(3, 2.0), (3, 26.0)]


def test_cap_keeps_the_first_in_fetch_order(spark):
    df = spark.createDataFrame([(s, 1 + i // 3, i % 3) for s in (1, 2) for i in range(5 * s)], "location_id long, page long, pos long")
    got = sorted((r.location_id, r.page, r.pos) for r in H.cap_per_location(df.repartition(3), 4).collect())
    assert got == [(s, 1 + i // 3, i % 3) for s in (1, 2) for i in range(4)]


def test_backfill_lands_by_reading_day(spark, tmp_path):
    root = str(tmp_path / "bf")
    rows = J.backfill_rows(history(spark, {3: [0, 1, 2, None, 3, ""], 7: [1, 30]}), station_details(spark, [3, 7]))
    counts = {(r.date, r.location_id): r.readings for r in J.backfill_job(rows, root).collect()}
    assert counts == {("2026-03-01", 3): 2, ("2026-03-02", 3): 2, ("2026-03-01", 7): 1, ("2026-03-03", 7): 1}
    assert sorted(d for d in os.listdir(root) if d[0] == "d") == ["date=2026-03-01", "date=2026-03-02", "date=2026-03-03"]
    assert {r.record.location_meta.city for r in read_raw(spark, root, layout="lines").collect()} == {"town 0", "town 1"}
    before = landed(spark, root)
    J.backfill_job(rows, root)  # again: nothing is doubled
    assert landed(spark, root) == before


def test_a_second_backfill_replaces_only_its_station_days(spark, tmp_path):
    root, details = str(tmp_path / "bf"), station_details(spark, [3, 7, 8])
    only = lambda *ids: spark.createDataFrame([(i,) for i in ids], "location_id long")
    J.backfill_job(J.backfill_rows(history(spark, {3: [0, 1, 2], 7: [0, 5]}), details, stations=only(3, 7)), root)
    J.backfill_job(J.backfill_rows(history(spark, {3: [9], 7: [1], 8: [0]}), details, stations=only(7, 8)), root)
    assert landed(spark, root) == [
        ("2026-03-01", "backfill_location_3", 0.0),
        ("2026-03-01", "backfill_location_3", 1.0),
        ("2026-03-01", "backfill_location_7", 1.0),
        ("2026-03-01", "backfill_location_8", 0.0),
        ("2026-03-02", "backfill_location_3", 2.0),
        ("2026-03-02", "backfill_location_7", 5.0),
    ]


def test_backfill_takes_the_last_days(spark):
    long_ago = -24 * 9000
    rows = J.backfill_rows(history(spark, {3: [long_ago, -24 * 61, -24 * 59, 0, 24, 49]}), station_details(spark, [3]), days=60, as_of="2026-03-02")
    assert sorted(r.value for r in rows.collect()) == [-24.0 * 59, 0.0, 24.0]
    assert J.backfill_rows(history(spark, {3: [long_ago]}), station_details(spark, [3])).count() == 1


def test_backfill_of_no_station_lands_nothing(spark, tmp_path):
    root = str(tmp_path / "bf")
    none = spark.createDataFrame([], "location_id long")
    rows = J.backfill_rows(history(spark, {3: [0]}), station_details(spark, [3]), stations=none)
    assert J.backfill_job(rows, root).count() == 0 and not os.path.exists(root)


# -- catalogue ---------------------------------------------------------------------


@pytest.fixture
def catalogue(spark):
    towns = ["Lucca", "Porto", None, "Lago di Lucca", "Gdansk"]
    rows = [(i, f"unit {i:02d}", towns[i % 5], ("IT" if i % 2 else "PL", "x"), [(i * 10, (2 if i % 3 else 1, "p"))]) for i in range(30)]
    return spark.createDataFrame(rows, LOCATION_RESULT).repartition(4)


def test_search_finds_all_and_limits_what_it_found(catalogue):
    italian = [i for i in range(30) if i % 2 and i % 3]
    assert [r.id for r in S.search_locations(catalogue, "IT", 2).orderBy("id").collect()] == italian
    lucca = [i for i in italian if i % 5 in (0, 3)]
    got = S.find_locations(catalogue, "IT", search="LUCCA").orderBy("id").collect()
    assert [r.id for r in got] == lucca and {r.country for r in got} == {"IT"}
    assert [r.id for r in S.find_locations(catalogue, "IT", search="lucca", limit=2).collect()] == lucca[:2]
    first = [i for i in italian[:4] if i in lucca]
    assert [r.id for r in S.find_locations(catalogue, "IT", search="lucca", limit=4, limit_before_search=True).orderBy("id").collect()] == first
    assert S.find_locations(catalogue, "IT", search="%").count() == 0
    assert {r.locality for r in S.find_locations(catalogue, "PL").collect()} >= {"", "Porto"}
