"""Cleaning equals a brute-force statement of the rules on random batches."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from airloom.operators import clean as C
from airloom.options import QualityRules
from landings import raw_frame, reading

# Timestamp spellings and what they mean (UTC wall clock), None = unparseable.
STAMPS = {
    "2025-10-16T10:00:00Z": dt.datetime(2025, 10, 16, 10),
    "2025-10-16T10:00:00+00:00": dt.datetime(2025, 10, 16, 10),
    "2025-10-16T12:00:00+02:00": dt.datetime(2025, 10, 16, 10),
    "2025-10-16 10:00:00": dt.datetime(2025, 10, 16, 10),
    "2025-10-16": dt.datetime(2025, 10, 16, 0),
    "2025-10-16T11:00:00Z": dt.datetime(2025, 10, 16, 11),
    "not-a-date": None,
    "": None,
    "10:00": None,
}
VALUES = [None, math.nan, -1.0, -999.0, 9999.0, 99999.0, -0.5, 0.0, 15.0, 15.1, 500.0, 500.1,
          800.0, 12.5]

LANDED = st.tuples(
    st.sampled_from([None, 1, 2, 3]),
    st.sampled_from(VALUES),
    st.sampled_from(sorted(STAMPS)),
    st.sampled_from(["run_a.json", "run_b.json", "backfill_location_1.json"]),
)


def brute_force(batch, rules=QualityRules()):
    rows = []
    positions = {}
    for loc, value, stamp, file in batch:
        pos = positions.get(file, 0)
        positions[file] = pos + 1
        rows.append(((file, pos), loc, value, stamp))
    rows.sort(key=lambda r: r[0])  # landing order: file, then position
    kept, seen = [], set()
    for _, loc, value, stamp in rows:
        if value is None or math.isnan(value) or value < rules.min_valid:
            continue
        if value in rules.sentinels:
            continue
        key = (loc, "pm25", stamp)
        if key in seen:
            continue
        seen.add(key)
        if STAMPS[stamp] is None:
            continue
        kept.append((loc, value, STAMPS[stamp], value > rules.max_plausible))
    return sorted(kept, key=repr)


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(LANDED, max_size=12))
def test_clean_matches_brute_force(spark, batch):
    records = [reading(id=loc, value=v, utc=s) for loc, v, s, _ in batch]
    files = [f for *_, f in batch]
    flat = C.flatten_readings(raw_frame(spark, records, files or None))
    got = sorted(((r.location_id, r.value, r.date_utc, r.is_extreme_outlier)
                  for r in C.clean_readings(flat).collect()), key=repr)
    assert got == brute_force(batch)


# -- metric views against a brute-force statement ----------------------------

from collections import defaultdict  # noqa: E402
from decimal import ROUND_HALF_UP, Decimal  # noqa: E402

from airloom.operators import metrics as M  # noqa: E402
from airloom.options import MetricOptions  # noqa: E402
from airloom.schema import CURATED  # noqa: E402

curated_row = st.tuples(
    st.sampled_from(["A", "B", "  ", None]),
    st.sampled_from(["X", "Y", None]),
    st.sampled_from([0.0, 3.25, 14.99, 15.0, 15.01, 42.5, 499.99, 500.5, 900.0]),
    st.integers(min_value=0, max_value=24 * 20),  # hours after 2024-01-01
)


def _round1(x):
    return float(Decimal(repr(x)).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


def _exact_avg(vals):
    return float(sum(Decimal(repr(v)).quantize(Decimal("0.0001")) for v in vals)) / len(vals)


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(curated_row, max_size=30))
def test_metrics_match_brute_force(spark, rows):
    base = dt.datetime(2024, 1, 1)
    data = [(i, "n", city, country, "pm25", v, "u", base + dt.timedelta(hours=h), v > 500)
            for i, (city, country, v, h) in enumerate(rows)]
    df = spark.createDataFrame(data, CURATED)
    opts = MetricOptions.warehouse(exact=True)
    kept = [r for r in data if r[2] is not None and not r[8]]

    groups = defaultdict(list)
    for r in kept:
        groups[(r[2], r[3], r[7].date())].append(r[5])
    want_daily = {k: (_exact_avg(v), len(v)) for k, v in groups.items()}
    got_daily = {(r.city, r.country, r.reading_date): (r.avg_pm25, r.reading_count)
                 for r in M.daily_avg(df, opts).collect()}
    assert got_daily == want_daily

    want_breach = {k: (len(v), sum(x > 15 for x in v), _round1(100.0 * sum(x > 15 for x in v)
                                                                / len(v)))
                   for k, v in groups.items()}
    got_breach = {(r.city, r.country, r.reading_date): (r.total_readings, r.breaches,
                                                         r.breach_pct)
                  for r in M.breach_rate(df, opts).collect()}
    assert got_breach == want_breach

    weeks = defaultdict(list)
    for r in kept:
        monday = (r[7] - dt.timedelta(days=r[7].weekday())).replace(hour=0)
        weeks[(r[2], r[3], monday)].append(r[5])
    weekly = sorted(((c, w, k or "", k, _exact_avg(v)) for (c, k, w), v in weeks.items()),
                    key=lambda t: (t[0], t[1], t[3] is not None, t[2]))
    want_trend, prev_by_city = {}, {}
    for city, week, _, country, avg in weekly:
        prev = prev_by_city.get(city)
        pct = None if prev is None or prev == 0 else _round1(100.0 * (avg - prev) / prev)
        want_trend[(city, country, week)] = (avg, prev, pct)
        prev_by_city[city] = avg
    got_trend = {(r.city, r.country, r.week_start): (r.avg_pm25, r.prev_week_avg_pm25,
                                                     r.pct_change_wow)
                 for r in M.wow_trend(df, opts).collect()}
    assert got_trend == want_trend


# -- page envelopes against the fetch loop --------------------------------------

import json  # noqa: E402

from airloom.schema import READINGS_PAGE  # noqa: E402
from airloom.sources.pages import latest_readings, parse_envelope  # noqa: E402


def fetch_loop(pages, limit, page_size):
    """The pager: pages 1..n until an empty or short page, then truncate."""
    results, page = [], 1
    while len(results) < limit:
        batch = pages[page - 1] if page <= len(pages) else []
        if not batch:
            break
        results.extend(batch)
        if len(batch) < page_size:
            break
        page += 1
    return results[:limit]


@settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(min_value=1, max_value=6), st.lists(st.integers(0, 6), min_size=1, max_size=6))
def test_page_reader_matches_fetch_loop(spark, limit, sizes):
    page_size = min(limit, 1000)
    pages, n = [], 0
    for size in sizes:
        pages.append([n + i for i in range(size)])
        n += size
    rows = [(i + 1, json.dumps({"results": [{"locationsId": x, "value": 1.0} for x in p]}))
            for i, p in enumerate(pages)]
    df = parse_envelope(spark.createDataFrame(rows, "page long, text string"), "text",
                        READINGS_PAGE)
    got = [r.result.locationsId for r in
           latest_readings(df, limit).orderBy("page", "pos").collect()]
    assert got == fetch_loop(pages, limit, page_size)


# -- per-station cap and catalogue search ----------------------------------------

from airloom.operators import history as H  # noqa: E402
from airloom.operators import search as S  # noqa: E402
from airloom.schema import LOCATION_RESULT  # noqa: E402


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(1, 3), st.integers(0, 20)),
                max_size=40, unique=True), st.integers(1, 5))
def test_cap_matches_brute_force(spark, rows, n):
    df = spark.createDataFrame(rows, "location_id long, page long, pos long")
    got = sorted(tuple(r) for r in H.cap_per_location(df, n).collect())
    want = []
    for loc in {r[0] for r in rows}:
        want += sorted(r for r in rows if r[0] == loc)[:n]
    assert got == sorted(want)


names = st.sampled_from(["San Francisco", "SF Bay", "oakland", "São Paulo", None, "", "Bay Area"])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(names, names, st.sampled_from(["US", "BR", None]),
                          st.sampled_from([1, 2])), max_size=12),
       st.sampled_from(["bay", "SAN", "são", "x", ""]), st.integers(1, 6))
def test_find_locations_matches_brute_force(spark, locs, needle, limit):
    rows = [(i, name, loc, (code, None), [(i * 10, (param, "p"))])
            for i, (name, loc, code, param) in enumerate(locs)]
    cat = spark.createDataFrame(rows, LOCATION_RESULT)
    got = [tuple(r) for r in S.find_locations(cat, "US", needle or None, limit).collect()]
    listed = [r for r in rows if r[3][0] == "US" and r[4][0][1][0] == 2][:limit]
    if needle:
        listed = [r for r in listed if needle.lower() in (r[1] or "").lower()
                  or needle.lower() in (r[2] or "").lower()]
    want = [(r[0], (r[1] or "")[:35], (r[2] or "")[:25], r[3][0] or "") for r in listed]
    assert got == want
