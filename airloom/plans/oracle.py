"""Independent SQL (DuckDB dialect) for every registered query.

Each statement re-derives the fixture from the base tables and states the
operator's semantics directly in SQL, so it shares no code with the Spark
side. Exact averages sum DECIMAL(38,4) and divide once as DOUBLE, like the
Spark operators run with ``exact=True``.
"""

from __future__ import annotations

TS = "strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ')"

RAW = f"""raw AS (
  SELECT s.src, e.event_id AS pos,
    CASE WHEN e.event_id % 401 = 0 THEN NULL ELSE e.user_id END AS location_id,
    c.c_name AS location_name,
    CASE WHEN n.n_nationkey % 12 = 11 THEN '  ' WHEN n.n_nationkey % 12 = 10 THEN NULL
         ELSE n.n_name END AS city,
    r.r_name AS country, 'pm25' AS parameter,
    CASE WHEN e.event_id % 97 = 0 THEN CAST(-1 AS DOUBLE)
         WHEN e.event_id % 101 = 0 THEN CAST(9999 AS DOUBLE)
         WHEN e.event_id % 103 = 0 THEN e.value + 600
         WHEN e.event_id % 107 = 0 THEN NULL ELSE e.value + s.src END AS value,
    'ug/m3' AS unit,
    CASE WHEN e.event_id % 211 = 0 THEN 'not-a-date' ELSE {TS} END AS date_str,
    e.ts
  FROM events e
  JOIN (SELECT 0 AS src UNION ALL SELECT 1 AS src) s ON s.src = 0 OR e.event_id % 10 = 3
  JOIN customer c ON e.user_id = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

VALID = """valid AS (
  SELECT * FROM raw
  WHERE value NOT IN (-1, -999, 9999, 99999) AND value >= 0 AND NOT isnan(value)
)"""

FIRSTS = """firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY location_id, parameter, date_str
                                 ORDER BY src, pos) AS rn
    FROM valid) WHERE rn = 1
)"""

CUR = """cur AS (
  SELECT location_id, location_name, city, country, parameter, value, unit,
         TRY_CAST(date_str AS TIMESTAMP) AS date_utc, value > 500 AS is_extreme_outlier,
         strftime(ts, '%Y-%m-%d') AS date
  FROM firsts WHERE TRY_CAST(date_str AS TIMESTAMP) IS NOT NULL
)"""

CURATED_COLS = (
    "location_id, location_name, city, country, parameter, value, unit, date_utc, "
    "is_extreme_outlier"
)
FLAT_COLS = (
    "src, pos, location_id, location_name, city, country, parameter, value, unit, "
    "date_str AS date_utc"
)

EXACT_AVG = "CAST(sum(CAST(value AS DECIMAL(38,4))) AS DOUBLE) / count(value)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


CLEAN = with_(RAW, VALID, FIRSTS, CUR)


def _metric_where(profile: str) -> str:
    cond = "parameter = 'pm25' AND city IS NOT NULL"
    if profile == "athena":
        cond += (
            " AND regexp_replace(city, '^\\s+|\\s+$', '', 'g') <> ''"
            " AND CAST(date_utc AS DATE) >= DATE '2024-01-30' - INTERVAL 7 DAY"
        )
    else:
        cond += " AND NOT is_extreme_outlier"
    return cond


def _metric_where_trend(profile: str) -> str:
    cond = "parameter = 'pm25' AND city IS NOT NULL"
    if profile == "athena":
        cond += " AND regexp_replace(city, '^\\s+|\\s+$', '', 'g') <> ''"
    else:
        cond += " AND NOT is_extreme_outlier"
    return cond


def daily_avg(profile: str) -> str:
    return CLEAN + f"""
SELECT city, country, CAST(date_utc AS DATE) AS reading_date,
       {EXACT_AVG} AS avg_pm25, count(*) AS reading_count
FROM cur WHERE {_metric_where(profile)}
GROUP BY city, country, CAST(date_utc AS DATE)"""


def breach_rate(profile: str) -> str:
    return CLEAN + f"""
SELECT city, country, CAST(date_utc AS DATE) AS reading_date,
       count(*) AS total_readings,
       CAST(SUM(CASE WHEN value > 15 THEN 1 ELSE 0 END) AS BIGINT) AS breaches,
       ROUND(CAST(100.0 AS DOUBLE) * SUM(CASE WHEN value > 15 THEN 1 ELSE 0 END)
             / NULLIF(count(*), 0), 1) AS breach_pct
FROM cur WHERE {_metric_where(profile)}
GROUP BY city, country, CAST(date_utc AS DATE)"""


def weekly(profile: str) -> str:
    return f"""weekly AS (
  SELECT city, country, date_trunc('week', date_utc) AS week_start, {EXACT_AVG} AS avg_pm25
  FROM cur WHERE {_metric_where_trend(profile)}
  GROUP BY city, country, date_trunc('week', date_utc)
)"""


def weekly_avg() -> str:
    return with_(RAW, VALID, FIRSTS, CUR, weekly("warehouse")) + """
SELECT city, country, CAST(week_start AS TIMESTAMP) AS week_start, avg_pm25 FROM weekly"""


def wow_trend(profile: str) -> str:
    return with_(RAW, VALID, FIRSTS, CUR, weekly(profile)) + """,
lagged AS (
  SELECT city, country, week_start, avg_pm25,
         LAG(avg_pm25) OVER (PARTITION BY city ORDER BY week_start, country) AS prev
  FROM weekly
)
SELECT city, country, CAST(week_start AS TIMESTAMP) AS week_start, avg_pm25,
       prev AS prev_week_avg_pm25,
       ROUND(CAST(100.0 AS DOUBLE) * (avg_pm25 - prev) / NULLIF(prev, 0), 1) AS pct_change_wow
FROM lagged"""


def wow_trend_adjacent() -> str:
    return with_(RAW, VALID, FIRSTS, CUR, weekly("warehouse")) + """,
lagged AS (
  SELECT city, country, week_start, avg_pm25,
         LAG(avg_pm25) OVER (PARTITION BY city, country ORDER BY week_start) AS prev_any,
         LAG(week_start) OVER (PARTITION BY city, country ORDER BY week_start) AS prev_week
  FROM weekly
), adj AS (
  SELECT *, CASE WHEN prev_week = week_start - INTERVAL 7 DAY THEN prev_any END AS prev
  FROM lagged
)
SELECT city, country, CAST(week_start AS TIMESTAMP) AS week_start, avg_pm25,
       prev AS prev_week_avg_pm25,
       ROUND(CAST(100.0 AS DOUBLE) * (avg_pm25 - prev) / NULLIF(prev, 0), 1) AS pct_change_wow
FROM adj"""


# Position of a reading of the latest pages in its landed run.
PLACE = "(f.page << 32) + (row_number() OVER (PARTITION BY f.page ORDER BY f.event_id) - 1)"

SQL: dict[str, str] = {
    "drop_sentinels": with_(RAW)
    + f"SELECT {FLAT_COLS} FROM raw WHERE value IS NULL OR value NOT IN (-1, -999, 9999, 99999)",
    "drop_below_floor": with_(RAW)
    + f"SELECT {FLAT_COLS} FROM raw WHERE value >= 0 AND NOT isnan(value)",
    "flag_outliers": with_(RAW, VALID)
    + f"SELECT {FLAT_COLS}, value > 500 AS is_extreme_outlier FROM valid",
    "parse_dates": with_(RAW)
    + """SELECT src, pos, location_id, location_name, city, country, parameter, value, unit,
       TRY_CAST(date_str AS TIMESTAMP) AS date_utc
FROM raw WHERE TRY_CAST(date_str AS TIMESTAMP) IS NOT NULL""",
    "dedup_first": with_(RAW, VALID, FIRSTS)
    + f"SELECT {FLAT_COLS}, value > 500 AS is_extreme_outlier FROM firsts",
    "clean_readings": CLEAN + f"SELECT {CURATED_COLS} FROM cur",
    "dedup_instant": with_(RAW)
    + """, spelled AS (
  SELECT * REPLACE (CASE WHEN src = 1 AND date_str <> 'not-a-date'
                         THEN regexp_replace(date_str, 'Z$', '+00:00') ELSE date_str END
                    AS date_str)
  FROM raw
), ok AS (
  SELECT * FROM spelled
  WHERE value NOT IN (-1, -999, 9999, 99999) AND value >= 0 AND NOT isnan(value)
), first_rows AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY location_id, parameter,
                                 TRY_CAST(date_str AS TIMESTAMP) ORDER BY src, pos) AS rn
    FROM ok) WHERE rn = 1
)
SELECT location_id, location_name, city, country, parameter, value, unit,
  TRY_CAST(date_str AS TIMESTAMP) AS date_utc, value > 500 AS is_extreme_outlier
FROM first_rows WHERE TRY_CAST(date_str AS TIMESTAMP) IS NOT NULL""",
    "daily_avg_warehouse": daily_avg("warehouse"),
    "daily_avg_athena": daily_avg("athena"),
    "breach_rate_warehouse": breach_rate("warehouse"),
    "breach_rate_athena": breach_rate("athena"),
    "weekly_avg": weekly_avg(),
    "wow_trend_warehouse": wow_trend("warehouse"),
    "wow_trend_athena": wow_trend("athena"),
    "wow_trend_adjacent": wow_trend_adjacent(),
    "flagged_outliers": CLEAN
    + """SELECT location_id, location_name, city, country, value, unit, date_utc
FROM cur WHERE parameter = 'pm25' AND is_extreme_outlier""",
    "cleaning_summary": with_(RAW, VALID, FIRSTS)
    + """, counts AS (
  SELECT count(*) AS rows_in,
    count(*) FILTER (WHERE NOT coalesce(value >= 0 AND NOT isnan(value), false)) AS below_floor,
    count(*) FILTER (WHERE coalesce(value >= 0 AND NOT isnan(value), false)
                     AND value IN (-1, -999, 9999, 99999)) AS sentinel,
    count(*) FILTER (WHERE NOT coalesce(value >= 0 AND NOT isnan(value)
                     AND value NOT IN (-1, -999, 9999, 99999), false)) AS invalid,
    count(*) FILTER (WHERE coalesce(value >= 0 AND NOT isnan(value)
                     AND value NOT IN (-1, -999, 9999, 99999), false) AND value > 500)
      AS flagged_before_dedup
  FROM raw
), after AS (
  SELECT count(*) AS deduped,
    count(*) FILTER (WHERE TRY_CAST(date_str AS TIMESTAMP) IS NULL) AS bad_date,
    count(*) FILTER (WHERE TRY_CAST(date_str AS TIMESTAMP) IS NOT NULL) AS rows_remaining,
    count(*) FILTER (WHERE TRY_CAST(date_str AS TIMESTAMP) IS NOT NULL AND value > 500)
      AS flagged_kept
  FROM firsts
)
SELECT 'rows_in' AS measure, rows_in AS n FROM counts
UNION ALL SELECT 'below_floor', below_floor FROM counts
UNION ALL SELECT 'sentinel', sentinel FROM counts
UNION ALL SELECT 'invalid', invalid FROM counts
UNION ALL SELECT 'flagged_before_dedup', flagged_before_dedup FROM counts
UNION ALL SELECT 'duplicates', (SELECT count(*) FROM valid) - deduped FROM after
UNION ALL SELECT 'bad_date', bad_date FROM after
UNION ALL SELECT 'rows_remaining', rows_remaining FROM after
UNION ALL SELECT 'flagged_kept', flagged_kept FROM after""",
}


# -- landing, curated table, streaming --------------------------------------

RAW_SCAN_SELECT = """SELECT 'run_' || CAST(src AS VARCHAR) AS run_id, pos,
  strftime(ts, '%Y-%m-%d') AS date, location_id, location_name, city, country, parameter,
  value, unit, date_str AS date_utc FROM raw"""

# Per-date dedup scope: the landing date joins the dedup key.
FIRSTS_BY_DAY = """firsts AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d'), location_id, parameter,
                                 date_str ORDER BY src, pos) AS rn
    FROM valid) WHERE rn = 1
)"""



def RAW_AND(more: str) -> str:
    """Readings of a further landing beside the fixture's."""
    return f"""more AS (
  SELECT src, pos, location_id, location_name, city, country, parameter, value, unit, date_str, ts FROM raw
  UNION ALL BY NAME {more}
)"""


VALID_OF_ALL = VALID.replace("FROM raw", "FROM more")
# One day's readings landed once more, a second later and 1.5 higher.
LATE = with_(
    RAW,
    RAW_AND("""SELECT 9 AS src, * EXCLUDE (src) REPLACE (value + 1.5 AS value,
      strftime(ts + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%SZ') AS date_str)
    FROM raw WHERE src = 0 AND pos % 211 <> 0 AND strftime(ts, '%Y-%m-%d') = '2024-01-15'"""),
    VALID_OF_ALL, FIRSTS_BY_DAY, CUR,
)

CURATED_TABLE = with_(RAW, VALID, FIRSTS_BY_DAY, CUR) + f"SELECT {CURATED_COLS}, date FROM cur"

# -- stations and pages -------------------------------------------------------

STATIONS = """st AS (
  SELECT c.c_custkey AS k, c.c_name, n.n_nationkey, n.n_name, r.r_name
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

CITY = ("CASE WHEN n_nationkey % 12 = 11 THEN '  ' WHEN n_nationkey % 12 = 10 THEN NULL "
        "ELSE n_name END")

DIM = f"""dim AS (
  SELECT k AS location_id,
    CASE WHEN k % 13 = 0 THEN NULL ELSE c_name END AS name,
    CASE WHEN k % 13 = 0 THEN NULL ELSE {CITY} END AS city,
    CASE WHEN k % 13 = 0 THEN NULL WHEN n_nationkey % 5 = 0 THEN r_name
         ELSE upper(substr(r_name, 1, 2)) END AS country
  FROM st
)"""

SENS = """sens AS (
  SELECT k AS location_id,
    CASE WHEN k % 13 = 0 OR k % 7 = 0 THEN NULL ELSE k * 10 + 2 END AS sensor_id
  FROM st
)"""

MEAS = f"""m AS (
  SELECT e.user_id * 10 + CASE WHEN e.user_id % 7 = 0 THEN 1 ELSE 2 END AS sensor_id,
    e.event_id, e.value,
    CASE WHEN e.event_id % 211 = 0 THEN '' WHEN e.event_id % 223 = 0 THEN NULL
         ELSE {TS} END AS date_utc
  FROM events e
)"""

HISTORY = """history AS (
  SELECT s.location_id, m.* FROM m JOIN sens s ON m.sensor_id = s.sensor_id
)"""

IDS = """ids AS (SELECT DISTINCT location_id FROM raw WHERE location_id IS NOT NULL)"""
CACHE = """cache AS (SELECT * FROM dim WHERE location_id % 3 <> 0)"""
TODO = """todo AS (SELECT location_id FROM ids
  WHERE location_id NOT IN (SELECT location_id FROM cache))"""

SQL.update(
    {
        "raw_scan": with_(RAW) + RAW_SCAN_SELECT,
        "raw_scan_date": with_(RAW)
        + RAW_SCAN_SELECT
        + " WHERE strftime(ts, '%Y-%m-%d') = '2024-01-15'",
        "curate_roundtrip": CURATED_TABLE,
        "curated_scan": CURATED_TABLE,
        "incremental_curation": CURATED_TABLE,
        "flatten_readings": with_(RAW) + f"SELECT {FLAT_COLS} FROM raw",
        "flatten_fallback": with_(RAW)
        + """SELECT src, pos,
  CASE WHEN pos % 4 = 1 THEN NULL ELSE location_id END AS canonical_location_id,
  CASE WHEN pos % 4 IN (0, 2) THEN date_str END AS canonical_date_utc,
  location_id AS deployed_location_id,
  CASE WHEN pos % 4 IN (0, 1) THEN date_str END AS deployed_date_utc
FROM raw""",
        "location_dim_normalize": with_(STATIONS, DIM) + "SELECT * FROM dim",
        "resolve_sensor": with_(STATIONS, SENS) + "SELECT * FROM sens",
        "enrich_readings": with_(RAW, STATIONS, DIM)
        + """SELECT r.src, r.pos, r.location_id, r.value, r.date_str AS date_utc,
  d.name AS location_name, d.city, d.country
FROM raw r LEFT JOIN dim d ON r.location_id = d.location_id""",
        "distinct_locations": with_(RAW, IDS) + "SELECT location_id FROM ids",
        "unresolved_locations": with_(RAW, STATIONS, DIM, IDS, CACHE, TODO)
        + "SELECT location_id FROM todo",
        "dim_upsert": with_(RAW, STATIONS, DIM, IDS, CACHE, TODO)
        + """SELECT * FROM cache
UNION ALL
SELECT * FROM dim WHERE location_id IN (SELECT location_id FROM todo) AND location_id % 17 <> 0""",
        "dim_cache_load": with_(STATIONS, DIM) + "SELECT * FROM dim",
        "coverage_rate": with_(RAW, STATIONS, DIM)
        + """, per AS (
  SELECT r.location_id, max(d.city IS NOT NULL) AS resolved
  FROM raw r LEFT JOIN dim d ON r.location_id = d.location_id
  WHERE r.location_id IS NOT NULL GROUP BY r.location_id
)
SELECT count(*) AS distinct_locations,
  count(*) FILTER (WHERE resolved) AS resolved_locations,
  CAST(count(*) FILTER (WHERE resolved) AS DOUBLE) / NULLIF(count(*), 0) AS coverage
FROM per""",
        "measurement_reshape": with_(STATIONS, SENS, MEAS)
        + """SELECT s.location_id, m.sensor_id, m.value, m.date_utc
FROM m JOIN sens s ON m.sensor_id = s.sensor_id
WHERE CAST(TRY_CAST(m.date_utc AS TIMESTAMP) AS DATE) >= DATE '2024-01-08'
  AND CAST(TRY_CAST(m.date_utc AS TIMESTAMP) AS DATE) < DATE '2024-01-22'""",
        "backfill_cap": with_(STATIONS, SENS, MEAS)
        + """SELECT location_id, sensor_id, value, date_utc FROM (
  SELECT s.location_id, m.sensor_id, m.value, m.date_utc,
    row_number() OVER (PARTITION BY s.location_id ORDER BY m.event_id) AS rn
  FROM m JOIN sens s ON m.sensor_id = s.sensor_id)
WHERE rn <= 24""",
        "backfill_by_date": with_(STATIONS, DIM, SENS, MEAS, HISTORY)
        + """SELECT substr(m.date_utc, 1, 10) AS date,
  'backfill_location_' || CAST(m.location_id AS VARCHAR) AS run_id,
  m.location_id, m.sensor_id, m.value, m.date_utc,
  d.name AS location_name, d.city, d.country
FROM history m
LEFT JOIN dim d ON d.location_id = m.location_id
WHERE length(m.date_utc) > 0""",
        "union_sources": with_(RAW, STATIONS, SENS, MEAS)
        + """SELECT 'run' AS origin, location_id, CAST(NULL AS BIGINT) AS sensor_id, value,
  date_str AS date_utc FROM raw
UNION ALL
SELECT 'backfill', s.location_id, m.sensor_id, m.value, m.date_utc
FROM m JOIN sens s ON m.sensor_id = s.sensor_id""",
        "location_search": with_(STATIONS)
        + f""", cat AS (
  SELECT k AS id, c_name AS name, {CITY} AS locality,
    CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE upper(substr(r_name, 1, 2)) END AS code,
    k % 7 <> 0 AS has_pm25
  FROM st
), lim AS (
  SELECT * FROM cat WHERE code = 'AM' AND has_pm25 ORDER BY id LIMIT 100
)
SELECT id, substr(coalesce(name, ''), 1, 35) AS name,
  substr(coalesce(locality, ''), 1, 25) AS locality, coalesce(code, '') AS country
FROM lim
WHERE contains(lower(coalesce(name, '')), 'nation_1')
   OR contains(lower(coalesce(locality, '')), 'nation_1')""",
        "page_explode_limit": f"""WITH pages AS (
  SELECT event_id // 1000 + 1 AS page, count(*) AS n FROM events GROUP BY 1
), rows AS (
  SELECT e.event_id // 1000 + 1 AS page,
    row_number() OVER (PARTITION BY e.event_id // 1000 ORDER BY e.event_id) - 1 AS pos,
    e.user_id AS location_id, e.value, {TS} AS date_utc
  FROM events e
)
SELECT page, pos, location_id, value, date_utc FROM rows
WHERE page <= coalesce((SELECT min(page) FROM pages WHERE n < 1000), 9223372036854775807)
ORDER BY page, pos LIMIT 2500""",
    }
)


# -- composite jobs ------------------------------------------------------------

LATEST = f"""latest AS (
  SELECT e.event_id // 1000 + 1 AS page, e.event_id, e.user_id AS location_id, e.value,
    {TS} AS date_utc
  FROM events e
), pagesizes AS (
  SELECT page, count(*) AS n FROM latest GROUP BY page
), fetched AS (
  SELECT * FROM latest
  WHERE page <= coalesce((SELECT min(page) FROM pagesizes WHERE n < 1000), 9223372036854775807)
)"""

SQL.update(
    {
        "ingest_run": with_(STATIONS, DIM, CACHE, LATEST)
        + """, run_ids AS (SELECT DISTINCT location_id FROM fetched WHERE location_id IS NOT NULL),
todo AS (SELECT location_id FROM run_ids
  WHERE location_id NOT IN (SELECT location_id FROM cache)),
newdim AS (
  SELECT * FROM cache
  UNION ALL
  SELECT * FROM dim WHERE location_id IN (SELECT location_id FROM todo)
    AND location_id % 17 <> 0
)
SELECT '2024-01-30' AS date,
  (f.page << 32) + (row_number() OVER (PARTITION BY f.page ORDER BY f.event_id) - 1) AS pos,
  f.location_id, f.value, f.date_utc, d.name AS location_name, d.city, d.country
FROM fetched f LEFT JOIN newdim d ON f.location_id = d.location_id""",
        "curate_with_backfill": with_(RAW, STATIONS, DIM, SENS, MEAS, HISTORY)
        + """, landed AS (
  SELECT 'run_' || CAST(src AS VARCHAR) AS f, pos AS p, location_id, location_name, city,
    country, value, date_str, strftime(ts, '%Y-%m-%d') AS date
  FROM raw
  UNION ALL
  SELECT 'backfill_location_' || CAST(m.location_id AS VARCHAR), m.event_id, m.location_id,
    d.name, d.city, d.country, m.value, m.date_utc, substr(m.date_utc, 1, 10)
  FROM history m
  LEFT JOIN dim d ON d.location_id = m.location_id
  WHERE length(m.date_utc) > 0
), ok AS (
  SELECT * FROM landed
  WHERE value NOT IN (-1, -999, 9999, 99999) AND value >= 0 AND NOT isnan(value)
), first_rows AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY date, location_id, date_str ORDER BY f, p) AS rn
    FROM ok) WHERE rn = 1
)
SELECT location_id, location_name, city, country, 'pm25' AS parameter, value, 'ug/m3' AS unit,
  TRY_CAST(date_str AS TIMESTAMP) AS date_utc, value > 500 AS is_extreme_outlier, date
FROM first_rows WHERE TRY_CAST(date_str AS TIMESTAMP) IS NOT NULL""",
        "metric_views_sql": with_(RAW, VALID, FIRSTS, CUR)
        + f""", d AS (
  SELECT city, country, CAST(date_utc AS DATE) AS reading_date, {EXACT_AVG} AS avg_pm25
  FROM cur WHERE {_metric_where("warehouse")}
  GROUP BY city, country, CAST(date_utc AS DATE)
), b AS (
  SELECT city, country, CAST(date_utc AS DATE) AS reading_date,
    ROUND(CAST(100.0 AS DOUBLE) * SUM(CASE WHEN value > 15 THEN 1 ELSE 0 END)
          / NULLIF(count(*), 0), 1) AS breach_pct
  FROM cur WHERE {_metric_where("warehouse")}
  GROUP BY city, country, CAST(date_utc AS DATE)
)
SELECT b.city, b.country, b.reading_date, b.breach_pct, d.avg_pm25
FROM b JOIN d ON b.city = d.city AND b.country IS NOT DISTINCT FROM d.country
  AND b.reading_date = d.reading_date""",
    }
)


# -- dedup scope over stale copies landed a day later ------------------------------

def stale_curated(scope: str) -> str:
    part = "landed, " if scope == "partition" else ""
    order = "" if scope == "partition" else "landed, "
    return with_(RAW) + f""", stale AS (
  SELECT *, strftime(ts + CASE WHEN src = 1 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END,
                     '%Y-%m-%d') AS landed
  FROM raw
), ok AS (
  SELECT * FROM stale
  WHERE value NOT IN (-1, -999, 9999, 99999) AND value >= 0 AND NOT isnan(value)
), first_rows AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {part}location_id, parameter, date_str
                                 ORDER BY {order}src, pos) AS rn
    FROM ok) WHERE rn = 1
)
SELECT location_id, location_name, city, country, parameter, value, unit,
  TRY_CAST(date_str AS TIMESTAMP) AS date_utc, value > 500 AS is_extreme_outlier,
  landed AS date
FROM first_rows WHERE TRY_CAST(date_str AS TIMESTAMP) IS NOT NULL"""


SQL.update({
    "curate_stale_copies": stale_curated("partition"),
    "curate_global_scope": stale_curated("global"),
})


# -- array landings: 4.0 is 4, a quoted value is none, a cut-off file is one bad row -----

ARRAY_ROWS = """arr AS (
  SELECT src, strftime(ts, '%Y-%m-%d') AS date,
    row_number() OVER (PARTITION BY src, strftime(ts, '%Y-%m-%d'), pos // 100000 ORDER BY pos) - 1
      AS place, * EXCLUDE (src)
  FROM raw
)"""
ARRAY_SELECT = """SELECT src, date, place AS pos, location_id, location_name, city, country,
  parameter, {value} AS value, unit, date_str AS date_utc, false AS corrupt FROM arr"""
QUOTED = "CASE WHEN pos % 29 = 0 THEN NULL ELSE value END"
ODD_RAW = RAW.replace("raw AS (", "raw0 AS (", 1) + f""", raw AS (
  SELECT * REPLACE ({QUOTED} AS value) FROM raw0
)"""

# The second backfill fetches five readings of its stations, and replaces their days.
RERUN = """runs AS (
  SELECT * FROM history WHERE length(date_utc) > 0
), again AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY event_id) AS rn
                 FROM history WHERE location_id % 3 <> 1)
  WHERE rn <= 5 AND length(date_utc) > 0
), landed AS (
  SELECT location_id, value, date_utc FROM runs r
  WHERE location_id % 3 <> 0 AND NOT EXISTS (
    SELECT 1 FROM again a WHERE a.location_id = r.location_id
      AND substr(a.date_utc, 1, 10) = substr(r.date_utc, 1, 10))
  UNION ALL
  SELECT location_id, value, date_utc FROM again
)"""

TREND_ATHENA = wow_trend("athena").replace("SELECT city, country, CAST(week_start", ", trend AS (SELECT city, country, CAST(week_start", 1)

SQL.update(
    {
        "raw_scan_array": with_(RAW, ARRAY_ROWS) + ARRAY_SELECT.format(value="value"),
        "raw_scan_malformed": with_(RAW, ARRAY_ROWS)
        + ARRAY_SELECT.format(value=QUOTED)
        + """
UNION ALL
SELECT DISTINCT 2, date, CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), NULL, NULL, NULL, 'pm25',
  CAST(NULL AS DOUBLE), 'ug/m3', NULL, true FROM arr WHERE src = 0""",
        "curate_array": with_(ODD_RAW, VALID, FIRSTS_BY_DAY, CUR)
        + f"SELECT {CURATED_COLS}, date FROM cur",
        "curate_counts": with_(ODD_RAW, VALID, FIRSTS_BY_DAY, CUR)
        + """, days AS (SELECT count(DISTINCT strftime(ts, '%Y-%m-%d')) AS d FROM raw WHERE src = 0)
SELECT 'rows_read' AS measure, (SELECT count(*) FROM raw) + d AS n FROM days
UNION ALL SELECT 'malformed_records', 0
UNION ALL SELECT 'malformed_files', d FROM days
UNION ALL SELECT 'rows_curated', count(*) FROM cur
UNION ALL SELECT 'flagged', count(*) FROM cur WHERE is_extreme_outlier""",
        "incremental_with_backfill": SQL["curate_with_backfill"],
        "incremental_global_scope": stale_curated("global"),
        "append_stream": with_(RAW, VALID, FIRSTS, CUR)
        + "SELECT location_id, parameter, date_utc FROM cur",
        "csv_export": CURATED_TABLE + " WHERE date IN ('2024-01-15', '2024-01-08')",
        "legacy_curated": CURATED_TABLE,
        "flatten_unit": with_(RAW)
        + """SELECT src, pos, 'µg/m³' AS canonical_unit,
  CASE WHEN pos % 3 = 0 THEN 'ppm' END AS deployed_unit FROM raw""",
        "backfill_range": with_(STATIONS, DIM, SENS, MEAS, HISTORY)
        + """SELECT substr(date_utc, 1, 10) AS date,
  'backfill_location_' || CAST(location_id AS VARCHAR) AS run_id, location_id, sensor_id, value,
  date_utc
FROM history
WHERE location_id % 2 = 0
  AND TRY_CAST(date_utc AS TIMESTAMP) >= TIMESTAMP '2024-01-12 00:00:00'
  AND TRY_CAST(date_utc AS TIMESTAMP) < TIMESTAMP '2024-01-23 00:00:00'""",
        "backfill_rerun": with_(STATIONS, SENS, MEAS, HISTORY, RERUN)
        + """SELECT substr(date_utc, 1, 10) AS date,
  'backfill_location_' || CAST(location_id AS VARCHAR) AS run_id, location_id, value, date_utc
FROM landed""",
        "location_search_all": SQL["location_search"].replace(" ORDER BY id LIMIT 100", ""),
        "page_explode_all": SQL["page_explode_limit"].replace("ORDER BY page, pos LIMIT 2500", ""),
        "metric_views_athena": TREND_ATHENA
        + f"""), daily AS (
  SELECT city, country, CAST(date_utc AS DATE) AS reading_date, {EXACT_AVG} AS avg_pm25
  FROM cur WHERE {_metric_where("athena")} GROUP BY city, country, CAST(date_utc AS DATE)
)
SELECT t.city, t.country, t.week_start, t.pct_change_wow, d.reading_date, d.avg_pm25,
  false AS outlier_view
FROM trend t LEFT JOIN daily d ON t.city = d.city AND t.country IS NOT DISTINCT FROM d.country
  AND date_trunc('week', d.reading_date) = t.week_start""",
        "location_search_indexed": SQL["location_search"].split("), lim AS (")[0]
        + """), needles AS (SELECT unnest(['nation_1', 'R#0', '#', 'n_', 'On_2', 'no such place']) AS needle)
SELECT needle, id, substr(coalesce(name, ''), 1, 35) AS name,
  substr(coalesce(locality, ''), 1, 25) AS locality, coalesce(code, '') AS country
FROM cat JOIN needles ON contains(lower(coalesce(name, '')), lower(needle))
  OR contains(lower(coalesce(locality, '')), lower(needle))
WHERE code = 'AM' AND has_pm25""",
        "distinct_locations_approx": with_(RAW, IDS)
        + "SELECT count(*) AS distinct_locations, true AS within_error FROM ids",
        "coverage_approx": SQL["coverage_rate"].replace("SELECT count(*) AS distinct_locations,\n  count(*) FILTER (WHERE resolved) AS resolved_locations,\n", "SELECT true AS within_error,\n"),
        "legacy_curated_mixed": with_(RAW, VALID, FIRSTS_BY_DAY, CUR)
        + """SELECT * REPLACE (CASE WHEN day(CAST(date AS DATE)) % 3 <> 2 THEN location_name END AS location_name,
  CASE WHEN day(CAST(date AS DATE)) % 3 <> 2 THEN unit END AS unit) FROM cur""",
        "append_stream_exact": CURATED_TABLE,
        "incremental_delta": with_(RAW, RAW_AND("""SELECT 2 AS src, * EXCLUDE (src) REPLACE (CAST(0.5 AS DOUBLE) AS value)
    FROM raw WHERE src = 0 AND pos % 7 = 0 AND (pos % 14 = 0 OR NOT EXISTS (
      SELECT 1 FROM raw o WHERE o.src = 0 AND o.pos % 14 = 0
        AND strftime(o.ts, '%Y-%m-%d') = strftime(raw.ts, '%Y-%m-%d')))"""), VALID_OF_ALL, FIRSTS_BY_DAY, CUR)
        + f"SELECT {CURATED_COLS}, date FROM cur",
        "daily_avg_incremental": LATE
        + f"""SELECT city, country, CAST(date_utc AS DATE) AS reading_date, {EXACT_AVG} AS avg_pm25,
  count(*) AS reading_count
FROM cur WHERE {_metric_where("warehouse")} GROUP BY city, country, CAST(date_utc AS DATE)""",
        "breach_rate_incremental": LATE + breach_rate("warehouse").removeprefix(CLEAN),
        "weekly_avg_incremental": LATE.rstrip() + ",\n" + weekly("warehouse") + """
SELECT city, country, CAST(week_start AS TIMESTAMP) AS week_start, avg_pm25 FROM weekly""",
        "landing_replace": with_(RAW)
        + """, landed AS (
  SELECT *, strftime(ts, '%Y-%m-%d') AS date,
    max(CASE WHEN src = 1 AND pos % 20 = 3 THEN 1 ELSE 0 END) OVER (PARTITION BY strftime(ts, '%Y-%m-%d')) AS again
  FROM raw
)
SELECT 'run_' || src AS run_id, pos, date, location_id,
  CASE WHEN src = 1 AND again = 1 THEN value + 1000 ELSE value END AS value, date_str AS date_utc
FROM landed WHERE src = 0 OR again = 0 OR pos % 20 = 3""",
        "raw_fields_kept": with_(LATEST) + f"""SELECT {PLACE} AS pos,
  CASE WHEN event_id % 29 <> 0 THEN value END AS value, value AS raw_value, event_id % 29 = 0 AS quoted,
  CASE WHEN event_id % 2 = 0 THEN event_id END AS latitude, 'here' AS local,
  event_id % 3 = 0 AS has_note, CASE WHEN event_id % 3 = 0 THEN true ELSE false END AS note_is_null
FROM fetched f""",
        "raw_fields_kept_array": with_(STATIONS, DIM, LATEST)
        + """SELECT '2024-01-30' AS date, row_number() OVER (ORDER BY event_id) - 1 AS pos,
  CASE WHEN event_id % 2 = 0 THEN event_id END AS latitude,
  CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN f.location_id END AS location_id,
  CASE WHEN event_id % 5 <> 0 AND event_id % 7 <> 0 THEN d.name END AS location_name
FROM fetched f LEFT JOIN dim d ON f.location_id = d.location_id""",
        "flatten_missing_vs_null": with_(LATEST) + f"""SELECT {PLACE} AS pos,
  CASE WHEN event_id % 5 <> 0 THEN location_id END AS location_id,
  CASE WHEN event_id % 29 <> 0 THEN value END AS value, date_utc
FROM fetched f""",
        "ingest_then_curate": with_(STATIONS, DIM, LATEST)
        + """, one AS (
  SELECT * FROM fetched
  WHERE value NOT IN (-1, -999, 9999, 99999) AND value >= 0 AND NOT isnan(value)
  QUALIFY row_number() OVER (PARTITION BY location_id, date_utc ORDER BY event_id) = 1
)
SELECT one.location_id, d.name AS location_name, d.city, d.country, 'pm25' AS parameter, value,
  'µg/m³' AS unit, CAST(date_utc AS TIMESTAMP) AS date_utc, value > 500 AS is_extreme_outlier
FROM one LEFT JOIN dim d ON one.location_id = d.location_id""",
        "curate_empty_run": CURATED_TABLE,
        "curate_atomic": with_(RAW, VALID, FIRSTS_BY_DAY, CUR)
        + """, states AS (SELECT unnest([0, 1]) AS state)
SELECT state, cur.* REPLACE (CASE WHEN state = 1 AND date = '2024-01-15' THEN 'later' ELSE unit END AS unit)
FROM states CROSS JOIN cur""",
        "wow_trend_ordered": with_(RAW, VALID, FIRSTS, CUR, weekly("warehouse"))
        + """
SELECT CAST(row_number() OVER (ORDER BY city, week_start, country) AS INTEGER) AS place, city, country,
  CAST(week_start AS TIMESTAMP) AS week_start, avg_pm25 FROM weekly""",
        "flagged_outliers_ordered": CLEAN
        + """SELECT CAST(row_number() OVER (ORDER BY date_utc DESC) AS INTEGER) AS place, date_utc
FROM cur WHERE parameter = 'pm25' AND is_extreme_outlier""",
    }
)
