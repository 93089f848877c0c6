"""Composite jobs: land, enrich, backfill, curate.

Each job is one or a few Spark plans over whole inputs; nothing is looped
over on the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from airloom.operators import clean as C
from airloom.operators import dimension as D
from airloom.operators import history as H
from airloom.options import PARAMETER_ID, FlattenOptions, QualityRules
from airloom.schema import LOCATION_DIM, LOCATION_PAGE, MEASUREMENT_PAGE, RESULT_TEXTS
from airloom.session import scratch_path
from airloom.sinks.curated import drop_dates, write_curated
from airloom.sinks.dimension import read_dimension, write_dimension
from airloom.sinks.versions import publish, write_version
from airloom.sinks.raw import order_key, reading_record, replace_runs, with_metadata, write_run_array
from airloom.sources.pages import explode_pages, latest_readings, parse_envelope, results_of
from airloom.sources.raw import parse_reading, read_raw_dates


def curate(
    spark: SparkSession,
    raw_root: str | Sequence[str],
    out_root: str,
    dates: Sequence[str] | None = None,
    layout: str = "lines",
    rules: QualityRules = QualityRules(),
    flatten: FlattenOptions = FlattenOptions(),
    mode: str = "PERMISSIVE",
    pattern: str = "*.json",
    versioned: bool = False,
) -> dict:
    """Curate many raw dates in one job (per-date dedup scope by default).

    Reads the raw partitions (all, or ``dates`` by static pruning), cleans
    them and overwrites exactly the curated dates that have surviving rows.
    With global dedup scope all dates depend on each other: ``dates`` is
    refused, and dates that no longer have rows are deleted. A run of which
    no row survives (a missing root, an empty one) writes and deletes
    nothing in either scope.
    ``versioned`` publishes the run as one version of the table
    (``sinks.versions``) instead of overwriting dates: readers see the run
    whole or not at all.

    Returns the counts of the run, gathered by the same job through
    observations (no second pass): rows curated, flagged outliers, first and
    last date, rows read, records and whole files that could not be read.
    """
    if dates and rules.dedup_scope == "global":
        raise ValueError("global dedup scope curates all dates together; give no dates")
    read, written = Observation("read"), Observation("curated")
    raw = read_raw_dates(
        spark, raw_root, list(dates) if dates else None, layout=layout, mode=mode, with_corrupt=True,
        pattern=pattern,
    ).observe(
        read,
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col("_corrupt") & F.col("_pos").isNotNull()).alias("malformed_records"),
        F.count_if(F.col("_corrupt") & F.col("_pos").isNull()).alias("malformed_files"),
    )
    cleaned = C.clean_readings(C.flatten_readings(raw, "record", flatten), rules)
    observed = cleaned.observe(
        written,
        F.count(F.lit(1)).alias("rows_curated"),
        F.count_if(F.col("is_extreme_outlier")).alias("flagged"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.collect_set("date").alias("dates"),
    )
    version = None
    if versioned:
        version = write_version(observed, out_root)
    else:
        write_curated(observed, out_root)
    nothing = {"rows_curated": 0, "flagged": 0, "first_date": None, "last_date": None, "dates": []}
    counts = _observed(written, nothing) | _observed(
        read, {"rows_read": 0, "malformed_records": 0, "malformed_files": 0}
    )
    curated_dates = counts.pop("dates")
    if counts["rows_curated"] == 0:
        return counts
    whole = rules.dedup_scope == "global"
    if versioned:
        publish(spark, out_root, version, curated_dates, keep_others=not whole)
    elif whole:
        drop_dates(spark, out_root, keep=curated_dates)
    return counts


def _observed(observation: Observation, nothing: dict) -> dict:
    """The figures of an observation whose job has run; ``nothing`` if no row passed it.

    Spark drops an observed part of a plan that turns out to be empty, and
    then has no row of figures to give.
    """
    try:
        return observation.get
    except Py4JJavaError as exc:
        if "java.lang.AssertionError" not in str(exc):
            raise
        return nothing


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared scratch root, for more than one use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def enrich_job(
    latest_page_texts: DataFrame,
    detail_texts: DataFrame,
    cache: DataFrame,
    raw_root: str,
    run_id: str,
    date: str,
    dimension_root: str,
    failed: DataFrame | None = None,
    limit: int | None = None,
    layout: str = "lines",
) -> DataFrame:
    """Land one ingestion run: readings + station metadata as raw JSON.

    ``latest_page_texts``: (page, text) of the run's pages;
    ``detail_texts``: (location_id, text) detail envelopes fetched for the
    run's unresolved stations; ``cache``: the dimension before the run. The
    updated dimension is written first, as a new version below
    ``dimension_root`` (if a station was added), and the readings are
    enriched from what was written. Returns that dimension. A run landed
    again under its ``run_id`` replaces its earlier landing of the day.
    Records land as they came, with their unknown fields, and ``location_meta``
    added. ``layout="array"`` lands the run as a JSON array
    (``sinks.raw.write_run_array``) instead of lines.
    """
    if layout not in ("lines", "array"):
        raise ValueError(f"layout must be 'lines' or 'array', got {layout!r}")
    spark = cache.sparkSession
    if limit is None:  # the pages are parsed once, for their lengths and for their results
        pages = _stored(parse_envelope(latest_page_texts.select("page", "text"), "text", RESULT_TEXTS), "pages")
        readings = latest_readings(pages)
    else:
        readings = results_of(latest_page_texts, RESULT_TEXTS, limit)
    location = parse_reading(F.col("result"))["locationsId"]
    flat = _stored(readings.select("page", "pos", "result", location.alias("location_id")), "readings")
    ids = D.distinct_locations(flat.select("location_id"))
    details = parse_envelope(detail_texts.join(ids, "location_id", "left_semi"), "text",
                             LOCATION_PAGE)
    # Failed lookups are not stored, so they enrich to null metadata.
    # They are written once: to see whether there are any, and to make the next version.
    added = _stored(D.new_stations(cache, D.normalize_location(details), failed), "new-stations")
    dim = cache
    if not added.isEmpty():
        write_dimension(cache.select(*D.DIM_COLUMNS).unionByName(added), dimension_root)
        dim = read_dimension(spark, dimension_root)
    enriched = D.enrich(flat, dim)
    landed = enriched.select(
        F.lit(date).alias("date"),
        F.lit(run_id).alias("run_id"),
        order_key(F.col("page"), F.col("pos")).alias("pos"),
        with_metadata(F.col("result"), parse_reading(F.col("result")), F.col("location_meta")).alias("record"),
    )
    if layout == "array":
        write_run_array(landed, raw_root, date, run_id)
    else:
        replace_runs(landed, raw_root)
    return dim


def backfill_rows(
    measurement_texts: DataFrame,
    detail_texts: DataFrame,
    parameter_id: int = PARAMETER_ID,
    cap: int | None = None,
    days: int | None = None,
    as_of: dt.date | str | None = None,
    stations: DataFrame | None = None,
) -> DataFrame:
    """Backfill records for the stations with landed history.

    ``measurement_texts``: (sensor_id, page, text); ``detail_texts``:
    (location_id, text). The station's sensor for ``parameter_id`` is
    resolved from its detail; rows without a timestamp are skipped and each
    row gets its reading day as ``date`` and the station metadata.

    ``stations`` (location_id) restricts the run to a list of stations, an
    empty list gives nothing. ``days`` keeps the readings from that many
    days before ``as_of`` (a date, default today UTC) to that day itself.
    ``cap`` keeps the first so many readings of a station in fetch order.
    """
    if stations is not None:
        detail_texts = detail_texts.join(
            stations.select("location_id").distinct(), "location_id", "left_semi"
        )
    details = parse_envelope(detail_texts, "text", LOCATION_PAGE)
    sensors = D.resolve_sensor(details, parameter_id)
    dim = D.normalize_location(details)
    pages = parse_envelope(measurement_texts, "text", MEASUREMENT_PAGE)
    results = explode_pages(pages, group_cols=["sensor_id"])
    first = last = None
    if days is not None:
        last = dt.date.fromisoformat(str(as_of)) if as_of else dt.datetime.now(dt.timezone.utc).date()
        first = last - dt.timedelta(days=days)
    shaped = H.reshape_measurements(
        results, sensors, datetime_from=first, datetime_to=last, inclusive_to=True
    )
    if cap is not None:
        shaped = H.cap_per_location(shaped, cap)
    return H.backfill_rows(shaped, dim)


def backfill_job(rows: DataFrame, backfill_root: str) -> DataFrame:
    """Land backfill rows under their reading day, replacing station-days.

    A station-day that this run fetched replaces what an earlier run landed
    for it; other stations and other days stay. The backfill root is
    separate from the run landings and partitioned by ``date`` only (a
    directory per station-day would grow as days x stations); a station's
    rows carry ``run_id = backfill_location_<id>``, which is the unit that
    is replaced and gives keep-first order. Curate with both roots
    (``curate(raw_root=[...])``). Returns (date, location_id, readings) of
    what was landed, counted from the rows that were written.
    """
    record = reading_record(
        F.col("location_id"),
        F.col("value"),
        F.col("date_utc"),
        F.col("location_meta.name"),
        F.col("location_meta.city"),
        F.col("location_meta.country"),
        sensor_id=F.col("sensor_id"),
    )
    counts = replace_runs(
        rows.select(
            "date",
            "run_id",
            order_key(F.col("page"), F.col("pos")).alias("pos"),
            record.alias("record"),
        ),
        backfill_root,
    )
    station = F.regexp_extract("run_id", r"(-?\d+)$", 1).cast("bigint")
    return counts.select("date", station.alias("location_id"), F.col("rows").alias("readings"))
