"""The registered query set: one Spark plan per operator, over whole tables.

Every query reads the driver tables (through ``fixture``) so its work grows
with them. Timestamps are returned zone-less (UTC wall clock).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.operators import clean as C
from airloom.operators import dimension as D
from airloom.operators import history as H
from airloom.operators import metric_state as MS
from airloom.operators import metrics as M
from airloom.operators import search as S
from airloom.operators import search_index as SI
from airloom.operators import sketches as SK
from airloom.operators.ordering import numbered
from airloom.options import PARAMETER_ID, FlattenOptions, MetricOptions, QualityRules
from airloom.plans import fixture as FX
from airloom.plans import jobs as J
from airloom.schema import (
    CURATED_PARTITIONED,
    LOCATION_CACHE,
    LOCATION_PAGE,
    MEASUREMENT_PAGE,
    RAW_READING,
    READINGS_PAGE,
)
from airloom.sinks.csv import export_csv
from airloom.sinks.raw import new_landing, reading_record, replace_runs, write_raw
from airloom.sinks.versions import read_versioned, write_version
from airloom.sources.curated import read_curated, read_legacy_curated, register_table
from airloom.sources.pages import explode_pages, parse_envelope, results_of
from airloom.sources.raw import day_of_file, line_rows, parse_lines, read_raw, read_raw_dates
from airloom.session import configure, scratch_path
from airloom.storage import folders
from airloom.streaming.delta import curate_delta, read_delta
from airloom.streaming.exact import CHANGES, holding, keep_first_changes, rocksdb_state
from airloom.streaming.incremental import clean_append_stream, curate_incremental

Query = Callable[[SparkSession, str], DataFrame]

RULES = QualityRules()
FLAT_OUT = [
    "src",
    "pos",
    "location_id",
    "location_name",
    "city",
    "country",
    "parameter",
    "value",
    "unit",
    "date_utc",
]


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    return FX.derived_flat(spark, sf_dir)


def curated_fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture cleaned in memory (no write): the input of the metric views."""
    flat = _flat(spark, sf_dir)
    return FX.memo(
        spark, ("curated", sf_dir), lambda: C.clean_readings(flat, RULES, order_cols=FX.ORDER)
    )


def _opts(profile: str) -> MetricOptions:
    if profile == "athena":
        return MetricOptions.athena(as_of=FX.AS_OF, exact=True)
    return MetricOptions.warehouse(exact=True)


# -- cleaning ---------------------------------------------------------------


def q_drop_sentinels(spark, sf_dir):
    return C.drop_sentinels(_flat(spark, sf_dir), RULES).select(*FLAT_OUT)


def q_drop_below_floor(spark, sf_dir):
    return C.drop_below_floor(_flat(spark, sf_dir), RULES).select(*FLAT_OUT)


def q_flag_outliers(spark, sf_dir):
    df = C.flag_outliers(C.drop_invalid(_flat(spark, sf_dir), RULES), RULES)
    return df.select(*FLAT_OUT, "is_extreme_outlier")


def q_parse_dates(spark, sf_dir):
    return C.parse_dates(_flat(spark, sf_dir)).select(*FLAT_OUT)


def q_dedup_first(spark, sf_dir):
    valid = C.flag_outliers(C.drop_invalid(_flat(spark, sf_dir), RULES), RULES)
    return C.dedup_first(valid, C.DEDUP_KEYS, FX.ORDER).select(*FLAT_OUT, "is_extreme_outlier")


def q_clean_readings(spark, sf_dir):
    return curated_fixture(spark, sf_dir)


def q_dedup_instant(spark, sf_dir):
    """Keep-first on the parsed instant: the later copies spell the time with
    a ``+00:00`` offset, so only an instant key sees them as duplicates."""
    flat = _flat(spark, sf_dir)
    respelled = F.when(
        (F.col("src") == 1) & (F.col("date_utc") != F.lit("not-a-date")),
        F.regexp_replace("date_utc", "Z$", "+00:00"),
    ).otherwise(F.col("date_utc"))
    flat = flat.withColumn("date_utc", respelled)
    return C.clean_readings(flat, QualityRules(dedup_key="instant"), order_cols=FX.ORDER)


def q_cleaning_summary(spark, sf_dir):
    return C.cleaning_summary(_flat(spark, sf_dir), RULES, order_cols=FX.ORDER)


# -- metrics ----------------------------------------------------------------


def _metric(view, profile: str) -> Query:
    def run(spark, sf_dir):
        return view(curated_fixture(spark, sf_dir), _opts(profile))

    run.__name__ = f"q_{view.__name__}_{profile}"
    return run


def q_flagged_outliers(spark, sf_dir):
    return M.flagged_outliers(curated_fixture(spark, sf_dir), _opts("warehouse"))


def q_wow_trend_adjacent(spark, sf_dir):
    """Trend variant: LAG per (city, country), only from the adjacent week."""
    opts = MetricOptions.warehouse(exact=True, partition_by_country=True,
                                   require_adjacent_week=True)
    return M.wow_trend(curated_fixture(spark, sf_dir), opts)


def q_weekly_avg(spark, sf_dir):
    return M.weekly_avg(curated_fixture(spark, sf_dir), _opts("warehouse"))


# -- raw landing, curated table, incremental curation ----------------------

FIXTURE_FLATTEN = FlattenOptions(unit=FX.FIXTURE_UNIT)
SCAN_DAY = "2024-01-15"
RAW_OUT = [
    "run_id",
    "pos",
    "date",
    "location_id",
    "location_name",
    "city",
    "country",
    "parameter",
    "value",
    "unit",
    "date_utc",
]


def land_fixture(
    spark: SparkSession, sf_dir: str, root: str, srcs=(0, 1), stale_copies: bool = False
) -> str:
    """Land the derived readings as raw JSON lines: one run per ``src``,
    partitioned by the reading day of the event. With ``stale_copies`` the
    later copies (``src = 1``) land one day later, as a feed that repeats a
    stale reading on the next day."""
    raw = FX.derived_raw(spark, sf_dir).where(F.col("src").isin(*srcs))
    landed_on = F.col("ts")
    if stale_copies:
        landed_on = F.when(F.col("src") == 1, F.col("ts") + F.expr("INTERVAL 1 DAY")).otherwise(
            F.col("ts"))
    record = reading_record(
        F.col("location_id"),
        F.col("value"),
        F.col("date_str"),
        F.col("location_name"),
        F.col("city"),
        F.col("country"),
    )
    write_raw(
        raw.select(
            F.date_format(landed_on, "yyyy-MM-dd").alias("date"),
            F.concat(F.lit("run_"), F.col("src").cast("string")).alias("run_id"),
            "pos",
            record.alias("record"),
        ),
        root,
    )
    return root


def _scan_out(df: DataFrame) -> DataFrame:
    flat = C.flatten_readings(df, "record", FIXTURE_FLATTEN)
    return flat.select(F.col("_file").alias("run_id"), F.col("_pos").alias("pos"), *RAW_OUT[2:])


def q_raw_scan(spark, sf_dir):
    configure(spark)
    root = land_fixture(spark, sf_dir, scratch_path(spark, "raw"))
    return _scan_out(read_raw(spark, root, layout="lines"))


def q_raw_scan_date(spark, sf_dir):
    configure(spark)
    root = land_fixture(spark, sf_dir, scratch_path(spark, "raw"))
    return _scan_out(read_raw_dates(spark, root, [SCAN_DAY], layout="lines"))


def _curated_root(spark, sf_dir) -> str:
    configure(spark)
    raw_root = land_fixture(spark, sf_dir, scratch_path(spark, "raw"))
    out = scratch_path(spark, "curated")
    J.curate(spark, raw_root, out, flatten=FIXTURE_FLATTEN)
    return out


def _stale_curated(spark, sf_dir, scope: str) -> DataFrame:
    configure(spark)
    raw_root = land_fixture(spark, sf_dir, scratch_path(spark, "raw"), stale_copies=True)
    out = scratch_path(spark, "curated")
    J.curate(spark, raw_root, out, rules=QualityRules(dedup_scope=scope),
             flatten=FIXTURE_FLATTEN)
    return read_curated(spark, out)


def q_curate_stale_copies(spark, sf_dir):
    """Per-date scope: a stale copy landed on a later day is kept in that day."""
    return _stale_curated(spark, sf_dir, "partition")


def q_curate_global_scope(spark, sf_dir):
    """Global scope: the first landing of a reading wins across all days."""
    return _stale_curated(spark, sf_dir, "global")


def q_curate_roundtrip(spark, sf_dir):
    return read_curated(spark, _curated_root(spark, sf_dir))


def q_curated_scan(spark, sf_dir):
    root = _curated_root(spark, sf_dir)
    return register_table(spark, "curated_readings_scan", root).select(*C.CURATED_COLUMNS, "date")


def q_incremental_curation(spark, sf_dir):
    """Two landings arrive one after the other; each stream run re-curates
    the dates it touched from their whole raw partitions."""
    configure(spark)
    raw_root = scratch_path(spark, "raw")
    out = scratch_path(spark, "curated")
    ckpt = scratch_path(spark, "stream-ckpt")
    land_fixture(spark, sf_dir, raw_root, srcs=(0,))
    curate_incremental(spark, raw_root, out, ckpt, flatten=FIXTURE_FLATTEN)
    land_fixture(spark, sf_dir, raw_root, srcs=(1,))
    curate_incremental(spark, raw_root, out, ckpt, flatten=FIXTURE_FLATTEN)
    return read_curated(spark, out)


# -- array landings --------------------------------------------------------------

ARRAY_OUT = ["src", "date", "pos", *RAW_OUT[3:], "corrupt"]


def _array_scan(spark, sf_dir, odd: bool) -> DataFrame:
    configure(spark)
    roots = FX.land_arrays(spark, sf_dir, scratch_path(spark, "arrays"), odd)
    scan = read_raw(spark, roots, layout="array", with_corrupt=True, pattern="*.txt")
    flat = C.flatten_readings(scan, "record", FIXTURE_FLATTEN)
    src = F.regexp_extract("_file", r"/run_(\d)/", 1).cast("int")
    return flat.select(src.alias("src"), "date", F.col("_pos").alias("pos"), *RAW_OUT[3:],
                       F.col("_corrupt").alias("corrupt"))


def q_raw_scan_array(spark, sf_dir):
    return _array_scan(spark, sf_dir, odd=False)


def q_raw_scan_malformed(spark, sf_dir):
    """Quoted values, ids written as floats and a file cut off in every day."""
    return _array_scan(spark, sf_dir, odd=True)


def _curate_odd_arrays(spark, sf_dir) -> tuple[dict, str]:
    configure(spark)
    roots = FX.land_arrays(spark, sf_dir, scratch_path(spark, "arrays"), odd=True)
    out = scratch_path(spark, "curated")
    counts = J.curate(spark, roots, out, layout="array", flatten=FIXTURE_FLATTEN, pattern="*.txt")
    return counts, out


def q_curate_array(spark, sf_dir):
    return read_curated(spark, _curate_odd_arrays(spark, sf_dir)[1])


def q_curate_counts(spark, sf_dir):
    """The counts of a run as (measure, n)."""
    counts, _ = _curate_odd_arrays(spark, sf_dir)
    names = ("rows_read", "malformed_records", "malformed_files", "rows_curated", "flagged")
    return spark.createDataFrame([(n, counts[n]) for n in names], "measure string, n long")


# -- incremental curation over several roots and scopes ---------------------------


def q_incremental_with_backfill(spark, sf_dir):
    """Run and backfill landings are curated, more lands, the stream catches up."""
    configure(spark)
    runs, backfill, out, ckpt = (scratch_path(spark, n) for n in ("raw", "backfill", "curated", "ckpt"))
    land_fixture(spark, sf_dir, runs, srcs=(0,))
    J.backfill_job(
        J.backfill_rows(FX.measurement_pages(spark, sf_dir), FX.location_detail_pages(spark, sf_dir)),
        backfill,
    )
    J.curate(spark, [runs, backfill], out, flatten=FIXTURE_FLATTEN)
    land_fixture(spark, sf_dir, runs, srcs=(1,))
    curate_incremental(spark, [runs, backfill], out, ckpt, flatten=FIXTURE_FLATTEN)
    return read_curated(spark, out)


def q_incremental_global_scope(spark, sf_dir):
    """Stale copies land before the readings that they repeat, which empties dates."""
    configure(spark)
    raw, out, ckpt = (scratch_path(spark, n) for n in ("raw", "curated", "ckpt"))
    rules = QualityRules(dedup_scope="global")
    for src in (1, 0):
        land_fixture(spark, sf_dir, raw, srcs=(src,), stale_copies=True)
        curate_incremental(spark, raw, out, ckpt, rules=rules, flatten=FIXTURE_FLATTEN)
    return read_curated(spark, out)


def q_append_stream_exact(spark, sf_dir):
    """Later copies arrive first; the stream takes them back when the first ones arrive."""
    configure(spark)
    raw, out, ckpt = (scratch_path(spark, n) for n in ("raw", "changes", "ckpt"))
    for src in (1, 0):
        land_fixture(spark, sf_dir, raw, srcs=(src,))
        files = spark.readStream.option("pathGlobFilter", "*.json").text(f"{raw}/date=*")
        lines = files.select(day_of_file().alias("date"), "value").where("trim(value) <> ''")
        flat = C.flatten_readings(line_rows(parse_lines(lines)).drop("raw"), "record", FIXTURE_FLATTEN)
        with rocksdb_state(spark):
            query = (
                keep_first_changes(flat).writeStream.outputMode("append").format("parquet")
                .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
            )
            query.awaitTermination()
    return holding(spark.read.schema(CHANGES).parquet(out))


def q_incremental_delta(spark, sf_dir):
    """Later copies land first, then the readings that come before them in landing
    order, then a run again with fewer rows, then once more whole; only winners change."""
    configure(spark)
    raw, table, ckpt = (scratch_path(spark, n) for n in ("raw", "delta", "ckpt"))
    run = lambda: curate_delta(spark, raw, table, ckpt, flatten=FIXTURE_FLATTEN)
    land_fixture(spark, sf_dir, raw, srcs=(1,))
    run()
    land_fixture(spark, sf_dir, raw, srcs=(0,))
    run()
    late = FX.derived_raw(spark, sf_dir).where("src = 0 AND pos % 7 = 0")
    record = reading_record(F.col("location_id"), F.lit(0.5), F.col("date_str"), F.col("location_name"), F.col("city"), F.col("country"))
    rows = late.select(F.date_format("ts", "yyyy-MM-dd").alias("date"), F.lit("run_2").alias("run_id"), "pos", record.alias("record"))
    for part in (rows, rows.where("pos % 14 = 0")):
        replace_runs(part, raw)
        run()
    return read_delta(spark, table)


def _metric_state(spark, sf_dir) -> DataFrame:
    """Partials of a table whose days come in two landings, the second one late."""
    configure(spark)
    raw, out, state = (scratch_path(spark, n) for n in ("raw", "curated", "partials"))
    for srcs in ((1,), (0,)):
        land_fixture(spark, sf_dir, raw, srcs=srcs)
        J.curate(spark, raw, out, flatten=FIXTURE_FLATTEN)
        days = [f.removeprefix("date=") for f in folders(spark, out) if f.startswith("date=")]
        MS.update_partials(spark, read_curated(spark, out), state, days)
    # One more landing touches one day only.
    late = FX.derived_raw(spark, sf_dir).where("src = 0").where(F.date_format("ts", "yyyy-MM-dd") == SCAN_DAY)
    record = reading_record(
        F.col("location_id"), F.col("value") + F.lit(1.5), F.date_format(F.col("ts") + F.expr("INTERVAL 1 SECOND"), FX.TS_FORMAT),
        F.col("location_name"), F.col("city"), F.col("country"),
    )
    rows = late.where("pos % 211 <> 0").select(F.lit(SCAN_DAY).alias("date"), F.lit("run_9").alias("run_id"), "pos", record.alias("record"))
    replace_runs(rows, raw)
    J.curate(spark, raw, out, dates=[SCAN_DAY], flatten=FIXTURE_FLATTEN)
    MS.update_partials(spark, read_curated(spark, out), state, [SCAN_DAY])
    return MS.read_partials(spark, state)


def q_daily_avg_incremental(spark, sf_dir):
    return MS.daily_avg(_metric_state(spark, sf_dir))


def q_breach_rate_incremental(spark, sf_dir):
    return MS.breach_rate(_metric_state(spark, sf_dir))


def q_weekly_avg_incremental(spark, sf_dir):
    return MS.weekly_avg(_metric_state(spark, sf_dir))


def q_append_stream(spark, sf_dir):
    """The keys that the append-mode variant keeps of landed lines."""
    configure(spark)
    raw, out, ckpt = (scratch_path(spark, n) for n in ("raw", "appended", "ckpt"))
    land_fixture(spark, sf_dir, raw)
    lines = spark.readStream.schema(T.StructType([T.StructField("record", RAW_READING)])).json(raw)
    flat = C.flatten_readings(lines.select("record"), "record", FIXTURE_FLATTEN)
    query = (
        clean_append_stream(flat).writeStream.outputMode("append").format("parquet")
        .option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(out).select("location_id", "parameter", "date_utc")


# -- other readers and writers of the curated table --------------------------------


def q_csv_export(spark, sf_dir):
    """K5: exported days read back."""
    days = [SCAN_DAY, FX.MEASURE_FROM]
    out = scratch_path(spark, "csv")
    export_csv(spark, _curated_root(spark, sf_dir), days, out)
    return spark.read.schema(CURATED_PARTITIONED).option("header", True).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(out)


def q_legacy_curated(spark, sf_dir):
    """Files with DOUBLE ids and nanosecond times."""
    configure(spark)
    out = scratch_path(spark, "legacy")
    nanos = F.unix_micros(F.col("date_utc").cast("timestamp")) * 1000
    cur = read_curated(spark, _curated_root(spark, sf_dir))
    cur.withColumns({"location_id": F.col("location_id").cast("double"), "date_utc": nanos}).write.partitionBy("date").parquet(out)
    return read_legacy_curated(spark, out)


def q_legacy_curated_mixed(spark, sf_dir):
    """One root with BIGINT and DOUBLE ids, times as nanoseconds and microseconds,
    columns of other types and a missing one, by the day of the month."""
    configure(spark)
    out = scratch_path(spark, "legacy")
    cur = read_curated(spark, _curated_root(spark, sf_dir))
    kind = F.dayofmonth(F.col("date").cast("date")) % 3
    instant = F.col("date_utc").cast("timestamp")
    cur.where(kind == 0).write.partitionBy("date").parquet(out)
    doubles = cur.where(kind == 1).withColumns({"location_id": F.col("location_id").cast("double"), "date_utc": F.unix_micros(instant) * 1000})
    doubles.write.mode("append").partitionBy("date").parquet(out)
    odd = cur.where(kind == 2).withColumns({"date_utc": instant, "unit": F.lit(None).cast("int")}).drop("location_name")
    odd.write.mode("append").partitionBy("date").parquet(out)
    return read_legacy_curated(spark, out)


# -- JSON shapes: flattening ------------------------------------------------


def q_flatten_readings(spark, sf_dir):
    """Raw records serialised to JSON text and parsed back, then flattened."""
    configure(spark)
    raw = FX.derived_raw(spark, sf_dir)
    record = reading_record(
        F.col("location_id"),
        F.col("value"),
        F.col("date_str"),
        F.col("location_name"),
        F.col("city"),
        F.col("country"),
    )
    text = raw.select("src", "pos", F.to_json(record).alias("text"))
    parsed = text.select("src", "pos", F.from_json("text", RAW_READING).alias("record"))
    return C.flatten_readings(parsed, "record", FIXTURE_FLATTEN).select(*FLAT_OUT)


def _variant_text():
    """Four record shapes by ``event_id % 4``: current keys; legacy keys
    (``locationId``, ``date``); scalar ``datetime`` with top-level
    ``date_utc``; no timestamp at all."""
    k = F.col("pos") % 4
    utc = F.col("date_str")
    loc = F.col("location_id")
    val = F.col("value")
    current = F.struct(loc.alias("locationsId"), val.alias("value"),
                       F.struct(utc.alias("utc")).alias("datetime"))
    legacy = F.struct(loc.alias("locationId"), val.alias("value"),
                      F.struct(utc.alias("utc")).alias("date"))
    scalar = F.struct(loc.alias("locationsId"), val.alias("value"),
                      utc.alias("datetime"), utc.alias("date_utc"))
    bare = F.struct(loc.alias("locationsId"), val.alias("value"))
    return (
        F.when(k == 0, F.to_json(current))
        .when(k == 1, F.to_json(legacy))
        .when(k == 2, F.to_json(scalar))
        .otherwise(F.to_json(bare))
    )


def q_flatten_fallback(spark, sf_dir):
    configure(spark)
    raw = FX.derived_raw(spark, sf_dir)
    parsed = raw.select(
        "src", "pos", F.from_json(_variant_text(), RAW_READING).alias("record")
    )
    cols_c = C.flat_columns("record", FlattenOptions(profile="canonical"))
    cols_d = C.flat_columns("record", FlattenOptions(profile="deployed"))
    # Both profiles in one projection of the same parsed rows.
    return parsed.select(
        "src",
        "pos",
        cols_c[0].alias("canonical_location_id"),
        cols_c[7].alias("canonical_date_utc"),
        cols_d[0].alias("deployed_location_id"),
        cols_d[7].alias("deployed_date_utc"),
    )


def q_flatten_unit(spark, sf_dir):
    """The unit is a constant in one profile and the record's in the other."""
    configure(spark)
    unit = F.when(F.col("pos") % 3 == 0, F.lit("ppm"))
    record = F.struct(F.col("location_id").alias("locationsId"), F.col("value"), unit.alias("unit"))
    parsed = FX.derived_raw(spark, sf_dir).select(
        "src", "pos", F.from_json(F.to_json(record), RAW_READING).alias("record")
    )
    canonical = C.flat_columns("record", FlattenOptions(profile="canonical"))[6]
    deployed = C.flat_columns("record", FlattenOptions(profile="deployed"))[6]
    return parsed.select("src", "pos", canonical.alias("canonical_unit"), deployed.alias("deployed_unit"))


# -- station dimension -------------------------------------------------------


def _details(spark, sf_dir) -> DataFrame:
    configure(spark)
    return parse_envelope(FX.location_detail_pages(spark, sf_dir), "text", LOCATION_PAGE)


def _dim(spark, sf_dir) -> DataFrame:
    return D.normalize_location(_details(spark, sf_dir))


def _cache(spark, sf_dir) -> DataFrame:
    return _dim(spark, sf_dir).where(FX.is_cached(F.col("location_id")))


def _readings(spark, sf_dir) -> DataFrame:
    return FX.derived_raw(spark, sf_dir).select(
        "src", "pos", "location_id", "value", F.col("date_str").alias("date_utc")
    )


def q_location_dim_normalize(spark, sf_dir):
    return _dim(spark, sf_dir)


def q_resolve_sensor(spark, sf_dir):
    return D.resolve_sensor(_details(spark, sf_dir), PARAMETER_ID)


def q_enrich_readings(spark, sf_dir):
    enriched = D.enrich(_readings(spark, sf_dir), _dim(spark, sf_dir))
    return enriched.select(
        "src",
        "pos",
        "location_id",
        "value",
        "date_utc",
        F.col("location_meta.name").alias("location_name"),
        F.col("location_meta.city").alias("city"),
        F.col("location_meta.country").alias("country"),
    )


def q_distinct_locations(spark, sf_dir):
    configure(spark)
    return D.distinct_locations(_readings(spark, sf_dir)).orderBy("location_id")


def q_unresolved_locations(spark, sf_dir):
    ids = D.distinct_locations(_readings(spark, sf_dir))
    return D.unresolved_locations(ids, _cache(spark, sf_dir))


def q_dim_upsert(spark, sf_dir):
    cache = _cache(spark, sf_dir)
    seen = D.distinct_locations(_readings(spark, sf_dir))
    details = _details(spark, sf_dir).join(seen, "location_id", "left_semi")
    return D.upsert(cache, D.normalize_location(details), FX.failed_lookups(spark, sf_dir))


def q_dim_cache_load(spark, sf_dir):
    """Cache entries serialised as JSON maps keyed by the id string."""
    cache = _dim(spark, sf_dir)
    entry = F.create_map(
        F.col("location_id").cast("string"), F.struct(*D.DIM_COLUMNS)
    )
    text = cache.select(F.to_json(entry).alias("text"))
    return D.load_cache(text.select(F.from_json("text", LOCATION_CACHE).alias("cache")))


def q_coverage_rate(spark, sf_dir):
    return D.coverage(D.enrich(_readings(spark, sf_dir), _dim(spark, sf_dir)))


# -- history and backfill ----------------------------------------------------


def _measurements(spark, sf_dir) -> DataFrame:
    pages = parse_envelope(FX.measurement_pages(spark, sf_dir), "text", MEASUREMENT_PAGE)
    return explode_pages(pages, group_cols=["sensor_id"])


def _sensors(spark, sf_dir) -> DataFrame:
    return D.resolve_sensor(_details(spark, sf_dir), PARAMETER_ID)


def q_measurement_reshape(spark, sf_dir):
    shaped = H.reshape_measurements(
        _measurements(spark, sf_dir),
        _sensors(spark, sf_dir),
        datetime_from=FX.MEASURE_FROM,
        datetime_to=FX.MEASURE_TO,
    )
    return shaped.select("location_id", "sensor_id", "value", "date_utc")


def q_backfill_cap(spark, sf_dir):
    shaped = H.reshape_measurements(_measurements(spark, sf_dir), _sensors(spark, sf_dir))
    capped = H.cap_per_location(shaped, FX.CAP_PER_LOCATION)
    return capped.select("location_id", "sensor_id", "value", "date_utc")


def q_backfill_by_date(spark, sf_dir):
    configure(spark)
    rows = J.backfill_rows(
        FX.measurement_pages(spark, sf_dir), FX.location_detail_pages(spark, sf_dir)
    )
    return rows.select(
        "date",
        "run_id",
        "location_id",
        "sensor_id",
        "value",
        "date_utc",
        F.col("location_meta.name").alias("location_name"),
        F.col("location_meta.city").alias("city"),
        F.col("location_meta.country").alias("country"),
    )


def q_backfill_range(spark, sf_dir):
    """The last days of a list of stations."""
    configure(spark)
    stations = FX.table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(
        F.col("c_custkey").alias("location_id"))
    rows = J.backfill_rows(
        FX.measurement_pages(spark, sf_dir), FX.location_detail_pages(spark, sf_dir),
        days=FX.BACKFILL_LAST_DAYS, as_of=FX.BACKFILL_AS_OF, stations=stations,
    )
    return rows.select("date", "run_id", "location_id", "sensor_id", "value", "date_utc")


def q_backfill_rerun(spark, sf_dir):
    """Two runs over the same days with different stations: the second, which
    fetches less, replaces the station-days it fetched and no others."""
    configure(spark)
    root = scratch_path(spark, "backfill")
    customer = FX.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("location_id"))
    for left_out, cap in ((0, None), (1, 5)):
        rows = J.backfill_rows(
            FX.measurement_pages(spark, sf_dir), FX.location_detail_pages(spark, sf_dir),
            stations=customer.where(F.col("location_id") % 3 != left_out), cap=cap,
        )
        J.backfill_job(rows, root)
    flat = C.flatten_readings(read_raw(spark, root, layout="lines"), "record", FIXTURE_FLATTEN)
    return flat.select("date", F.col("_file").alias("run_id"), "location_id", "value", "date_utc")


def q_union_sources(spark, sf_dir):
    """Run landings and backfill landings read together (bag union by name)."""
    runs = _readings(spark, sf_dir).select(
        F.lit("run").alias("origin"), "location_id", "value", "date_utc"
    )
    backfill = H.reshape_measurements(
        _measurements(spark, sf_dir), _sensors(spark, sf_dir)
    ).select(F.lit("backfill").alias("origin"), "location_id", "sensor_id", "value", "date_utc")
    return runs.unionByName(backfill, allowMissingColumns=True)


# -- catalogue search and latest-readings pages --------------------------------


def q_location_search(spark, sf_dir):
    configure(spark)
    catalogue = FX.location_results(spark, sf_dir).select("loc.*")
    return S.find_locations(catalogue, FX.SEARCH_COUNTRY, FX.SEARCH_TEXT, FX.SEARCH_LIMIT,
                            limit_before_search=True)


def q_location_search_all(spark, sf_dir):
    configure(spark)
    catalogue = FX.location_results(spark, sf_dir).select("loc.*")
    return S.find_locations(catalogue, FX.SEARCH_COUNTRY, FX.SEARCH_TEXT)


def q_location_search_indexed(spark, sf_dir):
    """The search by posting lists, with needles of one character and more."""
    configure(spark)
    catalogue = FX.location_results(spark, sf_dir).select("loc.*")
    root = scratch_path(spark, "postings")
    SI.write_postings(catalogue, root)
    out = None
    for needle in FX.SEARCH_NEEDLES:
        found = SI.find_indexed(catalogue, root, FX.SEARCH_COUNTRY, needle).select(F.lit(needle).alias("needle"), "*")
        out = found if out is None else out.unionByName(found)
    return out


def _sketches(spark, sf_dir) -> DataFrame:
    """Sketches of two landings, the second of which replaces some days of the first."""
    configure(spark)
    root = scratch_path(spark, "sketches")
    raw = FX.derived_raw(spark, sf_dir).withColumn("date", F.date_format("ts", "yyyy-MM-dd"))
    enriched = D.enrich(raw.select("src", "pos", "date", "location_id"), _dim(spark, sf_dir))
    whole = SK.station_sketches(enriched, F.col("location_meta.city"))
    SK.update_sketches(SK.station_sketches(enriched.where("src = 1"), F.col("location_meta.city")), root)
    SK.update_sketches(whole, root)
    return SK.read_sketches(spark, root)


def q_distinct_locations_approx(spark, sf_dir):
    """A5: the merged estimate beside the exact count, and whether it is within its error."""
    exact = D.distinct_locations(_readings(spark, sf_dir)).agg(F.count(F.lit(1))).scalar()
    near = F.abs(F.col("distinct_locations") - exact) <= F.lit(SK.hll_error()) * exact
    return SK.distinct_locations_approx(_sketches(spark, sf_dir)).select(exact.alias("distinct_locations"), near.alias("within_error"))


def q_coverage_approx(spark, sf_dir):
    """The merged coverage beside the exact one."""
    exact = D.coverage(D.enrich(_readings(spark, sf_dir), _dim(spark, sf_dir))).select("coverage").scalar()
    near = F.abs(F.col("coverage") - exact) <= F.lit(SK.theta_error())
    return SK.coverage_approx(_sketches(spark, sf_dir)).select(exact.alias("coverage"), near.alias("within_error"))


def q_page_explode_limit(spark, sf_dir):
    configure(spark)
    return _latest_out(results_of(FX.latest_pages(spark, sf_dir), READINGS_PAGE, FX.LATEST_LIMIT))


def q_page_explode_all(spark, sf_dir):
    configure(spark)
    return _latest_out(results_of(FX.latest_pages(spark, sf_dir), READINGS_PAGE))


def _latest_out(rows: DataFrame) -> DataFrame:
    flat = C.flatten_readings(rows, "result", FIXTURE_FLATTEN)
    return flat.select("page", "pos", "location_id", "value", "date_utc")


# -- composite jobs ------------------------------------------------------------


def q_ingest_run(spark, sf_dir):
    """G1: one ingestion run lands the latest readings with station metadata
    (cached stations, plus newly resolved ones; failed lookups stay null)."""
    configure(spark)
    root = scratch_path(spark, "raw")
    J.enrich_job(
        FX.latest_pages(spark, sf_dir),
        FX.location_detail_pages(spark, sf_dir),
        _cache(spark, sf_dir),
        root,
        run_id="run_000000",
        date=FX.AS_OF,
        dimension_root=scratch_path(spark, "dimension"),
        failed=FX.failed_lookups(spark, sf_dir),
    )
    flat = C.flatten_readings(read_raw(spark, root, layout="lines"), "record", FIXTURE_FLATTEN)
    return flat.select(
        "date", F.col("_pos").alias("pos"), "location_id", "value", "date_utc",
        "location_name", "city", "country",
    )


RERUN_SHIFT = 1000.0


def q_landing_replace(spark, sf_dir):
    """K1/G1: a run that lands again replaces its own days; others keep every line.

    ``run_1`` lands, lands again with half of its readings (values shifted),
    and a third landing of it dies before its log entry is written. Lines of
    another writer (``run_0``), which no log names, are in the same days.
    """
    configure(spark)
    root = land_fixture(spark, sf_dir, scratch_path(spark, "raw"), srcs=(0,))
    raw = FX.derived_raw(spark, sf_dir).where("src = 1")

    def rows(df, value):
        record = reading_record(F.col("location_id"), value, F.col("date_str"))
        day = F.date_format("ts", "yyyy-MM-dd").alias("date")
        return df.select(day, F.lit("run_1").alias("run_id"), "pos", record.alias("record"))

    replace_runs(rows(raw, F.col("value")), root)
    replace_runs(rows(raw.where("pos % 20 = 3"), F.col("value") + F.lit(RERUN_SHIFT)), root)
    write_raw(rows(raw, F.lit(0.0)), root, landing=new_landing())
    flat = C.flatten_readings(read_raw(spark, root, layout="lines"), "record", FIXTURE_FLATTEN)
    return flat.select(F.col("_file").alias("run_id"), F.col("_pos").alias("pos"), "date", "location_id", "value", "date_utc")


def _rich_landing(spark, sf_dir, layout: str = "lines") -> DataFrame:
    """An ingested run of records with undeclared fields, as (_pos, record, raw)."""
    configure(spark)
    root = scratch_path(spark, "raw")
    J.enrich_job(
        FX.latest_pages_with_extras(spark, sf_dir), FX.location_detail_pages(spark, sf_dir),
        _cache(spark, sf_dir), root, run_id="run_000000", date=FX.AS_OF,
        dimension_root=scratch_path(spark, "dimension"), layout=layout,
    )
    return read_raw(spark, root, layout="auto", with_raw=True)


def q_raw_fields_kept(spark, sf_dir):
    """What no declared field holds survives landing and scan."""
    raw = F.col("raw")
    of = lambda path, kind: F.try_variant_get(raw, path, kind)
    note = of("$.note", "variant")
    return _rich_landing(spark, sf_dir).select(
        F.col("_pos").alias("pos"),
        F.col("record.value").alias("value"),
        of("$.value", "string").cast("double").alias("raw_value"),
        (F.schema_of_variant(of("$.value", "variant")) == "STRING").alias("quoted"),
        of("$.coordinates.latitude", "bigint").alias("latitude"),
        of("$.datetime.local", "string").alias("local"),
        note.isNotNull().alias("has_note"),
        F.coalesce(F.is_variant_null(note), F.lit(False)).alias("note_is_null"),
    )


def q_flatten_missing_vs_null(spark, sf_dir):
    """The old id key counts only where the new one is missing."""
    rows = _rich_landing(spark, sf_dir)
    flat = C.flatten_readings(rows, "record", FlattenOptions(profile="deployed"), raw_col="raw")
    return flat.select(F.col("_pos").alias("pos"), "location_id", "value", "date_utc")


def q_raw_fields_kept_array(spark, sf_dir):
    """K1: the same run landed as one JSON array."""
    rows = _rich_landing(spark, sf_dir, layout="array")
    return rows.select(
        "date", F.col("_pos").alias("pos"),
        F.try_variant_get("raw", "$.coordinates.latitude", "bigint").alias("latitude"),
        F.col("record.locationsId").alias("location_id"), F.col("record.location_meta.name").alias("location_name"),
    )


def q_ingest_then_curate(spark, sf_dir):
    """G1 + G4 by the job runner with its defaults: what it lands, it curates."""
    from airloom.__main__ import main

    configure(spark)
    pages, details, raw, out, dim = (scratch_path(spark, n) for n in ("pages", "details", "raw", "curated", "dimension"))
    whole = lambda key: F.concat(F.lit(f'{{"{key}":'), F.col(key).cast("string"), F.lit(","), F.substring("text", 2, 1 << 30))
    FX.latest_pages(spark, sf_dir).select(whole("page")).write.text(pages)
    FX.location_detail_pages(spark, sf_dir).select(whole("location_id")).write.text(details)
    main(["ingest", "--pages", pages, "--details", details, "--dimension", dim, "--raw", raw])
    main(["curate", "--raw", raw, "--out", out])
    return read_curated(spark, out).drop("date")


def q_curate_empty_run(spark, sf_dir):
    """K2: runs over a missing root leave the table as it was, in both scopes."""
    out = _curated_root(spark, sf_dir)
    for scope in ("partition", "global"):
        J.curate(spark, scratch_path(spark, "nothing"), out, rules=QualityRules(dedup_scope=scope))
    return read_curated(spark, out)


def q_curate_atomic(spark, sf_dir):
    """A run that dies between its write and its switch is not seen; then one day
    is curated anew and the others keep their version."""
    configure(spark)
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "versioned")
    land_fixture(spark, sf_dir, raw)
    J.curate(spark, raw, out, flatten=FIXTURE_FLATTEN, versioned=True)
    write_version(read_versioned(spark, out).withColumn("value", F.lit(-7.0)), out)
    before = read_versioned(spark, out)
    later = [SCAN_DAY]
    shifted = FlattenOptions(unit="later")
    J.curate(spark, raw, out, dates=later, flatten=shifted, versioned=True)
    J.curate(spark, scratch_path(spark, "nothing"), out, versioned=True, rules=QualityRules(dedup_scope="global"))
    states = ((0, before), (1, read_versioned(spark, out)))
    frames = [df.select(F.lit(n).alias("state"), "*") for n, df in states]
    return frames[0].unionByName(frames[1])


def q_curate_with_backfill(spark, sf_dir):
    """U1 + W3 + G2 + G4: run landings and backfill landings curated together.

    The same reading arrives from both; the backfill landing sorts first, so
    its copy wins keep-first.
    """
    configure(spark)
    runs = land_fixture(spark, sf_dir, scratch_path(spark, "raw"))
    backfill = scratch_path(spark, "backfill")
    J.backfill_job(
        J.backfill_rows(FX.measurement_pages(spark, sf_dir),
                        FX.location_detail_pages(spark, sf_dir)),
        backfill,
    )
    out = scratch_path(spark, "curated")
    J.curate(spark, [runs, backfill], out, flatten=FIXTURE_FLATTEN)
    return read_curated(spark, out)


def q_metric_views_sql(spark, sf_dir):
    """K6: the views published in the session and queried with SQL."""
    M.publish_views(spark, curated_fixture(spark, sf_dir), _opts("warehouse"))
    return spark.sql(
        "SELECT b.city, b.country, b.reading_date, b.breach_pct, d.avg_pm25 "
        "FROM vw_who_threshold_breach_rate b JOIN vw_daily_avg_pm25_by_city d "
        "ON b.city = d.city AND b.country <=> d.country AND b.reading_date = d.reading_date"
    )


def q_metric_views_athena(spark, sf_dir):
    """K6 in the athena profile, which has no outlier view."""
    M.publish_views(spark, curated_fixture(spark, sf_dir), _opts("athena"))
    there = F.lit(spark.catalog.tableExists("vw_flagged_outliers"))
    joined = spark.sql(
        "SELECT t.city, t.country, t.week_start, t.pct_change_wow, d.reading_date, d.avg_pm25 "
        "FROM vw_wow_pm25_trend t LEFT JOIN vw_daily_avg_pm25_by_city d ON t.city = d.city "
        "AND t.country <=> d.country AND date_trunc('week', d.reading_date) = t.week_start"
    )
    return joined.withColumn("outlier_view", there)


def _placed(df: DataFrame, order, *cols: str) -> DataFrame:
    """The rows of an ordered result with their place in it, from 1."""
    rows = numbered(df, *order).select("place", *cols)
    return rows.withColumn("place", (F.col("place") + 1).cast("int"))


def q_wow_trend_ordered(spark, sf_dir):
    """O1: the trend view in its order."""
    trend = M.wow_trend(curated_fixture(spark, sf_dir), _opts("warehouse"))
    return _placed(trend, ["city", "week_start", "country"], "city", "country", "week_start", "avg_pm25")


def q_flagged_outliers_ordered(spark, sf_dir):
    """O2: the outlier view in its order (rows of one time are told apart by nothing)."""
    flagged = M.flagged_outliers(curated_fixture(spark, sf_dir), _opts("warehouse"), ordered=False)
    return _placed(flagged, [F.col("date_utc").desc()], "date_utc")


QUERIES: dict[str, Query] = {
    "drop_sentinels": q_drop_sentinels,
    "drop_below_floor": q_drop_below_floor,
    "flag_outliers": q_flag_outliers,
    "parse_dates": q_parse_dates,
    "dedup_first": q_dedup_first,
    "clean_readings": q_clean_readings,
    "dedup_instant": q_dedup_instant,
    "cleaning_summary": q_cleaning_summary,
    "daily_avg_warehouse": _metric(M.daily_avg, "warehouse"),
    "daily_avg_athena": _metric(M.daily_avg, "athena"),
    "breach_rate_warehouse": _metric(M.breach_rate, "warehouse"),
    "breach_rate_athena": _metric(M.breach_rate, "athena"),
    "weekly_avg": q_weekly_avg,
    "wow_trend_warehouse": _metric(M.wow_trend, "warehouse"),
    "wow_trend_athena": _metric(M.wow_trend, "athena"),
    "wow_trend_adjacent": q_wow_trend_adjacent,
    "flagged_outliers": q_flagged_outliers,
    "raw_scan": q_raw_scan,
    "raw_scan_date": q_raw_scan_date,
    "curate_roundtrip": q_curate_roundtrip,
    "curate_stale_copies": q_curate_stale_copies,
    "curate_global_scope": q_curate_global_scope,
    "curated_scan": q_curated_scan,
    "incremental_curation": q_incremental_curation,
    "raw_scan_array": q_raw_scan_array,
    "raw_scan_malformed": q_raw_scan_malformed,
    "curate_array": q_curate_array,
    "curate_counts": q_curate_counts,
    "incremental_with_backfill": q_incremental_with_backfill,
    "incremental_global_scope": q_incremental_global_scope,
    "append_stream": q_append_stream,
    "append_stream_exact": q_append_stream_exact,
    "incremental_delta": q_incremental_delta,
    "daily_avg_incremental": q_daily_avg_incremental,
    "breach_rate_incremental": q_breach_rate_incremental,
    "weekly_avg_incremental": q_weekly_avg_incremental,
    "csv_export": q_csv_export,
    "legacy_curated": q_legacy_curated,
    "legacy_curated_mixed": q_legacy_curated_mixed,
    "flatten_readings": q_flatten_readings,
    "flatten_unit": q_flatten_unit,
    "flatten_fallback": q_flatten_fallback,
    "location_dim_normalize": q_location_dim_normalize,
    "resolve_sensor": q_resolve_sensor,
    "enrich_readings": q_enrich_readings,
    "distinct_locations": q_distinct_locations,
    "unresolved_locations": q_unresolved_locations,
    "dim_upsert": q_dim_upsert,
    "dim_cache_load": q_dim_cache_load,
    "coverage_rate": q_coverage_rate,
    "measurement_reshape": q_measurement_reshape,
    "backfill_cap": q_backfill_cap,
    "backfill_by_date": q_backfill_by_date,
    "backfill_range": q_backfill_range,
    "backfill_rerun": q_backfill_rerun,
    "union_sources": q_union_sources,
    "location_search": q_location_search,
    "location_search_all": q_location_search_all,
    "location_search_indexed": q_location_search_indexed,
    "distinct_locations_approx": q_distinct_locations_approx,
    "coverage_approx": q_coverage_approx,
    "page_explode_all": q_page_explode_all,
    "page_explode_limit": q_page_explode_limit,
    "ingest_run": q_ingest_run,
    "landing_replace": q_landing_replace,
    "raw_fields_kept": q_raw_fields_kept,
    "raw_fields_kept_array": q_raw_fields_kept_array,
    "flatten_missing_vs_null": q_flatten_missing_vs_null,
    "ingest_then_curate": q_ingest_then_curate,
    "curate_empty_run": q_curate_empty_run,
    "curate_atomic": q_curate_atomic,
    "curate_with_backfill": q_curate_with_backfill,
    "metric_views_sql": q_metric_views_sql,
    "metric_views_athena": q_metric_views_athena,
    "wow_trend_ordered": q_wow_trend_ordered,
    "flagged_outliers_ordered": q_flagged_outliers_ordered,
}

FLAGSHIP = "daily_avg_warehouse"
