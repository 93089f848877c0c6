"""Raw landing sink (bronze): appends, never cleans, never rewrites.

What has landed stays as it is. A run that lands again does not touch its
earlier files: every line carries the id of its landing, and a log below
``<root>/_runs`` says which (date, run) each landing holds. Readers take the
latest committed landing of a (date, run); the entry is written last, so a
landing that failed half-way is never seen. Files of other origin carry no
landing id and are always read.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators.ordering import numbered
from airloom.schema import LOCATION_META
from airloom.session import scratch_path
from airloom.sources.raw import CONTINUED
from airloom.sources.run_log import entry_path
from airloom.storage import delete, files, folders, move_only_file


def reading_record(
    location_id: Column,
    value: Column,
    utc: Column,
    name: Column | None = None,
    city: Column | None = None,
    country: Column | None = None,
    sensor_id: Column | None = None,
) -> Column:
    """A raw reading struct shaped like the API's latest-reading result.

    ``datetime`` is the nested ``{"utc": ...}`` object and ``location_meta``
    the enrichment struct; absent parts are left out of the JSON.
    """
    fields = [
        location_id.cast("bigint").alias("locationsId"),
        value.cast("double").alias("value"),
        F.struct(utc.cast("string").alias("utc")).alias("datetime"),
    ]
    if sensor_id is not None:
        fields.append(sensor_id.cast("bigint").alias("sensorsId"))
    if name is not None or city is not None or country is not None:
        none = F.lit(None).cast("string")
        fields.append(
            F.struct(
                *(
                    (c if c is not None else none).cast("string").alias(f.name)
                    for c, f in zip((name, city, country), LOCATION_META.fields)
                )
            ).alias("location_meta")
        )
    return F.struct(*fields)


def with_metadata(text: Column, reading: Column, meta: Column) -> Column:
    """A record's JSON text as VARIANT with ``location_meta`` (struct or null) added.

    All fields of the text stay as they are. A record that has the key
    already is written from its parsed ``reading``, with the new metadata.
    """
    inner = F.substring(F.trim(text), F.lit(2), F.length(F.trim(text)) - 2)
    comma = F.when(F.trim(inner) == "", F.lit("")).otherwise(F.lit(","))
    added = F.coalesce(F.to_json(meta, {"ignoreNullFields": "false"}), F.lit("null"))
    whole = F.concat(F.lit("{"), inner, comma, F.lit('"location_meta":'), added, F.lit("}"))
    parsed = F.when(reading.isNotNull(), F.to_json(reading.withField("location_meta", meta)))
    is_object = F.trim(text).startswith("{")
    return F.when(is_object, F.coalesce(F.try_parse_json(whole), F.try_parse_json(parsed))).otherwise(
        F.try_parse_json(text)
    )


def write_raw(
    df: DataFrame,
    root: str,
    record_col: str = "record",
    run_col: str = "run_id",
    pos_col: str = "pos",
    date_col: str = "date",
    mode: str = "append",
    extra_partitions: tuple[str, ...] = (),
    landing: str | None = None,
) -> None:
    """Land records as JSON lines under ``root/date=D/``.

    Every line carries ``run_id`` and ``pos`` so that the scan keeps the
    input order (file, position) that keep-first dedup depends on. The
    default ``append`` never replaces earlier landings; ``overwrite`` with
    dynamic partition overwrite replaces only the partitions present. Rows
    are rebalanced by date, so a day gets a few files rather than one from
    every task. The record is a struct or a VARIANT, which lands as it
    came. ``landing`` marks the lines as part of a landing that is read once
    it is in the run log.
    """
    mark = [F.lit(landing).alias("landing")] if landing else []
    (
        df.hint("rebalance", date_col)
        .sortWithinPartitions(date_col, run_col, pos_col)
        .select(
            F.col(date_col).cast("string").alias("date"),
            F.col(run_col).cast("string").alias("run_id"),
            F.col(pos_col).cast("bigint").alias("pos"),
            *mark,
            F.col(record_col).alias("record"),
            *(F.col(c) for c in extra_partitions),
        )
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date", *extra_partitions)
        .option("compression", "none")
        .json(root)
    )


def order_key(page: Column, pos: Column) -> Column:
    """One BIGINT that orders as (page, position in the page) does, whatever the page size."""
    return F.shiftleft(page.cast("bigint"), 32) + pos.cast("bigint")


def new_landing() -> str:
    """An id of one landing; later landings have greater ids."""
    return f"{time.time_ns():020d}{uuid.uuid4().hex[:8]}"


def replace_runs(landed: DataFrame, root: str) -> DataFrame:
    """Land (date, run_id, pos, record), replacing every (date, run_id) that is present.

    Only adds files: the lines, marked with a landing id, and then one entry
    of the run log. Other runs, other days and files of other origin keep
    every byte; the replaced lines stay too, but readers take the latest
    landing of a (date, run_id). Landing the same rows twice reads as one
    copy; a landing that fails before its entry is written reads as none.
    Returns (date, run_id, rows) of what was landed.
    """
    spark: SparkSession = landed.sparkSession
    fresh = landed.select("date", "run_id", "pos", "record")
    scratch = scratch_path(spark, "landing")
    fresh.write.parquet(scratch)
    new = spark.read.schema(fresh.schema).parquet(scratch)
    counts = new.groupBy("date", "run_id").agg(F.count(F.lit(1)).alias("rows"))
    if new.isEmpty():
        return counts
    landing = new_landing()
    write_raw(new, root, landing=landing)
    entry = entry_path(root, landing)
    counts.withColumn("landing", F.lit(landing)).coalesce(1).write.mode("errorifexists").parquet(entry)
    return spark.read.schema(counts.schema).parquet(entry)


ARRAY_RECORDS = 50_000  # most records of one array file
ARRAY_BYTES = 32 << 20  # and most bytes, unless one record has more


def write_run_array(landed: DataFrame, root: str, date: str, run_id: str) -> str:
    """Land one run of a day as a JSON array, ``root/date=D/<run_id>.json``.

    The layout of the source pipeline: one object per run, replaced when the
    run lands again, and no other object is touched. As a file is read by one
    task, a run of more than ``ARRAY_RECORDS`` records or about
    ``ARRAY_BYTES`` goes on in further arrays ``<run_id>.part-<first
    position>.json``, which sort after the first file and are replaced with
    it; ``read_raw`` gives every record its position in the run. No task
    holds a file's records together. ``landed`` has (pos, record); the files
    are written aside and then moved into place. Returns the first one's path.
    """
    spark = landed.sparkSession
    scratch = scratch_path(spark, "run-array")
    texts = landed.select(F.col("pos").cast("bigint").alias("pos"), F.to_json("record").alias("text"))
    texts.where("text IS NOT NULL").write.parquet(scratch)
    stored = spark.read.schema("pos long, text string").parquet(scratch)
    total, longest = stored.agg(F.count(F.lit(1)), F.max(F.octet_length("text"))).first()
    size = max(1, min(ARRAY_RECORDS, ARRAY_BYTES // (longest + 2))) if total else 1
    aside = f"{root.rstrip('/')}/_arrays/{new_landing()}"
    if total:
        at, place = F.col("place") % size, F.col("place")
        before = F.when(at == 0, F.lit("[")).otherwise(F.lit(""))
        after = F.when((at == size - 1) | (place == total - 1), F.lit("]")).otherwise(F.lit(","))
        lines = numbered(stored, "pos", "text").select(
            (place - at).alias("first"), "place", F.concat(before, "text", after).alias("value")
        )
        lines = lines.repartition("first").sortWithinPartitions("first", "place").drop("place")
    else:
        lines = spark.range(1).coalesce(1).select(F.lit(0).alias("first"), F.lit("[]").alias("value"))
    lines.write.partitionBy("first").text(aside)
    day = f"{root.rstrip('/')}/date={date}"
    path = f"{day}/{run_id}.json"
    for name in files(spark, day):
        if name.startswith(f"{run_id}.part-") and re.search(CONTINUED, name[len(run_id):]):
            delete(spark, f"{day}/{name}")
    for folder in folders(spark, aside):
        first = int(folder.removeprefix("first="))
        move_only_file(spark, f"{aside}/{folder}", f"{day}/{run_id}.part-{first:015d}.json" if first else path)
    delete(spark, aside)
    return path
