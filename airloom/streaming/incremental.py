"""Incremental curation with Structured Streaming.

New raw files are picked up by a file stream per landing root
(``trigger(availableNow)``: process what has landed, then stop; the
checkpoint remembers which files were seen). A micro-batch holds only the
*new* files, so overwriting a date with them alone would lose that date's
earlier rows. The stream therefore only notes which dates were touched, and
the run then re-curates those dates once, from the full raw partitions of
all roots: per-date keep-first dedup stays exact and reruns are idempotent.
Noted dates are kept in the checkpoint folder until their curation is done,
so a run that fails in between loses none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators import clean as C
from airloom.options import FlattenOptions, QualityRules
from airloom.plans.jobs import curate
from airloom.storage import delete, exists, folders

NOTE = "token string, date string"
FILE = "path string, modificationTime timestamp, length long, content binary"  # the source's own columns


def touched_stream(
    spark: SparkSession,
    raw_root: str,
    max_files: int | None = None,
    max_file_age: str | None = None,
) -> DataFrame:
    """File stream over a landing root: the ``date`` of every new file's rows.

    Only the file paths matter here: files are listed, none is opened, so one
    reader serves both layouts and no content can break it. ``max_files``
    bounds a micro-batch;
    ``max_file_age`` (e.g. ``"30d"``) bounds the stream's log of seen files
    on a landing area that keeps growing.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", "*.json")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_file_age:
        reader = reader.option("maxFileAge", max_file_age)
    files = reader.load(f"{raw_root.rstrip('/')}/date=*")
    return files.select(F.regexp_extract("path", r"/date=([^/]+)/[^/]*$", 1).alias("date"))


def _note(batch: DataFrame, folder: str, token: str) -> None:
    """Note the dates of a batch; a batch that is run again notes the same."""
    dates = batch.select(F.lit(token).alias("token"), "date").distinct()
    dates.write.mode("overwrite").parquet(f"{folder}/touched/batch={token}")


def _noted(spark: SparkSession, folder: str) -> tuple[list[str], list[str]]:
    """Notes (folder names) whose curation is not done, and their dates."""
    names = folders(spark, f"{folder}/touched")
    if not names:
        return [], []
    notes = spark.read.schema(NOTE).parquet(*(f"{folder}/touched/{n}" for n in names))
    return names, sorted(r["date"] for r in notes.select("date").distinct().collect() if r["date"])


def curate_incremental(
    spark: SparkSession,
    raw_root: str | Sequence[str],
    out_root: str,
    checkpoint: str,
    rules: QualityRules = QualityRules(),
    flatten: FlattenOptions = FlattenOptions(),
    max_files: int | None = None,
    max_file_age: str | None = None,
    layout: str = "lines",
) -> list[str]:
    """Process every raw file landed since the last run, then stop.

    ``raw_root`` is what ``curate`` takes: one landing root or all of them
    (run landings, backfill landings). A root without any date folder is
    looked at again by the next run. Returns the dates that were re-curated;
    a run over unchanged input returns none. With global dedup scope a new
    landing re-curates all dates together.

    The dates of a run are partition values (at most one per calendar day),
    so they are brought to the driver for static partition pruning.
    """
    roots = [raw_root] if isinstance(raw_root, str) else list(raw_root)
    for root in roots:
        if not exists(spark, root):
            continue
        name = hashlib.sha256(root.rstrip("/").encode()).hexdigest()[:12]

        def each(batch: DataFrame, batch_id: int, name: str = name) -> None:
            _note(batch, checkpoint, f"{name}-{batch_id}")

        query = (
            touched_stream(spark, root, max_files, max_file_age)
            .writeStream.foreachBatch(each)
            .option("checkpointLocation", f"{checkpoint}/stream-{name}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    notes, dates = _noted(spark, checkpoint)
    if dates:
        whole = rules.dedup_scope == "global"
        curate(spark, roots, out_root, None if whole else dates, layout, rules, flatten)
    for n in notes:  # a run that dies before this curates their dates once more
        delete(spark, f"{checkpoint}/touched/{n}")
    return dates


def clean_append_stream(
    flat_stream: DataFrame,
    rules: QualityRules = QualityRules(),
    watermark: str = "2 hours",
) -> DataFrame:
    """Append-mode cleaning for a stream of flat readings (weaker variant).

    Duplicates are dropped only within the watermark delay and the kept
    copy is the first to arrive, not the first in landing order, so this
    does not reproduce keep-first exactly; ``curate_incremental`` does.
    """
    valid = C.flag_outliers(C.drop_invalid(flat_stream, rules), rules)
    parsed = C.parse_dates(valid.withColumn("_raw_ts", F.col("date_utc")))
    # Watermarks need an instant type; date_utc is UTC wall clock (NTZ).
    return (
        parsed.withColumn("_event_time", F.col("date_utc").cast("timestamp"))
        .withWatermark("_event_time", watermark)
        .dropDuplicatesWithinWatermark(["location_id", "parameter", "_raw_ts"])
        .drop("_raw_ts", "_event_time")
    )
