"""Delta curation: a landing changes only the dedup keys whose winner it changes.

The table keeps, for every landing date, the winners: the first valid reading
of each dedup key, with its landing position (file, position). A run reads
the new files only. Their readings are cleaned and deduplicated among
themselves, compared with the stored positions of their keys (a scan of the
key and position columns of the touched dates, not of the raw days), and
those that come first are appended. Readers resolve a key that was appended
twice by position, which ``compact`` does for good.

What cannot be told from new files alone makes a date be built again from
its raw files: a run that landed again and so takes readings away, and lines
of a landing whose log entry was not there yet when the stream saw them.

Layout of the table: ``winners/batch=<id>/date=D/`` and ``voids/<id>``, which
lists the (date, batch) that a rebuilt batch takes the place of. A rebuilt
batch counts from the moment that its voids are written.
"""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.operators import clean as C
from airloom.options import FlattenOptions, QualityRules
from airloom.schema import CURATED_COLUMNS, CURATED_PARTITIONED
from airloom.session import scratch_path
from airloom.sources.raw import array_rows, day_of_file, line_rows, parse_lines, read_raw_dates, with_holds
from airloom.sources.run_log import committed
from airloom.storage import delete, exists, folders

KEPT = [
    "location_id", "location_name", "city", "country", "parameter", "value", "unit", "date_utc",
    "is_extreme_outlier", "_file", "_pos",
]
WINNERS = (
    "location_id long, location_name string, city string, country string, parameter string, value double, "
    "unit string, date_utc string, is_extreme_outlier boolean, _file string, _pos long, date string, batch string"
)
VOIDS = "date string, batch string"
NOTES = "date string, landing string"
REBUILT = "rebuilt-"


def _keys(rules: QualityRules) -> list:
    if rules.dedup_scope != "partition":
        raise ValueError("delta curation keeps winners per landing date; use curate_incremental for global scope")
    return ["date", *C._dedup_keys(rules)]


def _batches(spark: SparkSession, root: str) -> list[str]:
    """Committed batches: written whole and, if rebuilt, with their voids."""
    found = [f.removeprefix("batch=") for f in folders(spark, f"{root}/winners") if f.startswith("batch=")]
    whole = [b for b in found if exists(spark, f"{root}/winners/batch={b}/_SUCCESS")]
    return [b for b in whole if not b.startswith(REBUILT) or exists(spark, f"{root}/voids/{b}/_SUCCESS")]


def winners(spark: SparkSession, root: str, dates: Sequence[str] | None = None) -> DataFrame:
    """The stored winners (a key may occur in several batches; the first position holds)."""
    root = root.rstrip("/")
    batches = _batches(spark, root)
    paths = [f"{root}/winners/batch={b}" for b in batches if len(folders(spark, f"{root}/winners/batch={b}"))]
    if not paths:
        return spark.createDataFrame([], WINNERS)
    rows = spark.read.schema(WINNERS).option("basePath", f"{root}/winners").parquet(*paths)
    if dates is not None:
        rows = rows.where(F.col("date").isin(list(dates)))  # partition pruning
    voids = [f"{root}/voids/{b}" for b in batches if b.startswith(REBUILT)]
    if voids:
        rows = rows.join(spark.read.schema(VOIDS).parquet(*voids).distinct(), ["date", "batch"], "left_anti")
    return rows


def read_delta(spark: SparkSession, root: str, rules: QualityRules = QualityRules()) -> DataFrame:
    """The curated table (``schema.CURATED`` and ``date``) as of the last committed batch."""
    first = C.dedup_first(winners(spark, root), _keys(rules), ["_file", "_pos"])
    return C.parse_dates(first).select(*CURATED_COLUMNS, "date").to(CURATED_PARTITIONED)


def _valid(rows: DataFrame, rules: QualityRules, flatten: FlattenOptions) -> DataFrame:
    flat = C.flatten_readings(rows.drop("raw"), "record", flatten)
    valid = C.flag_outliers(C.drop_invalid(flat, rules), rules)
    return C.dedup_first(valid, _keys(rules), ["_file", "_pos"]).select(*KEPT, "date")


def _write(rows: DataFrame, path: str) -> None:
    (
        rows.hint("rebalance", "date").sortWithinPartitions("date", "date_utc")
        .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("date").parquet(path)
    )


def _append(spark: SparkSession, rows: DataFrame, root: str, batch: str, rules: QualityRules, dates: list[str]) -> dict:
    """Append the winners among new readings; a batch that is run again replaces itself."""
    path = scratch_path(spark, "new-winners")
    rows.write.parquet(path)
    new = spark.read.schema(rows.schema).parquet(path)
    keys = [F.col(k).alias(f"_k{i}") if isinstance(k, str) else k.alias(f"_k{i}") for i, k in enumerate(_keys(rules))]
    names = [f"_k{i}" for i in range(len(keys))]
    stored = winners(spark, root, dates).where(F.col("batch") != batch)
    first = stored.select(*keys, F.struct("_file", "_pos").alias("_at")).groupBy(*names).agg(F.min("_at").alias("_first"))
    own = new.select("*", *(k.alias(f"_n{i}") for i, k in enumerate(keys)))
    same = None
    for i in range(len(names)):
        one = F.col(f"_n{i}").eqNullSafe(F.col(f"_k{i}"))
        same = one if same is None else same & one
    joined = own.join(first, same, "left")
    wins = joined.where(F.col("_first").isNull() | (F.struct("_file", "_pos") < F.col("_first"))).select(*KEPT, "date")
    _write(wins, f"{root}/winners/batch={batch}")
    written = spark.read.schema(WINNERS).parquet(f"{root}/winners/batch={batch}")
    return {"candidates": new.count(), "changed": written.count()}


def _replace(spark: SparkSession, rows: DataFrame, root: str, dates: Sequence[str]) -> None:
    """Give ``dates`` new winners in place of all that they have."""
    before = _batches(spark, root)
    batch = f"{REBUILT}{time.time_ns():020d}{uuid.uuid4().hex[:8]}"
    _write(rows, f"{root}/winners/batch={batch}")
    void = spark.createDataFrame([(d, b) for d in dates for b in before], VOIDS)
    void.coalesce(1).write.parquet(f"{root}/voids/{batch}")


def compact(spark: SparkSession, root: str, dates: Sequence[str], rules: QualityRules = QualityRules()) -> None:
    """Store ``dates`` as one batch with one row per key."""
    root = root.rstrip("/")
    _replace(spark, C.dedup_first(winners(spark, root, dates), _keys(rules), ["_file", "_pos"]).select(*KEPT, "date"), root, dates)


def _new_rows(spark: SparkSession, root: str, batch: DataFrame, layout: str) -> tuple[DataFrame, DataFrame]:
    """Readings of a micro-batch that hold, and notes (date, landing) of dates to build again:
    with a landing once it is committed, without one now."""
    if layout == "array":
        return array_rows(batch.select("date", "_file", "value")), spark.createDataFrame([], NOTES)
    lines = with_holds(spark, root, parse_lines(batch.where(F.trim("value") != "").select("date", "value")))
    log = committed(spark, root)
    again = log.groupBy("date", "run_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = lines.where(F.col("l.landing").isNotNull()).select("date", F.col("l.run_id").alias("run_id"), F.col("l.landing").alias("landing")).distinct()
    path = scratch_path(spark, "landings")  # one pass over the lines for both kinds of notes
    marked.write.parquet(path)
    own = spark.read.schema(marked.schema).parquet(path)
    rerun = own.join(again, ["date", "run_id"], "left_semi").select("date", F.lit(None).cast("string").alias("landing"))
    waiting = own.join(log, "landing", "left_anti").select("date", "landing")
    return line_rows(lines.where("_holds")), rerun.unionByName(waiting).distinct()


def _due(spark: SparkSession, checkpoint: str, roots: Sequence[str]) -> list[str]:
    """Dates to build again now; notes whose landing is not committed yet are kept."""
    folder = f"{checkpoint}/notes"
    noted = folders(spark, folder)
    if not noted:
        return []
    notes = spark.read.schema(NOTES).parquet(*(f"{folder}/{f}" for f in noted)).distinct()
    log = committed(spark, roots[0]).select("landing")
    for r in roots[1:]:
        log = log.unionByName(committed(spark, r).select("landing"))
    rest = notes.where("landing IS NOT NULL").join(log, "landing", "left_anti").select("date", "landing").collect()
    due = notes.where("landing IS NULL").unionByName(notes.join(log, "landing", "left_semi").select("date", "landing"))
    dates = sorted(r["date"] for r in due.select("date").distinct().collect())  # days, not rows
    if rest:
        spark.createDataFrame(rest, NOTES).coalesce(1).write.parquet(f"{folder}/rest-{uuid.uuid4().hex[:12]}")
    return dates


def curate_delta(
    spark: SparkSession,
    raw_root: str | Sequence[str],
    table_root: str,
    checkpoint: str,
    rules: QualityRules = QualityRules(),
    flatten: FlattenOptions = FlattenOptions(),
    layout: str = "lines",
    max_files: int | None = None,
) -> dict:
    """Bring the table up to date with every raw file landed since the last run, then stop.

    Equals a full curation with per-date scope (``read_delta``). Returns the
    numbers of the run: new readings that came first among the new ones
    (candidates), winners appended (changed), dates built again (rebuilt).
    Whoever lands arrays in place (``write_run_array`` again) must have the
    day built again: the stream knows files by name.
    """
    _keys(rules)
    roots = [raw_root] if isinstance(raw_root, str) else list(raw_root)
    table_root = table_root.rstrip("/")
    totals = {"candidates": 0, "changed": 0}
    old_notes = folders(spark, f"{checkpoint}/notes")
    for root in roots:
        if not exists(spark, root):
            continue
        name = hashlib.sha256(root.rstrip("/").encode()).hexdigest()[:12]

        def each(batch: DataFrame, batch_id: int, root: str = root, name: str = name) -> None:
            session = batch.sparkSession
            batch = batch.persist()  # read once for its rows, notes and dates
            rows, notes = _new_rows(session, root, batch, layout)
            dates = sorted(r["date"] for r in batch.select("date").distinct().collect())  # days, not rows
            token = f"{name}-{batch_id:012d}"
            notes.coalesce(1).write.mode("overwrite").parquet(f"{checkpoint}/notes/{token}")
            for k, v in _append(session, _valid(rows, rules, flatten), table_root, token, rules, dates).items():
                totals[k] += v
            batch.unpersist()

        reader = spark.readStream.option("pathGlobFilter", "*.json")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", max_files)
        files = reader.text(f"{root.rstrip('/')}/date=*", wholetext=layout == "array")
        rows = files.select(day_of_file().alias("date"), F.col("_metadata.file_path").alias("_file"), "value")
        query = (
            rows.writeStream.foreachBatch(each).option("checkpointLocation", f"{checkpoint}/stream-{name}")
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        if query.exception() is not None:
            raise query.exception()
    noted = folders(spark, f"{checkpoint}/notes")
    dates = _due(spark, checkpoint, roots)
    if dates:
        _replace(spark, _valid(read_raw_dates(spark, roots, dates, layout=layout), rules, flatten), table_root, dates)
    for f in {*noted, *old_notes}:
        delete(spark, f"{checkpoint}/notes/{f}")
    return totals | {"rebuilt": len(dates)}
