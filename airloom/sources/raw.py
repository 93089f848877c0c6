"""Scan of the raw landing area ``<root>/date=YYYY-MM-DD/*.json``.

Two layouts are read:

* ``array``: one JSON array per file (what the ingestion lands), pretty
  printed or compact. A file is read and parsed by one task, so a file must
  fit a task's memory; many small files are packed into one task. A large
  run that ``sinks.raw.write_run_array`` landed in several files keeps its
  positions: the later files are named by the first one they hold.
* ``lines``: one JSON object per line with explicit ``run_id`` and ``pos``
  (what ``sinks.raw.write_raw`` writes). Splittable. Lines of a landing that
  the run log does not name as the latest of its (date, run) are left out.
* ``auto``: both in one root, told apart by file name: Spark's writers name
  their files ``part-...``, every other file is an array.

All return ``date`` (partition, STRING), ``_file`` and ``_pos`` (the input
order used by keep-first dedup: ``_pos`` increases along each file) and
``record`` (``schema.RAW_READING``).

Every record is parsed by itself and every field of it by itself: a value of
the wrong type is null in its field and harms no other field, record or
file, and the rows do not depend on the columns that are asked for. A file
that is no JSON array, an element that is no object and a line that does not
parse each give one row with a null ``record``. What the declared fields do
not hold (unknown fields, quoted numbers, a missing key beside a null) is in
the record's VARIANT, which the scan adds on request.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airloom.schema import RAW_READING
from airloom.sources.run_log import any_entry, latest

RAW_SCAN = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("_file", T.StringType()),
        T.StructField("_pos", T.LongType()),
        T.StructField("record", RAW_READING),
        T.StructField("raw", T.VariantType()),
    ]
)

ID_FIELDS = ("locationsId", "locationId", "sensorsId")
# As parsed: ids are taken as text, so that 4, 4.0 and "4" are one id.
PARSED_READING = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name in ID_FIELDS else f.dataType)
        for f in RAW_READING.fields
    ]
)
# Line layout written by our own sink.
RAW_LINE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("pos", T.LongType()),
        T.StructField("landing", T.StringType()),
        T.StructField("record", PARSED_READING),
    ]
)
LINE_FILES = "part-*"  # the names that Spark's writers give
# A large run's further arrays (``sinks.raw.write_run_array``), named by their first position.
CONTINUED = r"\.part-(\d{15})\.json$"
OTHER_FILES = "{[!p],p[!a],pa[!r],par[!t],part[!-]}*"

JSON_OPTIONS = {"allowNonNumericNumbers": "true"}


def empty_raw(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RAW_SCAN)


def _is_missing_path(exc: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc)


def _whole_id(text: Column) -> Column:
    """A BIGINT id from its text; null when it is no whole number."""
    number = text.try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))


def _reading(parsed: Column) -> Column:
    """``PARSED_READING`` -> ``RAW_READING``; a null struct stays null."""
    fields = [
        (_whole_id(parsed[f.name]) if f.name in ID_FIELDS else parsed[f.name]).alias(f.name)
        for f in RAW_READING.fields
    ]
    return F.when(parsed.isNotNull(), F.struct(*fields))


def _once(parsed: Column) -> Column:
    """A parsed column as a generated one: filters on its fields stay above it, where a
    projection's would be moved below and parse the text again for every condition."""
    return F.explode(F.array(parsed))


def parse_reading(text: Column, opts: dict | None = None) -> Column:
    """``schema.RAW_READING`` of one record's JSON text; null unless it is an object."""
    parsed = F.when(F.ltrim(text).startswith("{"), F.from_json(text, PARSED_READING, opts or JSON_OPTIONS))
    # Bound once: every field of a conditional struct would parse the text again.
    return F.transform(F.array(parsed), _reading)[0]


def with_holds(spark: SparkSession, root: str, lines: DataFrame) -> DataFrame:
    """Parsed lines (date, l, ...) with ``_holds``: whether they belong to no landing, or to
    the one that the run log of ``root`` names as the latest of their (date, run).

    One pass over the lines. Those without a landing id can match nothing
    and get keys of their own, so that they do not meet in one task. Without
    a log there is nothing to look up, and no line is shuffled.
    """
    if not any_entry(spark, root):
        return lines.withColumn("_holds", F.col("l.landing").isNull())
    now = latest(spark, root).select(
        F.col("date").alias("_date"), F.col("run_id").alias("_run"), F.col("landing").alias("_landing")
    )
    spread = F.concat(F.lit("none "), (F.xxhash64("l.pos", "l.run_id") % 4096).cast("string"))
    keyed = lines.withColumn("_key", F.coalesce(F.col("l.landing"), spread))
    same = (F.col("_key") == F.col("_landing")) & (F.col("date") == F.col("_date")) & (
        F.col("l.run_id") == F.col("_run")
    )
    holds = F.col("l.landing").isNull() | F.col("_landing").isNotNull()
    joined = keyed.join(now, same, "left").withColumn("_holds", holds)
    return joined.drop("_key", "_date", "_run", "_landing")


def parse_lines(lines: DataFrame, opts: dict | None = None) -> DataFrame:
    """Lines (date, value) -> (date, value, l), ``l`` being the parsed line."""
    return lines.select("date", "value", _once(F.from_json("value", RAW_LINE, opts or JSON_OPTIONS)).alias("l"))


def line_rows(parsed: DataFrame) -> DataFrame:
    """Parsed lines in the columns of the scan."""
    return parsed.select(
        "date",
        F.col("l.run_id").alias("_file"),
        F.col("l.pos").alias("_pos"),
        _reading(F.col("l.record")).alias("record"),
        F.try_variant_get(F.try_parse_json("value"), "$.record", "variant").alias("raw"),
    )


def _read_lines(spark, root, reader, opts, dates) -> DataFrame:
    lines = reader.text(root).where(F.trim("value") != "")
    if "date" not in lines.columns:  # no such file in any day
        return empty_raw(spark)
    lines = lines.withColumn("date", F.col("date").cast("string"))
    if dates is not None:
        lines = lines.where(F.col("date").isin(*dates))  # partition pruning
    return line_rows(with_holds(spark, root, parse_lines(lines, opts)).where("_holds"))


def array_rows(files: DataFrame, opts: dict | None = None) -> DataFrame:
    """Whole files (date, _file, value) in the columns of the scan."""
    opts = opts or JSON_OPTIONS
    files = files.select(
        "date", "_file", F.from_json("value", T.ArrayType(T.StringType()), opts).alias("_texts")
    )
    # An unreadable file keeps one row, without a position.
    nothing = F.struct(F.lit(None).cast("bigint").alias("p"), F.lit(None).cast("string").alias("t"))
    each = F.transform("_texts", lambda t, p: F.struct(p.cast("bigint").alias("p"), t.alias("t")))
    rows = F.when(F.col("_texts").isNull(), F.array(nothing)).otherwise(each)
    text = F.col("_row.t")
    first = F.regexp_extract("_file", CONTINUED, 1).try_cast("bigint")
    pos = F.col("_row.p") + F.coalesce(first, F.lit(0).cast("bigint"))
    return files.select("date", "_file", F.explode(rows).alias("_row")).select(
        "date", "_file", pos.alias("_pos"), _once(parse_reading(text, opts)).alias("record"),
        F.try_parse_json(text).alias("raw"),
    )


def day_of_file() -> Column:
    """The ``date=`` folder of the file that a row is read from."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"/date=([^/]+)/[^/]*$", 1)


def _read_arrays(root, reader, opts, dates) -> DataFrame:
    # Records may carry a legacy "date" key and files lie by day: the
    # date directories are globbed, which lists only the requested dates.
    days = "*" if dates is None else "{" + ",".join(dates) + "}"
    files = reader.text(f"{root.rstrip('/')}/date={days}", wholetext=True)
    path = F.col("_metadata.file_path").alias("_file")
    return array_rows(files.select(day_of_file().alias("date"), path, "value"), opts)


def read_raw(
    spark: SparkSession,
    root: str | Sequence[str],
    layout: str = "array",
    mode: str = "PERMISSIVE",
    with_corrupt: bool = False,
    dates: Sequence[str] | None = None,
    pattern: str = "*.json",
    with_raw: bool = False,
) -> DataFrame:
    """Scan every ``*.json`` landing file under ``root`` (one root or several).

    ``pattern`` names other files than ``*.json`` (not with ``auto``).
    ``with_raw`` adds ``raw``, the whole record as a VARIANT.
    A missing ``root`` gives an empty frame with the scan schema. Whatever
    cannot be read is a row with a null ``record`` (so a cleaning run counts
    it as invalid); an unreadable array file has a null ``_pos`` as well.
    ``with_corrupt`` adds ``_corrupt`` to mark those rows;
    ``mode="FAILFAST"`` fails the job instead.
    """
    if not isinstance(root, str):
        # Several landing roots (run landings, backfill landings): scan
        # each with its own file listing, then union.
        frames = [read_raw(spark, r, layout, mode, with_corrupt, dates, pattern, with_raw) for r in root]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out
    if layout not in ("array", "lines", "auto"):
        raise ValueError(f"layout must be 'array', 'lines' or 'auto', got {layout!r}")
    if layout == "auto":
        parts = [
            read_raw(spark, root, one, mode, with_corrupt, dates, f"{names}.json", with_raw)
            for one, names in (("array", OTHER_FILES), ("lines", LINE_FILES))
        ]
        return parts[0].unionByName(parts[1])
    opts = {**JSON_OPTIONS, "mode": mode}
    reader = spark.read.option("pathGlobFilter", pattern)
    try:
        if layout == "lines":
            out = _read_lines(spark, root, reader, opts, dates)
        else:
            out = _read_arrays(root, reader, opts, dates)
    except AnalysisException as exc:
        if not _is_missing_path(exc):
            raise
        out = empty_raw(spark)
    if not with_raw:
        out = out.drop("raw")
    return out.withColumn("_corrupt", F.col("record").isNull()) if with_corrupt else out


def read_raw_dates(
    spark: SparkSession, root: str | Sequence[str], dates: list[str] | None = None, **kwargs
) -> DataFrame:
    """``read_raw`` restricted to whole ``date`` partitions (static pruning).

    Dates must be ``YYYY-MM-DD``: a bare prefix such as ``2026-08`` is
    rejected instead of silently taking a month.
    """
    if dates is not None:
        dates = list(dates)
        for d in dates:
            if not _is_day(d):
                raise ValueError(f"expected a YYYY-MM-DD date, got {d!r}")
    return read_raw(spark, root, dates=dates, **kwargs)


def _is_day(text: str) -> bool:
    import re

    return re.fullmatch(r"\d{4}-\d{2}-\d{2}", text) is not None
