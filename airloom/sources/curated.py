"""Curated table scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.schema import CURATED, CURATED_PARTITIONED
from airloom.session import scratch_path
from airloom.storage import exists


def read_curated(spark: SparkSession, root: str) -> DataFrame:
    """Scan the curated table with its declared schema (``date`` is STRING).

    A missing root gives an empty frame with the curated schema.
    """
    try:
        return spark.read.schema(CURATED_PARTITIONED).parquet(root)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" in str(exc) or "Path does not exist" in str(exc):
            return spark.createDataFrame([], CURATED_PARTITIONED)
        raise


def _location(spark: SparkSession, name: str) -> str | None:
    """Where a catalog table lies; None when there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def _plain(path: str) -> str:
    return path.removeprefix("file:").rstrip("/").replace("//", "/")


def register_table(spark: SparkSession, name: str, root: str) -> DataFrame:
    """Declare the curated table over ``root`` and discover its partitions.

    New ``date=`` folders written by path are invisible to a catalog table
    until ``MSCK REPAIR TABLE`` runs; it is run here every time. A table of
    that name over another root is declared anew over this one (an external
    table: the files of the other root stay).
    """
    at = _location(spark, name)
    if at is not None and _plain(at) != _plain(root):
        spark.sql(f"DROP TABLE {name}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in CURATED.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({cols}, `date` STRING) "
        f"USING parquet PARTITIONED BY (`date`) LOCATION '{root}' "
        "OPTIONS (compression 'snappy')"
    )
    spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def _footers(spark: SparkSession, root: str) -> dict[str, list[str]]:
    """Files below ``root`` by their footer's schema (text).

    Names come from Spark's listing; a footer is one small read per file, as
    Spark itself does on the driver to infer a schema. The source pipeline
    writes one file per day.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    paths = [r["path"] for r in names.select("path").collect()]
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    groups: dict[str, list[str]] = {}
    for path in sorted(paths):
        file = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(path), conf)
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(file)
        schema = reader.getFooter().getFileMetaData().getSchema().toString()
        reader.close()
        groups.setdefault(schema, []).append(path)
    return groups


def read_legacy_curated(spark: SparkSession, root: str) -> DataFrame:
    """Scan curated files of a pandas job whose footers differ from file to file.

    One day's file may have BIGINT ids and the next DOUBLE ones (a null among
    them), times in nanoseconds or microseconds, or a column without any
    value, which pandas writes with a type of its own. Files are grouped by
    footer, each group is one scan cast to the curated types, and the groups
    are united. Groups with nanosecond times are read under a session
    setting, so they are written once below the shared scratch root and the
    setting is put back: nothing of it remains. A missing column reads as
    null. A root without files gives an empty table.
    """
    if not exists(spark, root):
        return spark.createDataFrame([], CURATED_PARTITIONED)
    out = spark.createDataFrame([], CURATED_PARTITIONED)
    for schema, paths in _footers(spark, root).items():
        out = out.unionByName(_nanos_group(spark, root, paths) if "NANOS" in schema else _group(spark, root, paths))
    return out


def _group(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    """Files of one footer, cast to the curated types."""
    df = spark.read.option("mergeSchema", "false").option("basePath", root).parquet(*paths)
    columns = []
    for f in CURATED_PARTITIONED.fields:
        if f.name not in df.columns:
            columns.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif f.name == "date_utc" and df.schema["date_utc"].dataType.simpleString() == "bigint":
            # Whole microseconds by integer arithmetic: a double would be off by one.
            micros = F.timestamp_micros(F.expr("(date_utc - pmod(date_utc, 1000L)) div 1000L"))
            columns.append(micros.cast(f.dataType).alias(f.name))
        else:
            columns.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*columns)


def _nanos_group(spark: SparkSession, root: str, paths: list[str]) -> DataFrame:
    setting = "spark.sql.legacy.parquet.nanosAsLong"
    before = spark.conf.get(setting, "false")
    path = scratch_path(spark, "legacy")
    spark.conf.set(setting, "true")
    try:
        _group(spark, root, paths).write.parquet(path)
    finally:
        spark.conf.set(setting, before)
    return spark.read.schema(CURATED_PARTITIONED).parquet(path)
