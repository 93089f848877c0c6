"""CSV export of curated partitions."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from airloom.schema import CURATED_COLUMNS
from airloom.sources.curated import read_curated


def export_csv(spark: SparkSession, curated_root: str, dates: list[str], out: str) -> None:
    """Write whole curated partitions as UTF-8 CSV with a header row.

    Partition pruning reads only the requested dates; output stays split
    across tasks (one file per task). A byte-order mark is not written: it
    is not a charset option of Spark's CSV writer.
    """
    df = read_curated(spark, curated_root).where(F.col("date").isin(*dates))
    (
        df.select(*CURATED_COLUMNS, "date")
        .write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("encoding", "UTF-8")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
        .partitionBy("date")
        .csv(out)
    )
