"""airloom: Spark-native curation and metrics for environmental sensor readings.

Raw nested JSON observations are scanned, joined to a station dimension,
cleaned (sentinel and floor filters, outlier flag, keep-first dedup, safe
timestamp parsing), written to a date-partitioned Parquet table and queried
by a small set of metric operators. Every public operator is a
``DataFrame -> DataFrame`` function built from Spark's own expressions.
"""

from airloom.options import FlattenOptions, MetricOptions, QualityRules
from airloom.session import build_session, configure

__all__ = [
    "FlattenOptions",
    "MetricOptions",
    "QualityRules",
    "build_session",
    "configure",
]
