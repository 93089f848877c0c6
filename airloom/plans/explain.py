"""Plan text for checks: what ``df.explain(mode)`` prints, as a string."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The output of ``df.explain(mode)``; raise
    ``spark.sql.maxMetadataStringLength`` to see whole pushed-filter lists."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()
