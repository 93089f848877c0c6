"""Landed readings made by the tests."""

import json

from pyspark.sql import functions as F

from airloom.schema import RAW_READING

TOWNS = ["Porto", "Gdansk", "Bergen", "Lucca", "Tartu"]


def reading(id=1, value=11.5, utc="2025-10-16T10:00:00Z", **extra):
    """A landed reading of station ``id``, with the metadata that station always has."""
    n = id if isinstance(id, int) else 0
    meta = {"name": f"station {n}", "city": TOWNS[n % 5], "country": "PTPLNOITEE"[n % 5 * 2:][:2]}
    made = {"value": value, "locationsId": id, "sensorsId": n * 10 + 2, "location_meta": meta}
    return {**made, "datetime": {"utc": utc, "local": "ignored"}, **extra}


def raw_frame(spark, records, files=None):
    """Records -> (_file, _pos, record) parsed from JSON text with the raw schema.

    ``files`` gives the landed file of each record (default one file).
    """
    files = files or ["run_000000.json"] * len(records)
    rows, pos = [], {}
    for f, r in zip(files, records):
        p = pos.get(f, 0)
        pos[f] = p + 1
        text = r if isinstance(r, str) else json.dumps(r, allow_nan=True)
        rows.append((f, p, text))
    df = spark.createDataFrame(rows, "_file string, _pos long, text string")
    return df.select(
        "_file", "_pos", F.from_json("text", RAW_READING, {"allowNonNumericNumbers": "true"})
        .alias("record")
    )
