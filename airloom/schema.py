"""Explicit schemas: raw JSON shapes are declared, never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

LOCATION_META = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

# One raw reading as landed. ``datetime`` is declared STRING so that Spark
# keeps the nested JSON text of an object and the bare text of a scalar,
# which lets the flattener tell the two shapes apart.
RAW_READING = T.StructType(
    [
        T.StructField("locationsId", T.LongType()),
        T.StructField("locationId", T.LongType()),
        T.StructField("sensorsId", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("datetime", T.StringType()),
        T.StructField("date", T.StringType()),
        T.StructField("date_utc", T.StringType()),
        T.StructField("location_meta", LOCATION_META),
    ]
)

RAW_ARRAY = T.ArrayType(RAW_READING)

# Latest-readings page envelope.
READINGS_PAGE = T.StructType([T.StructField("results", RAW_ARRAY)])

# Any page envelope with its results left as JSON text, field for field.
RESULT_TEXTS = T.StructType([T.StructField("results", T.ArrayType(T.StringType()))])

SENSOR = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField(
            "parameter",
            T.StructType(
                [T.StructField("id", T.LongType()), T.StructField("name", T.StringType())]
            ),
        ),
    ]
)

LOCATION_RESULT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("locality", T.StringType()),
        T.StructField(
            "country",
            T.StructType(
                [T.StructField("code", T.StringType()), T.StructField("name", T.StringType())]
            ),
        ),
        T.StructField("sensors", T.ArrayType(SENSOR)),
    ]
)

# Location detail / catalogue page envelope.
LOCATION_PAGE = T.StructType([T.StructField("results", T.ArrayType(LOCATION_RESULT))])

MEASUREMENT = T.StructType(
    [
        T.StructField("value", T.DoubleType()),
        T.StructField(
            "period",
            T.StructType(
                [
                    T.StructField(
                        "datetimeFrom", T.StructType([T.StructField("utc", T.StringType())])
                    )
                ]
            ),
        ),
    ]
)

# Historical measurements page envelope.
MEASUREMENT_PAGE = T.StructType([T.StructField("results", T.ArrayType(MEASUREMENT))])

# Station dimension row (also the value type of the cache map).
LOCATION_DIM = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
    ]
)

LOCATION_CACHE = T.MapType(T.StringType(), LOCATION_DIM)

# Curated table. ``date_utc`` is a zone-less UTC wall-clock timestamp, as the
# table's TIMESTAMP column; ``date`` (STRING) is the partition column.
CURATED_COLUMNS = [
    "location_id",
    "location_name",
    "city",
    "country",
    "parameter",
    "value",
    "unit",
    "date_utc",
    "is_extreme_outlier",
]

CURATED = T.StructType(
    [
        T.StructField("location_id", T.LongType()),
        T.StructField("location_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("parameter", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("date_utc", T.TimestampNTZType()),
        T.StructField("is_extreme_outlier", T.BooleanType()),
    ]
)

CURATED_PARTITIONED = T.StructType(CURATED.fields + [T.StructField("date", T.StringType())])
