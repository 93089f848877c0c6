"""Station dimension: normalise, enrich, find unresolved ids, upsert, coverage.

Joins here are fact (readings) to dimension (stations) on ``location_id``.
No broadcast is forced: Catalyst broadcasts the dimension only when its
measured size is under ``autoBroadcastJoinThreshold``, and AQE re-plans at
runtime from real shuffle sizes; beyond that it is a sort-merge join whose
skewed partitions (a hot station, or the null-id rows of a left join) AQE
splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.functions.arrays import first_match_id, first_result
from airloom.schema import LOCATION_DIM

DIM_COLUMNS = [f.name for f in LOCATION_DIM.fields]


def normalize_location(details: DataFrame, results: str = "env.results") -> DataFrame:
    """Location detail envelope -> dimension row.

    First element of ``results``; ``city`` from ``locality``; ``country``
    from the ISO code, falling back to the country name when the code is
    null or empty. An empty ``results`` gives a row with null fields.
    """
    loc = first_result(results)
    return details.select(
        F.col("location_id").cast("bigint").alias("location_id"),
        loc["name"].alias("name"),
        loc["locality"].alias("city"),
        F.coalesce(F.nullif(loc["country"]["code"], F.lit("")), loc["country"]["name"]).alias(
            "country"
        ),
    )


def resolve_sensor(details: DataFrame, parameter_id: int, results: str = "env.results"):
    """(location_id, sensor_id): first sensor of the location measuring
    ``parameter_id``, null when none (or when the location is unknown)."""
    loc = first_result(results)
    return details.select(
        F.col("location_id").cast("bigint").alias("location_id"),
        first_match_id(loc["sensors"], parameter_id).alias("sensor_id"),
    )


def distinct_locations(readings: DataFrame, id_col: str = "location_id") -> DataFrame:
    """Distinct non-null station ids (partial aggregation before the shuffle)."""
    return (
        readings.where(F.col(id_col).isNotNull())
        .select(F.col(id_col).cast("bigint").alias("location_id"))
        .distinct()
    )


def unresolved_locations(ids: DataFrame, cache: DataFrame) -> DataFrame:
    """Ids not yet in the dimension cache (left anti join)."""
    return ids.join(cache.select("location_id"), "location_id", "left_anti")


# Buckets over which null-id readings are spread in a lookup join.
NULL_KEY_BUCKETS = 256


def enrich(readings: DataFrame, dim: DataFrame, id_col: str = "location_id") -> DataFrame:
    """Attach ``location_meta`` (name, city, country) to every reading.

    Left outer lookup: unmatched and null ids get a struct of nulls. The
    dimension must hold one row per id (see ``assert_unique``), so the join
    never multiplies readings. Null ids cannot match, but in a shuffled join
    they would all hash to one partition; they get a non-zero salt (a hash
    of the row) while every dimension row has salt 0, so they spread over
    ``NULL_KEY_BUCKETS`` partitions and still match nothing.
    """
    salt = F.when(
        F.col(id_col).isNull(),
        F.lit(1) + F.pmod(F.xxhash64(*[F.col(c) for c in readings.columns]),
                          F.lit(NULL_KEY_BUCKETS)),
    ).otherwise(F.lit(0))
    left = readings.withColumn("_salt", salt.cast("int"))
    d = dim.select(
        F.col("location_id").alias("_dim_id"),
        # 0 for every (non-null) dimension key, written so that Catalyst
        # cannot fold it to a literal: a literal would be dropped from the
        # join keys, and null ids would again share one partition.
        (F.col("location_id") - F.col("location_id")).cast("int").alias("_dim_salt"),
        F.struct("name", "city", "country").alias("_meta"),
    )
    joined = left.join(
        d, (left[id_col] == d["_dim_id"]) & (left["_salt"] == d["_dim_salt"]), "left"
    )
    meta = F.coalesce(
        F.col("_meta"),
        F.struct(*(F.lit(None).cast("string").alias(c) for c in ("name", "city", "country"))),
    )
    return joined.withColumn("location_meta", meta).drop("_dim_id", "_dim_salt", "_meta", "_salt")


def duplicate_keys(dim: DataFrame) -> DataFrame:
    """Dimension ids present more than once (empty when the key is unique)."""
    return dim.groupBy("location_id").count().where(F.col("count") > 1)


def assert_unique(dim: DataFrame) -> DataFrame:
    """Fail when a dimension id repeats; returns ``dim`` unchanged."""
    dups = duplicate_keys(dim).limit(5).collect()
    if dups:
        raise ValueError(f"dimension key location_id is not unique: {dups}")
    return dim


def new_stations(
    cache: DataFrame, resolved: DataFrame, failed: DataFrame | None = None
) -> DataFrame:
    """Resolved rows to add to the cache: neither cached nor failed (one anti join)."""
    known = cache.select("location_id")
    if failed is not None:
        known = known.unionByName(failed.select("location_id"))
    return resolved.join(known, "location_id", "left_anti").select(*DIM_COLUMNS)


def upsert(cache: DataFrame, resolved: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Merge newly resolved rows into the cache, keeping existing entries.

    Rows whose lookup failed (``failed``: ids) are never stored, so the next
    run retries them; a lookup that found nothing is stored (its fields are
    null).
    """
    return cache.select(*DIM_COLUMNS).unionByName(new_stations(cache, resolved, failed))


def load_cache(entries: DataFrame, map_col: str = "cache") -> DataFrame:
    """Cache maps ``{"<id>": {location_id, name, city, country}}`` -> rows.

    Keys are strings in the file and become BIGINT ids (a key that is not a
    number gives a null id instead of failing the job).
    """
    kv = entries.select(F.explode(F.col(map_col)).alias("k", "v"))
    return kv.select(
        F.col("k").try_cast("bigint").alias("location_id"),
        F.col("v.name").alias("name"),
        F.col("v.city").alias("city"),
        F.col("v.country").alias("country"),
    )


def coverage(enriched: DataFrame, id_col: str = "location_id") -> DataFrame:
    """Resolved stations over distinct stations.

    Two-level aggregation: one row per station first (partial aggregation
    absorbs hot stations), then a global count.
    """
    per_station = (
        enriched.where(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.max(F.col("location_meta.city").isNotNull()).alias("_resolved"))
    )
    return per_station.agg(
        F.count(F.lit(1)).alias("distinct_locations"),
        F.count_if(F.col("_resolved")).alias("resolved_locations"),
    ).withColumn(
        "coverage",
        F.col("resolved_locations").cast("double")
        / F.nullif(F.col("distinct_locations"), F.lit(0)).cast("double"),
    )
