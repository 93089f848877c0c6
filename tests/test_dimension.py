"""Station dimension: normalisation, lookup, cache, sensors, versions."""

import json
import os

from pyspark.sql import functions as F

from airloom.operators import dimension as D
from airloom.plans.explain import plan_text
from airloom.schema import LOCATION_CACHE, LOCATION_DIM, LOCATION_PAGE
from airloom.sinks.dimension import KEEP_VERSIONS, read_dimension, write_dimension
from airloom.sources.pages import parse_envelope

# What the detail of a station may look like, and the row it should become.
SHAPES = [
    ({"name": "Ponte", "locality": "Porto", "country": {"code": "PT", "name": "Portugal"}}, ("Ponte", "Porto", "PT")),
    ({"name": "Molo", "locality": None, "country": {"code": "", "name": "Poland"}}, ("Molo", None, "Poland")),
    ({"name": None, "locality": " ", "country": {"code": None, "name": "Norway"}}, (None, " ", "Norway")),
    ({"name": "Torre", "country": {}}, ("Torre", None, None)),
    ({"locality": "Tartu", "country": None}, (None, "Tartu", None)),
    (None, (None, None, None)),
]


def details(spark, results):
    """results: {location_id: list of detail results}"""
    rows = [(k, json.dumps({"results": v})) for k, v in results.items()]
    return parse_envelope(spark.createDataFrame(rows, "location_id long, text string"), "text", LOCATION_PAGE)


def stations(spark, ids, name="s"):
    return spark.createDataFrame([(i, f"{name}{i}", f"c{i % 3}" if i % 4 else None, "NO") for i in ids], LOCATION_DIM)


def ids_of(df):
    return sorted((r.location_id for r in df.collect()), key=str)


def test_every_detail_shape(spark):
    d = details(spark, {i: [] if shape is None else [shape, {"name": "second"}] for i, (shape, _) in enumerate(SHAPES)})
    got = {r.location_id: (r.name, r.city, r.country) for r in D.normalize_location(d).collect()}
    assert got == {i: row for i, (_, row) in enumerate(SHAPES)}


def test_ids_to_look_up(spark):
    seen = spark.createDataFrame([(i % 9 if i % 10 else None,) for i in range(100)], "location_id long")
    ids = D.distinct_locations(seen)
    assert ids_of(ids) == list(range(9))
    assert ids_of(D.unresolved_locations(ids, stations(spark, [0, 2, 4, 6, 8, 50]))) == [1, 3, 5, 7]


def test_upsert_adds_what_is_neither_known_nor_failed(spark):
    cache, resolved = stations(spark, range(0, 6), "old"), stations(spark, range(4, 12), "new")
    failed = spark.createDataFrame([(9,), (2,), (77,)], "location_id long")
    merged = D.upsert(cache, resolved, failed)
    got = {r.location_id: r.name for r in merged.collect()}
    assert got == {**{i: f"old{i}" for i in range(6)}, **{i: f"new{i}" for i in (6, 7, 8, 10, 11)}}
    assert merged.columns == D.DIM_COLUMNS
    tree = plan_text(D.new_stations(cache, resolved, failed)).split("\n\n")[0]
    assert sum("Join" in line for line in tree.splitlines()) == 1


def test_lookup_adds_metadata_and_no_rows(spark):
    readings = spark.createDataFrame([(i % 7 if i % 5 else None, float(i)) for i in range(70)], "location_id long, value double")
    out = D.enrich(readings, D.assert_unique(stations(spark, [1, 3, 5]))).collect()
    assert sorted(r.value for r in out) == [float(i) for i in range(70)]
    for r in out:
        assert r.location_meta.name == (f"s{r.location_id}" if r.location_id in (1, 3, 5) else None)


def test_repeated_station_is_refused(spark):
    import pytest

    with pytest.raises(ValueError):
        D.assert_unique(stations(spark, [1, 2, 2]))


def test_cache_map_keys_become_ids(spark):
    entry = {str(k): {"location_id": k, "name": f"n{k}", "city": None} for k in (3, 10**12)}
    text = spark.createDataFrame([(json.dumps({**entry, "no id": {"name": "x"}}),)], "t string")
    rows = D.load_cache(text.select(F.from_json("t", LOCATION_CACHE).alias("cache"))).collect()
    assert {(r.location_id, r.name) for r in rows} == {(3, "n3"), (10**12, "n1000000000000"), (None, "x")}


def test_first_sensor_of_a_parameter(spark):
    def sensors(*params):
        return [{"sensors": [{"id": 1000 + i, "parameter": {"id": p, "name": "p"}} for i, p in enumerate(params)]}]

    d = details(spark, {1: sensors(9, 2, 2), 2: sensors(9), 3: sensors(), 4: [], 5: sensors(2)})
    got = {r.location_id: r.sensor_id for r in D.resolve_sensor(d, 2).collect()}
    assert got == {1: 1001, 2: None, 3: None, 4: None, 5: 1000}


def test_coverage_counts_stations_with_a_city(spark):
    readings = spark.createDataFrame([(i % 12 if i % 11 else None,) for i in range(120)], "location_id long")
    r = D.coverage(D.enrich(readings, stations(spark, range(8)))).first()
    # of the stations 0 to 7 those divisible by 4 have no city
    assert (r.distinct_locations, r.resolved_locations, r.coverage) == (12, 6, 0.5)


def test_small_dimension_is_broadcast_by_size(spark, tmp_path):
    readings = spark.range(1000).select((F.col("id") % 10).alias("location_id"))
    stations(spark, range(10)).write.parquet(str(tmp_path / "dim"))
    d = spark.read.parquet(str(tmp_path / "dim"))  # file size gives the estimate
    assert "BroadcastHashJoin" in plan_text(D.enrich(readings, d))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan_text(D.enrich(readings, d))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_committed_versions_are_read_and_few_are_kept(spark, tmp_path):
    root = str(tmp_path / "dim")
    assert read_dimension(spark, root).count() == 0
    write_dimension(stations(spark, range(3)), root)
    last = write_dimension(stations(spark, range(5)), root)
    half = os.path.join(root, "v=99999999999999999999half")
    os.makedirs(half)
    files = [f for f in os.listdir(last) if f.endswith(".parquet")]
    with open(os.path.join(last, files[0]), "rb") as src, open(os.path.join(half, files[0]), "wb") as dst:
        dst.write(src.read())
    assert read_dimension(spark, root).count() == 5
    for n in range(KEEP_VERSIONS + 2):
        write_dimension(stations(spark, range(n + 1)), root)
    committed = [v for v in os.listdir(root) if os.path.exists(os.path.join(root, v, "_SUCCESS"))]
    assert len(committed) == KEEP_VERSIONS and read_dimension(spark, root).count() == KEEP_VERSIONS + 2
