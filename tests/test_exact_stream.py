"""The exact stream against batch runs over what has arrived."""

import random

import pytest

from airloom.operators import clean as C
from airloom.options import QualityRules
from airloom.streaming.exact import CHANGES, KeepFirst, holding, keep_first_changes, rocksdb_state

FLAT = "date string, _file string, _pos long, location_id long, location_name string, city string, country string, parameter string, value double, unit string, date_utc string"


def arrivals(seed, n):
    r = random.Random(seed)
    made = []
    for i in range(n):
        day = r.choice(["2025-03-02", "2025-03-03"])
        station = r.choice([21, 22, None])
        utc = r.choice([f"{day}T0{r.randrange(3)}:00:00Z", "never", None])
        made.append((day, f"run_{r.randrange(5)}", 1000 * seed + i, station, "n", "Bergen", "NO", "pm25", r.choice([-1.0, 4.5, 700.0, float(i)]), "u", utc))
    return made


def table(df):
    return sorted(tuple(map(str, r)) for r in df.collect())


def test_what_holds_is_the_batch_result_after_every_batch(spark, tmp_path):
    src, out, ck = (str(tmp_path / n) for n in ("in", "out", "ck"))
    seen = []
    for seed in (3, 1, 2):
        seen += arrivals(seed, 40)
        spark.createDataFrame(arrivals(seed, 40), FLAT).coalesce(1).write.mode("append").parquet(src)
        with rocksdb_state(spark):
            q = (
                keep_first_changes(spark.readStream.schema(FLAT).parquet(src)).writeStream.format("parquet")
                .option("path", out).option("checkpointLocation", ck).trigger(availableNow=True).start()
            )
            q.awaitTermination()
        changes = spark.read.schema(CHANGES).parquet(out)
        full = C.clean_readings(spark.createDataFrame(seen, FLAT))
        assert table(holding(changes)) == table(full.select(*holding(changes).columns))
    assert changes.where("op = -1").count() > 0


class Handle:
    """A stand-in for the state handle of one key."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def listTimers(self):
        return iter(self.timers)

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def getCurrentProcessingTimeInMs(self):
        return 500


def test_retraction_timer_and_forgetting():
    handle, copies = Handle(), KeepFirst(forget_after_ms=100)
    copies.init(handle)
    row = lambda file, pos, value: dict(zip(CHANGES.names[1:], ("d", 1, "n", "c", "k", "p", value, "u", "t", False, file, pos)))
    ops = lambda *rows: [(r[0], r[7]) for r in copies.handleInputRows(None, iter(rows), handle)]
    assert ops(row("b", 2, 2.0), row("b", 1, 1.0)) == [(1, 1.0)]
    assert ops(row("b", 3, 3.0)) == [] and handle.timers == [600]
    assert ops(row("a", 9, 9.0), row(None, 5, 5.0)) == [(-1, 1.0), (1, 5.0)]
    assert list(copies.handleExpiredTimer(None, handle, None)) == [] and not handle.exists()
    assert ops(row("z", 1, 8.0)) == [(1, 8.0)]


def test_global_scope_is_refused(spark):
    with pytest.raises(ValueError):
        keep_first_changes(spark.createDataFrame([], FLAT), QualityRules(dedup_scope="global"))


class Counting(Handle):
    """Counts the trips to the state store."""

    def __init__(self):
        super().__init__()
        self.trips = 0

    def exists(self):
        self.trips += 1
        return super().exists()

    def get(self):
        self.trips += 1
        return super().get()

    def update(self, value):
        self.trips += 1
        super().update(value)


def test_a_bucket_of_keys_costs_the_trips_of_one():
    handle, copies = Counting(), KeepFirst()
    copies.init(handle)
    row = lambda station, pos: dict(zip(CHANGES.names[1:], ("d", station, "n", "c", "k", "p", 1.0, "u", "t", False, "f", pos)))
    ops = lambda *rows: [(r[0], r[2], r[-1]) for r in copies.handleInputRows(None, iter(rows), handle)]
    assert len(ops(*(row(i, 5) for i in range(500)))) == 500 and handle.trips == 2
    assert ops(row(7, 6), row(None, 6), row(3, 4), row(3, 2), row(None, 9)) == [(1, None, 6), (-1, 3, 5), (1, 3, 2)]
    assert handle.trips == 5 and len(handle.value[0]) == 501


def test_keys_of_a_bucket_are_forgotten_one_by_one():
    class Clock(Handle):
        now = 0

        def getCurrentProcessingTimeInMs(self):
            return self.now

    handle, copies = Clock(), KeepFirst(forget_after_ms=100)
    copies.init(handle)
    row = lambda station, pos: dict(zip(CHANGES.names[1:], ("d", station, "n", "c", "k", "p", 1.0, "u", "t", False, "f", pos)))
    ops = lambda *rows: [(r[0], r[2], r[-1]) for r in copies.handleInputRows(None, iter(rows), handle)]
    assert ops(row(1, 5), row(2, 5)) == [(1, 1, 5), (1, 2, 5)]
    handle.now = 60
    assert ops(row(2, 9)) == [] and handle.timers == [100]  # a later copy keeps its key longer
    handle.now = 110
    assert list(copies.handleExpiredTimer(None, handle, None)) == [] and handle.timers == [160]
    assert ops(row(1, 7), row(2, 4)) == [(1, 1, 7), (-1, 2, 5), (1, 2, 4)]
