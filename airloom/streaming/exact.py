"""Exact keep-first in a stream: the kept copy is the first in landing order.

A stream that drops duplicates keeps whichever copy arrives first. Here each
dedup key has a state, the copy that comes first in landing order (file,
position) among those seen. When a copy arrives that comes before it, the
stream takes the old one back and gives the new one: rows of the output have
``op`` 1 (holds) or -1 (no longer holds). The rows that hold after any
micro-batch are those of a full run over what has arrived (``holding``).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from airloom.operators import clean as C
from airloom.options import QualityRules
from airloom.schema import CURATED, CURATED_COLUMNS

# date, the flat reading with its raw time, and its landing position.
KEPT = T.StructType(
    [
        T.StructField("date", T.StringType()),
        *(T.StructField("date_utc", T.StringType()) if f.name == "date_utc" else f for f in CURATED.fields),
        T.StructField("_file", T.StringType()),
        T.StructField("_pos", T.LongType()),
    ]
)
# What is held of a key: its first copy, the time that tells keys apart, the time of its last copy.
FIRSTS = T.StructType(
    [
        T.StructField(
            "firsts",
            T.ArrayType(
                T.StructType([*KEPT.fields, T.StructField("_time", T.StringType()), T.StructField("_seen", T.LongType())])
            ),
        )
    ]
)
_STATION, _PARAMETER = KEPT.names.index("location_id"), KEPT.names.index("parameter")
BUCKETS = 1024  # of the keys of a landing date
CHANGES = T.StructType([T.StructField("op", T.IntegerType()), *KEPT.fields])
_CHANGE = Row(*CHANGES.names)
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _place(row: tuple) -> tuple:
    """Landing order; a null file or position comes first, as in the batch run."""
    file, pos = row[-2:]
    return (file is not None, file or "", pos is not None, pos or 0)


class KeepFirst(StatefulProcessor):
    """The copies of a bucket of keys: state is the first copy of each.

    A bucket's state is read and written once for all of its keys. A key is
    the station, parameter and time (``time_col``) of a row; with
    ``forget_after_ms`` it is dropped that long after its last copy, by one
    timer for the bucket's earliest such moment.
    """

    def __init__(self, forget_after_ms: int | None = None, time_col: str = "date_utc"):
        self.forget_after_ms = forget_after_ms
        self.time_col = time_col

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", FIRSTS)

    def _held(self) -> dict[tuple, tuple]:
        """Key -> (first copy, time of the last copy)."""
        if not self.first.exists():
            return {}
        return {
            (e[_STATION], e[_PARAMETER], e[-2]): (tuple(e[: len(KEPT)]), e[-1]) for e in self.first.get()[0]
        }

    def _store(self, held: dict[tuple, tuple]) -> None:
        if held:
            self.first.update(([(*copy, key[-1], seen) for key, (copy, seen) in held.items()],))
        else:
            self.first.clear()
        if self.forget_after_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if held:
                self.handle.registerTimer(min(seen for _, seen in held.values()) + self.forget_after_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = self._held()
        best: dict[tuple, tuple] = {}
        for row in rows:
            copy = tuple(row[c] for c in KEPT.names)
            at = (copy[_STATION], copy[_PARAMETER], row[self.time_col])
            old = best.get(at) or (held[at][0] if at in held else None)
            best[at] = copy if old is None or _place(copy) < _place(old) else old
        now = None if self.forget_after_ms is None else timerValues.getCurrentProcessingTimeInMs()
        changed = [(held[at][0] if at in held else None, copy) for at, copy in best.items()]
        changed = [(old, copy) for old, copy in changed if copy is not old]
        if changed or now is not None:
            self._store(held | {at: (copy, now) for at, copy in best.items()})
        for old, copy in changed:
            if old is not None:
                yield _CHANGE(-1, *old)
            yield _CHANGE(1, *copy)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self._held()
        if held:
            # The timer is that of the earliest; others may be due by now.
            due = max(min(seen for _, seen in held.values()), timerValues.getCurrentProcessingTimeInMs() - self.forget_after_ms)
            self._store({at: (copy, seen) for at, (copy, seen) in held.items() if seen > due})
        return iter([])

    def close(self) -> None:
        pass


def keep_first_changes(
    flat_stream: DataFrame,
    rules: QualityRules = QualityRules(),
    forget_after_ms: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Changes (``CHANGES``) of the kept readings of a stream of flat readings.

    The stream has the flat columns with ``date``, ``_file`` and ``_pos``;
    invalid readings are dropped first. State is one row per dedup key. It
    is kept for ever, or until no copy of the key has come for
    ``forget_after_ms``: a copy after that counts as a new key. The keys of
    a date are dealt over ``buckets``, whose state is read and written
    whole; a checkpoint keeps the number it began with. Needs the RocksDB
    state store (``rocksdb_state``).
    """
    if rules.dedup_scope == "global":
        raise ValueError("keep-first in a stream is per landing date")
    time = C._dedup_keys(rules)[-1]  # after the station and the parameter
    time = F.col(time) if isinstance(time, str) else time
    valid = C.flag_outliers(C.drop_invalid(flat_stream, rules), rules).select(
        *KEPT.names, time.cast("string").alias("_time")
    )
    bucket = F.pmod(F.xxhash64("location_id", "parameter", "_time"), F.lit(buckets)).cast("int")
    return valid.withColumn("_bucket", bucket).groupBy("date", "_bucket").transformWithState(
        statefulProcessor=KeepFirst(forget_after_ms, "_time"),
        outputStructType=CHANGES,
        outputMode="Append",
        timeMode="None" if forget_after_ms is None else "ProcessingTime",
    )


@contextmanager
def rocksdb_state(spark: SparkSession):
    """The session with the RocksDB state store, for starting a query; then as it was."""
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield spark
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def holding(changes: DataFrame) -> DataFrame:
    """Curated rows (with ``date``) that hold after all ``changes``.

    A row that was given and taken back adds up to nothing; sums are
    combined before the shuffle.
    """
    rows = changes.groupBy(*KEPT.names).agg(F.sum("op").alias("op")).where("op > 0")
    return C.parse_dates(rows).select(*CURATED_COLUMNS, "date")
