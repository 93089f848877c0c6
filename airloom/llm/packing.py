"""Packing of token ids into sequences of bounded length, online in bounded space.

Each partition keeps a fixed number of open windows. A piece goes to the
window where it leaves least room; when none has room for it, the fullest is
emitted and a new one opened. What is still open at the end of a partition
is merged afterwards, best fit first, in groups of a bounded number of
windows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import blocks, save, small_batches
from airloom.llm.tokens import default_vocabulary, encoder, parts

OPEN_WINDOWS = 256
MERGE_WINDOWS = 8192  # leftover windows merged by one task
END_ID = 0
SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.binary()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("open", pa.bool_())]
)


class Windows:
    """The open windows of one partition; ``out`` gets the rows of emitted ones."""

    def __init__(self, capacity: int, keep: int, first_id: int):
        self.capacity, self.keep, self.next_id = capacity, keep, first_id
        self.by_room: list[tuple[int, int]] = []  # (room, window), sorted
        self.rows: dict[int, list] = {}
        self.out: list[tuple] = []

    def _emit(self, window: int, still_open: bool = False) -> None:
        at = 0
        for doc, start, ids, n, total in self.rows.pop(window):
            self.out.append((doc, start, ids, n, total, window, at, still_open))
            at += n

    def place(self, piece: tuple) -> None:
        n = piece[3]
        i = bisect_left(self.by_room, (n, -1))
        if i < len(self.by_room):
            room, window = self.by_room.pop(i)
            self.rows[window].append(piece)
        else:
            if len(self.by_room) >= self.keep:
                self._emit(self.by_room.pop(0)[1])
            room, window = self.capacity, self.next_id
            self.next_id += 1
            self.rows[window] = [piece]
        if room == n:
            self._emit(window)
        else:
            insort(self.by_room, (room - n, window))

    def close(self) -> None:
        for _, window in self.by_room:
            self._emit(window, still_open=True)

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) if self.out else [[]] * len(SCHEMA)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SCHEMA)], schema=SCHEMA)


def _merge(t: pa.Table, capacity: int) -> pa.Table:
    """Best fit, largest first: (sequence_id, into, base) for each leftover window."""
    ids, used = t.column("sequence_id").to_numpy(), t.column("used").to_numpy()
    by_room: list[tuple[int, int, int]] = []
    into, base = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
    for i in np.lexsort((ids, -used)):
        n = int(used[i])
        at = bisect_left(by_room, (n, -1, -1))
        room, target = by_room.pop(at)[::2] if at < len(by_room) else (capacity, int(ids[i]))
        into[i], base[i] = target, capacity - room
        if room > n:
            insort(by_room, (room - n, 0, target))
    return pa.table({"sequence_id": ids, "into": into, "base": base})


def pack(docs: DataFrame, capacity: int = 1024, open_windows: int = OPEN_WINDOWS, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All documents as pieces of sequences of at most ``capacity`` ids.

    A document is its text's ids and then id 0. Longer ones are cut into
    pieces of ``capacity`` and a rest. Returns per piece: doc_id, start
    (ids of the document before it), ids (little-endian 32-bit), length,
    doc_tokens, sequence_id and offset (its place in the sequence; the
    pieces of a sequence lie there without gaps).

    A null or empty text is the id 0 alone. Null doc_ids and repeated rows
    are packed like any others; other columns are left out. An empty table
    gives an empty result. sequence_id is unique, not gapless.
    """
    small_batches(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        windows = Windows(capacity, open_windows, TaskContext.get().partitionId() << 32)
        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for first, texts in parts(b.column(1)):
                for i, text in enumerate(texts):
                    own = np.append(encode.ids(text), np.uint32(END_ID)).astype("<u4")
                    for start in range(0, len(own), capacity):
                        piece = own[start : start + capacity]
                        windows.place((doc_ids[first + i], start, piece.tobytes(), len(piece), len(own)))
                yield windows.batch()
        windows.close()
        yield windows.batch()

    fields = "doc_id long, start long, ids binary, length long, doc_tokens long, sequence_id long, offset long, open boolean"
    pieces = save(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(work, fields), "packed-pieces")
    left = pieces.filter("open").groupBy("sequence_id").agg(F.sum("length").alias("used"))
    groups = blocks(left.count(), MERGE_WINDOWS)
    merged = (
        left.withColumn("g", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))
        .groupBy("g")
        .applyInArrow(lambda t: _merge(t, capacity), "sequence_id long, into long, base long")
    )
    moved = (
        pieces.filter("open")
        .join(merged, "sequence_id")
        .withColumns({"sequence_id": F.col("into"), "offset": F.col("offset") + F.col("base")})
        .select(pieces.columns)
    )
    return pieces.filter("NOT open").unionByName(moved).drop("open")
