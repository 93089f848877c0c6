"""Codes of vectors by product quantisation, its codebooks trained by ball k-means.

A vector is cut into equal parts; each part position has its own codebook.
The parts of an entry form a ball around it. A part can only be nearer to
another entry if that one's distance from its own entry is at most twice its
own, so: entries beyond twice the ball's radius are no neighbours of the
ball, parts nearer than half the way to the nearest neighbour (the stable
core) keep their entry without a comparison, and the others lie in annular
rings, each of which adds one neighbour to the exact candidates. Where an
entry and a neighbour have both stayed as they were, the comparison of the
last round holds. All is integer arithmetic, ties included.

A round is one pass over the written parts: each task assigns its parts and
writes them with their old and new entry; the entries' sums change by the
parts that moved, added up by Spark. Only the codebooks, whose size depends
on no table, pass through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import save

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
LARGEST = 1 << 22  # of an integer component, so that squared distances are exact
ROWS_AT_ONCE = 1 << 15
FAR = np.iinfo(np.int64).max


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, vector): integer components floor(scale * x) of vectors without null or
    non-finite components."""
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * scale).cast("long"))
    kept = vectors.filter(x.isNotNull() & ~bad)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), whole.alias("vector"))


@dataclass
class Book:
    """One position's codebook, and which entries the last update has moved."""

    entries: np.ndarray
    moved: np.ndarray

    def neighbours(self) -> tuple[np.ndarray, np.ndarray]:
        """For each entry, the others by squared distance, with these distances; pairs of
        which none has moved are left out (they are FAR)."""
        n = len(self.entries)
        apart = np.zeros((n, n), np.int64)
        for d in range(self.entries.shape[1]):
            apart += (self.entries[:, None, d] - self.entries[None, :, d]) ** 2
        apart[~(self.moved[:, None] | self.moved[None, :])] = FAR
        np.fill_diagonal(apart, FAR)
        order = np.argsort(apart, axis=1, kind="stable")
        return order, np.take_along_axis(apart, order, axis=1)


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((x - entries) ** 2).sum(axis=1)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first assignment, when there are no balls yet: (entry, squared distance)."""
    best, entry = np.full(len(x), FAR), np.zeros(len(x), np.int64)
    for j, e in enumerate(entries):
        d = squared(x, e)
        nearer = d < best
        best[nearer], entry[nearer] = d[nearer], j
    return entry, best


def reassign(x: np.ndarray, entry: np.ndarray, book: Book, neighbours: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The next assignment from the last one: (entry, squared distance)."""
    order, apart = neighbours
    best = squared(x, book.entries[entry])
    # The balls of these parts: an entry's radius is that of its farthest part.
    radius = np.full(len(book.entries), -1, np.int64)
    np.maximum.at(radius, entry, best)
    near = (apart <= 4 * radius[:, None]).sum(axis=1)  # neighbours of each ball
    # A part's ring: so many neighbours are at most twice as far from its entry as it is.
    ring = np.zeros(len(x), np.int64)
    by_entry = np.argsort(entry, kind="stable")
    cut = np.searchsorted(entry[by_entry], np.arange(len(book.entries) + 1))
    for e in np.flatnonzero(near):
        own = by_entry[cut[e] : cut[e + 1]]
        ring[own] = np.searchsorted(apart[e, : near[e]], 4 * best[own], side="right")
    outer = np.argsort(-ring, kind="stable")
    home, entry = entry, entry.copy()
    sizes = ring[outer]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        rows = outer[: np.searchsorted(-sizes, -k, side="left")]  # those whose ring is beyond k
        other = order[home[rows], k]
        d = squared(x[rows], book.entries[other])
        better = (d < best[rows]) | ((d == best[rows]) & (other < entry[rows]))
        rows, other, d = rows[better], other[better], d[better]
        entry[rows], best[rows] = other, d
    return entry, best


class Codebooks:
    """Codebooks of all part positions with the sums and counts of their parts."""

    def __init__(self, starts: np.ndarray):
        """``starts``: (entries, parts, width) integers."""
        self.books = [Book(starts[:, p].copy(), np.ones(len(starts), bool)) for p in range(starts.shape[1])]
        self.sums = np.zeros((starts.shape[1], len(starts), starts.shape[2]), np.int64)
        self.counts = np.zeros((starts.shape[1], len(starts)), np.int64)

    def update(self, changes: pa.Table) -> None:
        """Add the changes (part, entry, n, s0, s1, ...) and move the entries to the new means."""
        part, entry = (changes.column(c).to_numpy() for c in ("part", "entry"))
        self.counts[part, entry] += changes.column("n").to_numpy()
        for d in range(self.sums.shape[2]):
            self.sums[part, entry, d] += changes.column(f"s{d}").to_numpy()
        for p, book in enumerate(self.books):
            used = self.counts[p] > 0
            now = book.entries.copy()
            now[used] = self.sums[p][used] // self.counts[p][used, None]
            book.moved = (now != book.entries).any(axis=1)
            book.entries = now

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for v in b.entries.ravel()).encode()).hexdigest()


def _assigned(rows: DataFrame, books: Codebooks, first: bool) -> DataFrame:
    """Rows with the entries of this round (``now``, one per part), those of the last (``was``),
    and the squared distances' sum."""
    sent = rows.sparkSession.sparkContext.broadcast(books.books)
    names = rows.columns

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = sent.value
        neighbours = None if first else [b.neighbours() for b in books]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                b = whole.slice(at, ROWS_AT_ONCE)
                n = b.num_rows
                x = b.column(names.index("vector")).flatten().to_numpy().reshape(n, len(books), -1)
                was = np.zeros((n, len(books)), np.int64) if first else b.column(names.index("now")).flatten().to_numpy().reshape(n, -1).astype(np.int64)
                now, error = np.empty_like(was), np.zeros(n, np.int64)
                for p, book in enumerate(books):
                    own = np.ascontiguousarray(x[:, p])
                    now[:, p], d = nearest(own, book.entries) if first else reassign(own, was[:, p], book, neighbours[p])
                    error += d
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * len(books)), pa.array(c.ravel().astype(np.int32))) for c in (was - first, now)]
                yield pa.RecordBatch.from_arrays([b.column(names.index(c)) for c in ("vec_id", "label", "vector")] + [*lists, pa.array(error)], names=["vec_id", "label", "vector", "was", "now", "error"])

    label = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(assign, f"vec_id long, label {label}, vector array<long>, was array<int>, now array<int>, error long")


def _changes(rows: DataFrame, parts: int, width: int) -> pa.Table:
    """What the parts that moved add to, and take from, counts and sums; one row per part
    position and entry."""
    fields = ", ".join(["part int", "entry int", "n long", *(f"s{d} long" for d in range(width))])
    names = [f.split()[0] for f in fields.split(", ")]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(0).flatten().to_numpy().reshape(b.num_rows, parts, width)
            was, now = (b.column(c).flatten().to_numpy().reshape(b.num_rows, parts).astype(np.int64) for c in (1, 2))
            for p in range(parts):
                moved = was[:, p] != now[:, p]
                to, old = now[moved, p], was[moved, p]
                change = np.zeros((int(max(to.max(initial=-1), old.max(initial=-1))) + 1, width + 1), np.int64)
                values = np.concatenate((np.ones((len(to), 1), np.int64), x[moved, p]), axis=1)
                np.add.at(change, to, values)
                np.subtract.at(change, old[old >= 0], values[old >= 0])
                entry = np.unique(np.concatenate((to, old[old >= 0])))
                columns = [np.full(len(entry), p, np.int32), entry.astype(np.int32), *change[entry].T]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names=names)

    moved = rows.filter(F.col("was") != F.col("now")).select("vector", "was", "now")
    sums = [F.sum(c).alias(c) for c in names[2:]]
    return moved.mapInArrow(add, fields).groupBy("part", "entry").agg(*sums).toArrow()


def _starts(rows: DataFrame, parts: int, entries: int) -> np.ndarray | None:
    """The first codebooks, from the vectors of the least ids; None without rows."""
    size = F.size("vector")
    fewest, most, largest = rows.agg(F.min(size), F.max(size), F.max(F.array_max(F.transform("vector", F.abs)))).first()
    if most is None:
        return None
    if fewest != most or most % parts:
        raise ValueError(f"vectors of one length, a multiple of {parts}, are needed; found {fewest} to {most} components")
    if (largest or 0) > LARGEST:
        raise ValueError(f"integer components up to {LARGEST} are exact; found {largest}")
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "vector").select("vector").limit(entries).toArrow()
    chosen = first.column("vector").combine_chunks()
    return chosen.flatten().to_numpy().reshape(first.num_rows, parts, most // parts)


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Codebooks | None]:
    """Codes of all vectors and the final codebooks.

    Returns (vec_id, label, now, error) of every vector without null or
    non-finite components: ``now`` has the entry of each part, ``error`` is
    the sum of the squared distances. Codebooks start as the parts of the
    ``entries`` vectors of least id (fewer, if there are fewer; null ids
    last, ties by components). Ties of distance go to the lower entry; an
    entry without parts stays. Ids may be null or repeated, other columns
    are not read. Vectors of unlike length, or with integer components
    beyond LARGEST, are an error. An empty table has no codebooks.
    """
    rows = save(kept_vectors(vectors, id_col, vector_col, label_col, scale), "vectors")
    starts = _starts(rows, parts, entries)
    if starts is None:
        none = F.lit(None)
        return rows.select("vec_id", "label", none.cast("array<int>").alias("now"), none.cast("long").alias("error")), None
    books = Codebooks(starts)
    for n in range(rounds):
        rows = save(_assigned(rows, books, n == 0), "assigned")
        books.update(_changes(rows, parts, starts.shape[2]))
    rows = save(_assigned(rows, books, rounds == 0), "assigned")
    return rows.select("vec_id", "label", "now", "error"), books


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error: the error summed over equal labels, nulls together.

    Sums are combined before the shuffle and joined back, where Spark may
    split a label that many vectors have.
    """
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of"))).drop("of")


def code_text(now: Column) -> Column:
    """Entries in part order, two lowercase hex digits each."""
    return F.array_join(F.transform(now, lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")


def decoded(coded: DataFrame, books: Codebooks) -> DataFrame:
    """Adds ``vector``: the integer vector that each code stands for."""
    at = coded.columns.index("now")
    entries = [b.entries for b in books.books]  # of fixed size

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            now = b.column(at).flatten().to_numpy().reshape(b.num_rows, len(entries))
            x = np.concatenate([e[now[:, p]] for p, e in enumerate(entries)], axis=1)
            ends = pa.array(np.arange(b.num_rows + 1, dtype=np.int32) * x.shape[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(x.ravel()))], names=[*b.schema.names, "vector"])

    return coded.mapInArrow(look_up, coded.withColumn("vector", F.lit(None).cast("array<long>")).schema)
