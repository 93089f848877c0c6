"""Exact substring dedup with an FM-index per shard.

A window is 13 consecutive words. Each window is named by its minimizer, the
8 words in it with the least hash: equal windows have equal minimizers, so
windows can be compared shard by shard. Minimizers that occur in one
document only are dropped first. Around the others, the runs of windows with
one minimizer ("segments") go to the shard of that minimizer. A shard builds
an FM-index of its different segments and streams them through it: backward
search over the wavelet matrix of the Burrows-Wheeler transform gives, for
each place, whether the match there reaches 13 words, and the interval of
its occurrences, whose least document is the one that keeps the words.

What travels is packed: one row holds all that a few thousand documents have
for one bucket of minimizers or one shard. The numbers of buckets and shards
follow the bytes of text, so their sizes do not grow with the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airloom.llm.common import id_filter, partitions, runs, save, small_batches, text_bytes
from airloom.llm.fm_index import FMIndex

WINDOW = 13
SEED_WORDS = 8
SEED_BYTES = 6  # of a minimizer's hash, where minimizers of documents are compared
SYMBOL_BYTES = 5  # of a word's hash, where the words of segments are compared
BUCKET_BYTES = 32 << 20  # of text, for each bucket of minimizers
SHARD_BYTES = 4 << 20  # of text, for each shard of segments
SEGMENTS_KNOWN = 200_000  # segments that a task remembers; more only means that it sends some again
BYTES_AT_ONCE = 1 << 20
P = np.uint64(0x9E3779B97F4A7C15)
Q = np.uint64(0xD6E8FEB86659FD93)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def low_bytes(h: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(h.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def from_low_bytes(data: bytes, n: int) -> np.ndarray:
    wide = np.zeros((len(data) // n, 8), np.uint8)
    wide[:, :n] = np.frombuffer(data, np.uint8).reshape(-1, n)
    return wide.view("<u8").ravel()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * Q
    h = (h ^ (h >> np.uint64(29))) * Q
    return h ^ (h >> np.uint64(32))


class _Powers:
    """Powers of P and of its inverse modulo 2**64, as long as any text needed so far."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(P), -1, 2**64))
            self.up = np.concatenate(([np.uint64(1)], np.multiply.accumulate(np.full(n, P))))
            self.down = np.concatenate(([np.uint64(1)], np.multiply.accumulate(np.full(n, inverse))))
        return self.up, self.down


_POWERS = _Powers()


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts, and the bounds of each text's words."""
    joined = b" ".join(texts) + b" "
    b = np.frombuffer(joined, np.uint8)
    blank = _BLANK[b]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    start, end = edge[0::2], edge[1::2]
    up, down = _POWERS.of(len(b) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)], dtype=np.uint64)))
    h = mixed((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * Q)
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    return h, np.searchsorted(start, begins)


def minimizers(h: np.ndarray, bounds: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window start, its text, place of its minimizer, the minimizer) for every window."""
    n = len(h) - window + 1
    if n <= 0:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64))
    m = min(SEED_WORDS, window)
    grams = np.zeros(len(h) - m + 1, np.uint64)
    for i in range(m):
        grams = grams * P + h[i : i + len(grams)]
    grams = mixed(grams)
    at, reach, span = np.arange(len(grams)), 1, window - m + 1
    while reach < span:  # leftmost least gram of a growing span
        step = min(reach, span - reach)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(grams[left] <= grams[right], left, right)
        reach += step
    size = np.diff(bounds)
    text = np.repeat(np.arange(len(size)), size)
    start = np.arange(n)
    start = start[start + window <= bounds[text[:n] + 1]]
    return start, text[start], at[start], grams[at[start]]


def _parts(batches: Iterator[pa.RecordBatch], text_column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts, of bounded bytes."""
    for b in batches:
        texts = text_bytes(b.column(text_column))
        first, size = 0, 0
        for i, t in enumerate(texts):
            size += len(t)
            if size >= BYTES_AT_ONCE or i == len(texts) - 1:
                yield b.slice(first, i + 1 - first), texts[first : i + 1]
                first, size = i + 1, 0


def _bucket_rows(bucket: np.ndarray, order_by: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, its rows), rows in the given order: neighbouring documents compress well."""
    order = np.lexsort((order_by, bucket))
    cut = runs(bucket[order])
    for x, y in zip(cut[:-1], cut[1:]):
        yield int(bucket[order[x]]), order[x:y]


def _shared_seeds(docs: DataFrame, window: int, buckets: int) -> DataFrame:
    """(doc_id, seed): the minimizers of each document that occur in another one, too.

    ``seed`` is the low half of the hash, which is enough to find it again
    in its document. A task holds one bucket of minimizers. Of the documents
    of a batch that share a seed only the outer two stand in its bucket, so a
    passage in very many documents is a few rows of each batch there; the
    documents between them are known to share it and pass by any bucket.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["bucket", "known", "seeds", "docs"]
        for b, texts in _parts(batches, 1):
            h, bounds = words_of(texts)
            _, text, _, seed = minimizers(h, bounds, window)
            ids = b.column(0).to_numpy()
            pair = pd.DataFrame({"seed": seed, "doc": ids[text]}).drop_duplicates().sort_values(["seed", "doc"])
            seed, doc = pair["seed"].to_numpy(), pair["doc"].to_numpy()
            if not len(seed):
                continue
            bound = runs(seed)
            known = np.ones(len(seed), bool)
            known[bound[:-1]] = known[bound[1:] - 1] = False  # the outer two
            bucket = np.where(known, mixed(doc.astype(np.uint64)), seed >> np.uint64(40))
            bucket = (bucket % np.uint64(buckets)).astype(np.int64)
            rows = []
            for is_known in (False, True):
                chosen = np.flatnonzero(known == is_known)
                for k, at in _bucket_rows(bucket[chosen], doc[chosen]):
                    at = chosen[at]
                    rows.append((k, is_known, low_bytes(seed[at], SEED_BYTES), doc[at].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    def shared(t: pa.Table) -> pa.Table:
        columns = [t.column(c).to_pylist() for c in ("known", "seeds", "docs")]

        def joined(known: bool) -> tuple[np.ndarray, np.ndarray]:
            own = [(from_low_bytes(x, SEED_BYTES), np.frombuffer(y, np.int64)) for k, x, y in zip(*columns) if k == known]
            s = np.concatenate([np.zeros(0, np.uint64), *(x for x, _ in own)])
            return s, np.concatenate([np.zeros(0, np.int64), *(y for _, y in own)])

        s, d = joined(False)
        order = np.argsort(s, kind="stable")
        s, d = s[order], d[order]
        bound = runs(s)
        if len(s):
            differ = np.minimum.reduceat(d, bound[:-1]) < np.maximum.reduceat(d, bound[:-1])
            found = np.repeat(differ, np.diff(bound))
            s, d = s[found], d[found]
        known = joined(True)
        s, d = np.concatenate([s, known[0]]), np.concatenate([d, known[1]])
        return pa.table({"doc_id": d, "seed": s.astype(np.uint32).view(np.int32)})

    return (
        docs.select("doc_id", "text")
        .mapInArrow(deal, "bucket long, known boolean, seeds binary, docs binary")
        .groupBy("bucket")
        .applyInArrow(shared, "doc_id long, seed int")
    )


def _wanted(b: pa.RecordBatch, column: str, text: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Windows whose minimizer is in its document's list."""
    lists = b.column(b.schema.get_field_index(column))
    at, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    first = np.searchsorted(text, np.arange(b.num_rows + 1))
    low = seed.astype(np.uint32).view(np.int32)
    out = np.zeros(len(text), bool)
    for i in range(b.num_rows):
        own = slice(first[i], first[i + 1])
        out[own] = np.isin(low[own], values[at[i] : at[i + 1]])
    return out


def _to_shards(found: DataFrame, window: int, shards: int) -> DataFrame:
    """(shard, done, symbols, lengths, docs, texts, starts): the segments, packed by shard.

    Equal segments of one task: the shard gets those of the least documents,
    one after another. A later document's segment is all repeats of words
    that an earlier one has, so it needs no comparison (``done``) and passes
    by any shard: a passage in very many documents is a few rows of each task
    in its shard.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[bytes, int] = {}
        names = ["shard", "done", "symbols", "lengths", "docs", "texts", "starts"]
        for b, texts in _parts(batches, 2):
            h, bounds = words_of(texts)
            start, text, _, seed = minimizers(h, bounds, window)
            keep = _wanted(b, "seeds", text, seed)
            start, text, seed = start[keep], text[keep], seed[keep]
            if not len(start):
                continue
            # A segment: neighbouring windows of one text with the same minimizer.
            new = np.ones(len(start), bool)
            new[1:] = (np.diff(start) != 1) | (seed[1:] != seed[:-1]) | (text[1:] != text[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin[1:], len(start)) - 1
            first_word, owner = start[begin], text[begin]
            size = start[last] + window - first_word
            packed = low_bytes(h, SYMBOL_BYTES)
            symbols = np.frombuffer(packed, np.uint8).reshape(-1, SYMBOL_BYTES)
            docs, hashes = b.column(0).to_numpy(), b.column(1).to_numpy()
            shard = ((seed[begin] >> np.uint64(24)) % np.uint64(shards)).astype(np.int64)
            done = np.zeros(len(begin), bool)
            if len(least) > SEGMENTS_KNOWN:
                least = {}
            in_order = np.argsort(docs[owner], kind="stable")
            for i, x, n, d in zip(in_order.tolist(), first_word[in_order].tolist(), size[in_order].tolist(), docs[owner][in_order].tolist()):
                key = packed[x * SYMBOL_BYTES : (x + n) * SYMBOL_BYTES]
                if least.setdefault(key, d) < d:
                    done[i] = True
                else:
                    least[key] = d
            shard[done] = owner[done] % shards
            rows = []
            for is_done in (False, True):
                chosen = np.flatnonzero(done == is_done)
                for k, at in _bucket_rows(shard[chosen], owner[chosen]):
                    at = chosen[at]
                    words = np.zeros(0, np.int64) if is_done else np.repeat(first_word[at] - np.cumsum(size[at]) + size[at], size[at]) + np.arange(size[at].sum())
                    rows.append(
                        (k, is_done, symbols[words].tobytes(), size[at].astype(np.int32).tobytes(), docs[owner[at]].tobytes(), hashes[owner[at]].tobytes(), (first_word[at] - bounds[owner[at]]).astype(np.int32).tobytes())
                    )
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)

    fields = "shard long, done boolean, symbols binary, lengths binary, docs binary, texts binary, starts binary"
    return found.select("doc_id", "text_id", "text", "seeds").mapInArrow(cut, fields)


def shard_minima(symbols: np.ndarray, count: np.ndarray, first_doc: np.ndarray, window: int) -> np.ndarray:
    """For every window of the segments (``count`` symbols each), one after another, the
    least document that has it, by an FM-index of all segments."""
    owner = np.repeat(np.arange(len(count)), count)
    text = np.zeros(len(symbols) + len(count), np.int64)  # a separator after each segment
    text[np.arange(len(symbols)) + owner] = np.unique(symbols, return_inverse=True)[1] + 1
    begin = np.cumsum(count + 1) - (count + 1)
    index = FMIndex(text, window)
    windows = count - window + 1
    of = np.repeat(np.arange(len(count)), windows)
    starts = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows) + begin[of]
    lo, hi = index.search(starts, window)
    least = first_doc[of].copy()
    many = np.flatnonzero(hi - lo > 1)
    if len(many):
        doc_of = np.repeat(first_doc, count + 1)[index.suffixes]
        left, inverse = np.unique(lo[many], return_inverse=True)
        right = np.zeros(len(left), np.int64)
        right[inverse] = hi[many]
        cuts = np.column_stack((left, right)).ravel()
        minima = np.minimum.reduceat(np.append(doc_of, np.iinfo(np.int64).max), cuts)[::2]
        least[many] = minima[inverse]
    return least


def _columns(t: pa.Table) -> list[np.ndarray]:
    """Length, document, text and start of every segment of the rows."""
    kinds = (("lengths", np.int32), ("docs", np.int64), ("texts", np.int32), ("starts", np.int32))
    return [np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, k) for x in t.column(n).to_pylist())]) for n, k in kinds]


def _shard_intervals(t: pa.Table, window: int) -> pa.Table:
    """What the segments of one shard lose, as (doc_id, text_id, lo, hi)."""
    done = t.column("done")
    size, doc, text, start = _columns(t.filter(done))
    whole = [doc, text, start, start + size]
    found = _compared(t.filter(pc.invert(done)), window)
    doc, text, lo, hi = (np.concatenate(pair) for pair in zip(found, whole))
    return pa.table({"doc_id": doc, "text_id": text.astype(np.int32), "lo": lo.astype(np.int32), "hi": hi.astype(np.int32)})


def _compared(t: pa.Table, window: int) -> list[np.ndarray]:
    """The same for the segments that need a comparison, as arrays."""
    count, doc, text, start = _columns(t)
    if not len(count):
        return [np.zeros(0, np.int64)] * 4
    packed = b"".join(t.column("symbols").to_pylist())
    end = np.cumsum(count) * SYMBOL_BYTES
    # Equal segments stand in the index once, with their least document.
    number: dict[bytes, int] = {}
    same = np.array([number.setdefault(packed[x:y], len(number)) for x, y in zip((end - count * SYMBOL_BYTES).tolist(), end.tolist())], np.int64)
    first_doc = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(first_doc, same, doc)
    sizes = np.array([len(x) for x in number], np.int64) // SYMBOL_BYTES
    least = shard_minima(from_low_bytes(b"".join(number), SYMBOL_BYTES), sizes, first_doc, window)
    windows = sizes - window + 1
    begin = np.cumsum(windows) - windows
    n = windows[same]
    row = np.repeat(np.arange(len(same)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    later = least[begin[same[row]] + place] < doc[row]
    row, place = row[later], place[later]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(place) != 1)
    a = np.flatnonzero(new)
    z = np.append(a[1:], len(row))[: len(a)] - 1
    r = row[a]
    return [doc[r], text[r], start[r] + place[a], start[r] + place[z] + window]


def repeated_intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_id, lo, hi): word intervals whose windows start in an earlier document.

    ``docs`` has doc_id (not null), text_id (a hash of the text) and text.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    least = partitions(docs.sparkSession)
    buckets, shards = max(least, math.ceil(size / BUCKET_BYTES)), max(least, math.ceil(size / SHARD_BYTES))
    shared = _shared_seeds(docs, window, buckets)
    per_doc = save(shared.groupBy("doc_id").agg(F.collect_set("seed").alias("seeds")), "shared-seeds")
    found = docs.filter(id_filter(per_doc.select("doc_id"), F.col("doc_id"))).join(per_doc, "doc_id")
    packed = _to_shards(found, window, shards)
    return packed.groupBy("shard").applyInArrow(lambda t: _shard_intervals(t, window), "doc_id long, text_id int, lo int, hi int")


def dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, n_removed and kept (words joined by one blank) of every row.

    A word is removed if it lies in a window of ``window`` words that also
    starts in a document with a smaller doc_id; windows are judged on the
    input. Words are runs of characters other than ASCII white space, as
    they stand; a null text has none. Rows that share a doc_id never remove
    each other's words. Rows with a null doc_id keep all words and take none
    from others. Texts shorter than a window are kept. Repeated rows, other
    columns and an empty table come back as they are; columns n_words,
    n_removed and kept of the input are replaced.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("n_words", "n_removed", "kept")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.hash(F.col(text_col)).alias("text_id"), F.col(text_col).cast("string").alias("text"))
    found = repeated_intervals(rows.filter("doc_id IS NOT NULL AND text IS NOT NULL"), window)
    cuts = save(found.groupBy("doc_id", "text_id").agg(F.collect_set(F.struct("lo", "hi")).alias("_cuts")), "repeated-intervals")
    names = docs.columns
    keyed = docs.withColumns({"_id": F.col(id_col).cast("long"), "_text_id": F.hash(F.col(text_col))})
    tested = keyed.withColumn("_cut", id_filter(cuts.select("doc_id"), F.col("_id")))
    cuts = cuts.select(F.col("doc_id").alias("_id"), F.col("text_id").alias("_text_id"), "_cuts")
    some = tested.filter("_cut").join(cuts, ["_id", "_text_id"], "left").select(*names, "_cuts")
    none = tested.filter("NOT _cut").select(*names, F.lit(None).cast(cuts.schema["_cuts"].dataType).alias("_cuts"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_at = names.index(text_col)
        for b in batches:
            n, gone, kept = [], [], []
            for t, cut in zip(text_bytes(b.column(text_at)), b.column(len(names)).to_pylist()):
                words = t.split()
                n.append(len(words))
                if cut:
                    stay = np.ones(len(words), bool)
                    for x in cut:
                        stay[x["lo"] : x["hi"]] = False
                    gone.append(int((~stay).sum()))
                    words = [words[i] for i in np.flatnonzero(stay)]
                else:
                    gone.append(0)
                kept.append(b" ".join(words))
            new = [pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(names)], *new], names=[*names, "n_words", "n_removed", "kept"])

    schema = docs.withColumns({"n_words": F.lit(0).cast("long"), "n_removed": F.lit(0).cast("long"), "kept": F.lit("")}).schema
    return some.unionByName(none).mapInArrow(keep, schema)
