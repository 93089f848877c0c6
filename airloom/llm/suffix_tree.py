"""Language-model scores by a probabilistic suffix tree over words.

The tree's states are word sequences of up to ``DEPTH`` words. A sequence
becomes a state if it is frequent enough and its next-symbol distribution
diverges from that of its longest proper suffix; a state keeps the symbols
that make the difference and leaves the others to its suffix, scaled so that
all probabilities still sum to one. The root is the word distribution with
one count added to every word and to the unknown one. A text is scored token
by token in the longest state that is a suffix of the words before.

Counts cover all training tokens, and every sequence that is frequent enough
is judged, however many there are: nothing is bounded by a share of the
corpus, and neither the counts nor the tree are held in one place. Texts are
coded once in blocks. Each block sends its distinct words to buckets and gets
their totals back, in the order sent. Sequences of one more word are counted
in buckets too, where both shorter sequences in them are frequent. The states
of each length come from joins with the frequent sequences one word shorter,
and each block asks for the part of the tree that its own texts meet. What a
block sends or asks for, it does once for all its texts; it goes through them
in parts, so that only the distinct words and sequences of a block are held.
Bitmaps of fixed size save blocks from sending what cannot count; they only
let more through on larger inputs, the counts and joins behind them decide.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from airloom.llm.common import partitions, runs, save, small_batches, text_bytes
from airloom.llm.substring_dedup import P, mixed, words_of
from airloom.session import scratch_path

DEPTH = 3  # words of the longest context
MIN_CONTEXT_COUNT, MIN_SYMBOL_COUNT = 8, 4  # least evidence for a context, for a symbol after it
MIN_CONTEXT, MIN_SYMBOL = 0.0, 0.0  # a caller's least share of a context, least probability of a kept symbol
SYMBOL_NATS, STATE_NATS = 6.0, 10.0  # divergence that retains a symbol, a state
PRIOR = 5.0  # weight of the suffix's distribution in a state's own
BLOCK_TOKENS = 1 << 22
PART_TOKENS = 1 << 18  # what is gone through at once in a block
TEXT_BYTES = 1 << 18  # bytes of texts that are cut into words at once
BUCKET_ENTRIES = 2 << 20
HEAVY = 4  # the sequences of a context with over 1 / HEAVY of a bucket's share of the tokens are dealt one by one
FILTER_BITS = 27  # largest size of a bitmap of keys, whatever the input
MARKS = 3  # most bits of a key in a bitmap; one that is full has fewer
COMMON = 1 << 18  # at most so many of the most frequent words are sent by their rank, whatever the input; so are sequences
END = np.uint64(0x452821E638D01377)  # the symbol after the last word
SYMBOL = np.uint64(0x3C6EF372FE94F82B)  # tells a symbol of a state from a state of the same words

CODED = "block long, tokens long, doc_ids array<long>, held array<boolean>, lengths array<int>, vocabulary binary, counts binary, codes binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


@contextmanager
def no_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """Jobs run here leave no shuffle files behind: their results are all that is read again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, old)


def saved(df: DataFrame, name: str) -> DataFrame:
    with no_shuffle_files(df.sparkSession):
        return save(df, name)


def saved_by_block(df: DataFrame, name: str) -> DataFrame:
    """``saved`` in files by hash of ``block``, so that a join on it moves the other side only."""
    spark, table, n = df.sparkSession, f"{name}_{uuid.uuid4().hex}", partitions(df.sparkSession)
    with no_shuffle_files(spark):
        writer = df.repartition(n, "block").write.option("compression", "zstd").option("path", scratch_path(spark, name))
        writer.bucketBy(n, "block").format("parquet").saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the files stay, and ``out`` knows them
    return out


def extended(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Keys of sequences one word longer; the empty sequence has key 0."""
    return mixed(key * P + word)


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of keys, so sorted keys are ordered by bucket."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def planes(x: np.ndarray) -> bytes:
    """All first bytes, all second ones, ...: small numbers pack well in this order."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def pressed(x: np.ndarray) -> bytes:
    """Compressed ``planes``. Shuffles compress too, but find little in what is not text."""
    data = planes(x)
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def unpressed(data: bytes, kind: str) -> np.ndarray:
    return from_planes(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True), kind)


def packed(keys: np.ndarray) -> bytes:
    """Sorted keys as differences."""
    return pressed(np.diff(keys, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpressed(data, "<u8"), dtype=np.uint64)


class Common:
    """Keys that are sent often, the most frequent first, and short names for them."""

    def __init__(self, keys: np.ndarray):
        self.keys, self.order = keys, np.argsort(keys)
        self.sorted = keys[self.order]

    def ranks(self, keys: np.ndarray) -> np.ndarray:
        """Ranks of ``keys``, -1 for those that are not common."""
        at = _find(self.sorted, keys)
        return np.where(at >= 0, np.append(self.order, 0)[at], -1).astype(np.int32)

    def listed(self, keys: np.ndarray, ranks: np.ndarray) -> tuple[bytes, bytes]:
        """Others than the common ones in full, but once; and the place of each key in both lists."""
        rare = np.flatnonzero(ranks < 0)
        names, place = np.unique(keys[rare], return_inverse=True)
        ranks = ranks.astype("<i4")
        ranks[rare] = len(self.keys) + place
        return packed(names), pressed(ranks)

    def unlisted(self, names: bytes, places: bytes) -> np.ndarray:
        names, places = unpacked(names), unpressed(places, "<i4")
        rare = np.flatnonzero(places >= len(self.keys))
        out = np.append(self.keys, np.uint64(0))[np.minimum(places, len(self.keys))]
        out[rare] = names[places[rare] - len(self.keys)]
        return out


def common(sequences: DataFrame, key: str) -> Common:
    """Those with the highest counts, as far as there are no more than COMMON."""
    height = F.floor(8 * F.log2("c"))
    heights = sorted(map(tuple, sequences.groupBy(height).count().collect()), reverse=True)
    total = np.cumsum([n for _, n in heights])
    fit = int((total <= COMMON).sum())
    if not fit:
        return Common(np.zeros(0, np.uint64))
    top = sequences.filter(height >= heights[fit - 1][0]).select(key, "c").toArrow()
    keys, c = (top.column(n).to_numpy() for n in (key, "c"))
    return Common(keys[np.lexsort((keys, -c))].view(np.uint64))


def distinct(keys: np.ndarray) -> np.ndarray:
    keys = np.sort(keys)
    return keys[runs(keys)[:-1]]


def code_texts(docs: DataFrame, held_out: Column) -> DataFrame:
    """Whole texts as codes of their block's own vocabulary, one row per block of documents.

    ``docs`` has doc_id and text. A block ends with the document that fills
    it, so its size is bounded by BLOCK_TOKENS and one document.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("lengths", pa.list_(pa.int32())), ("vocabulary", pa.binary()), ("counts", pa.binary()), ("codes", pa.binary())])
        number = TaskContext.get().partitionId() << 32
        ids, held, lengths, size = [], [], [], 0
        parts = []  # (distinct words, codes) of some of the block's documents
        texts, text_size = [], 0

        def cut():
            h, bounds = words_of(texts)
            words, codes = np.unique(np.insert(h, bounds[1:], END), return_inverse=True)
            parts.append((words, codes.astype(np.int32)))
            lengths.extend((np.diff(bounds) + 1).tolist())
            return len(codes)

        def block():
            vocabulary = distinct(np.concatenate([words for words, _ in parts]))
            codes = np.concatenate([_find(vocabulary, words)[codes].astype(np.int32) for words, codes in parts])
            # Frequent words get small numbers, which pack well.
            counts = np.bincount(codes).astype("<i4")
            ranks = np.empty(len(vocabulary), "<i4")
            ranks[_by_count(counts)] = np.arange(len(vocabulary))
            row = [number, len(codes), ids, held, lengths, packed(vocabulary), pressed(counts), pressed(ranks[codes])]
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, schema)], schema=schema)

        for b in batches:
            for i, out, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2))):
                ids.append(i)
                held.append(out)
                texts.append(text.lower())
                text_size += len(text)
                # These texts have no more words than that: a block ends with the document that fills it.
                if text_size >= TEXT_BYTES or size + text_size // 2 + 2 * len(texts) >= BLOCK_TOKENS:
                    size += cut()
                    texts, text_size = [], 0
                if size >= BLOCK_TOKENS:
                    yield block()
                    number, ids, held, lengths, parts, size = number + 1, [], [], [], [], 0
        if texts:
            cut()
        if ids:
            yield block()

    return docs.select("doc_id", F.coalesce(held_out, F.lit(False)), "text").mapInArrow(code, CODED)


def _by_count(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts, kind="stable").astype(np.int32)


class Block:
    """One row of coded texts."""

    def __init__(self, row: dict):
        by_rank = _by_count(unpressed(row["counts"], "<i4"))
        self._set(unpacked(row["vocabulary"]), by_rank[unpressed(row["codes"], "<i4")], row["doc_ids"], np.array(row["held"], bool), np.array(row["lengths"], np.int64))

    def _set(self, vocabulary: np.ndarray, codes: np.ndarray, ids: list, held: np.ndarray, lengths: np.ndarray) -> None:
        self.vocabulary, self.codes, self.ids, self.held, self.lengths = vocabulary, codes, ids, held, lengths
        self.starts = np.cumsum(lengths) - lengths

    @cached_property
    def alone(self) -> np.ndarray:
        """Keys of the vocabulary's words as sequences."""
        return extended(np.zeros(len(self.vocabulary), np.uint64), self.vocabulary)

    @cached_property
    def train(self) -> np.ndarray:
        return np.repeat(~self.held, self.lengths)

    @cached_property
    def place(self) -> np.ndarray:
        return np.arange(len(self.codes)) - np.repeat(self.starts, self.lengths)

    def parts(self) -> Iterator[Block]:
        """The block's documents in runs of about PART_TOKENS, as blocks with the same vocabulary."""
        cut = [*runs(self.starts // PART_TOKENS)]
        ends = [*self.starts, len(self.codes)]
        for x, y in zip(cut[:-1], cut[1:]):
            part = Block.__new__(Block)
            part.alone = self.alone
            part._set(self.vocabulary, self.codes[ends[x] : ends[y]], self.ids[x:y], self.held[x:y], self.lengths[x:y])
            yield part

    def keys(self, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(keys, known) for depth 1, 2, ...: the key of the words before each place, and
        whether the document has so many there."""
        words = self.vocabulary[self.codes]
        for n in range(1, depth + 1):
            key = np.zeros(len(words), np.uint64)
            key[1:] = extended(before[:-1], words[:-1]) if n > 1 else self.alone[self.codes[:-1]]
            yield key, self.place >= n
            before = key

    def wanted(self, depth: int, there: Bitmap) -> tuple[list[np.ndarray], np.ndarray]:
        """The names that a tree of ``depth`` may have for this block: for each length the
        contexts and the symbols after them, and the order in which all are asked for.
        ``there`` is the bitmap of the tree's names."""
        found = [[np.zeros(0, np.uint64)] for _ in range(2 * depth)]
        first = _maybe(there, self.alone)
        for part in self.parts():
            words = part.vocabulary[part.codes]
            for n, (key, known) in enumerate(part.keys(depth)):
                at = np.flatnonzero(known)
                at = at[_maybe(there, key[at]) if n else first[part.codes[at - 1]]]
                symbols = extended(key[at], words[at]) ^ SYMBOL
                found[2 * n].append(distinct(key[at]))
                found[2 * n + 1].append(distinct(symbols[_maybe(there, symbols)]))
        names = [distinct(np.concatenate(x)) for x in found]
        return names, np.argsort(np.concatenate(names))


@dataclass
class Bitmap:
    """A key sets ``marks`` bits of one word."""

    words: np.ndarray
    marks: int


def bitmap(keys: DataFrame) -> Bitmap:
    """A bitmap in which all of ``keys`` (one column, key) are set, and few others. It has
    16 bits a key as long as that is below 1 << FILTER_BITS."""
    n = keys.count()
    bits = min(FILTER_BITS, max(6, (16 * n).bit_length()))
    marks = min(MARKS, max(1, round(math.log(2) * (1 << bits) / max(n, 1))))
    word = F.shiftright(F.col("key").bitwiseAND(F.lit((1 << bits) - 1)), 6)
    mark = reduce(Column.bitwiseOR, (F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {x}) & 63 as int))") for x in _SHIFTS[:marks]))
    with no_shuffle_files(keys.sparkSession):
        words = keys.select(word.alias("i"), mark.alias("mark")).groupBy("i").agg(F.bit_or("mark").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[words.column("i").to_numpy()] = words.column("bits").to_numpy()
    return Bitmap(out.view(np.uint64), marks)


_SHIFTS = (0, 40, 46)  # where a key's marks are in it


def _maybe(there: Bitmap, keys: np.ndarray) -> np.ndarray:
    word = there.words[(keys & np.uint64(64 * len(there.words) - 1)) >> np.uint64(6)]
    found = (word >> (keys & np.uint64(63))) & np.uint64(1) == 1
    at = np.flatnonzero(found)
    word, keys = word[at], keys[at]
    for x in _SHIFTS[1 : there.marks]:
        found[at] &= (word >> ((keys >> np.uint64(x)) & np.uint64(63))) & np.uint64(1) == 1
    return found


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Block]]:
    for b in batches:
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            yield row, Block(row)


def word_totals(coded: DataFrame, buckets: int, least: int) -> DataFrame:
    """(block, bucket, totals) answers every block's words in the order sent; the rows
    without block have the bucket's number of distinct training words and those with
    ``least`` counts or more."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in blocks_of(batches):
            counts = np.bincount(block.codes[block.train], minlength=len(block.vocabulary)).astype("<i4")
            bucket = _bucket(block.vocabulary, buckets)
            cut = runs(bucket)
            rows = [(int(bucket[x]), row["block"], packed(block.vocabulary[x:y]), pressed(counts[x:y])) for x, y in zip(cut[:-1], cut[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["bucket", "block", "words", "counts"])

    def total(t: pa.Table) -> pa.Table:
        keys = [unpacked(x) for x in t.column("words").to_pylist()]
        counts = np.concatenate([unpressed(x, "<i4") for x in t.column("counts").to_pylist()])
        words, place = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.zeros(len(words), np.int64)
        np.add.at(totals, place, counts)
        place = np.split(place, np.cumsum([len(k) for k in keys])[:-1])
        often = totals >= least
        bucket = t.column("bucket")[0].as_py()
        rows = [(b, bucket, pressed(totals[p]), None, None, None) for b, p in zip(t.column("block").to_pylist(), place)]
        rows.append((None, bucket, None, int((totals > 0).sum()), words[often].tobytes(), totals[often].astype("<i8").tobytes()))
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
        names = ["block", "bucket", "totals", "distinct", "words", "counts"]
        return pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})

    sent = coded.mapInArrow(send, "bucket long, block long, words binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(total, "block long, bucket long, totals binary, distinct long, words binary, counts binary")


@dataclass
class Level:
    """States of one length, with the sorted keys of states and of their kept symbols."""

    keys: np.ndarray
    seen: np.ndarray  # occurrences of the context
    rest: np.ndarray  # log10 of the factor of all symbols that are not kept
    pairs: np.ndarray
    counts: np.ndarray  # occurrences of context and symbol


class Tree:
    """A probabilistic suffix tree, or the part of one that a block of texts meets;
    ``train_tokens`` and ``distinct`` make the root."""

    def __init__(self, train_tokens: int, distinct: int, levels: list[Level]):
        self.train_tokens, self.distinct, self.levels = train_tokens, distinct, levels

    def root(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.train_tokens + self.distinct + 1.0))

    def log10(self, at_root: np.ndarray, keys: list[np.ndarray], words: np.ndarray, depth: int | None = None) -> np.ndarray:
        """log10 probabilities of ``words`` after contexts whose suffixes of length 1, 2, ...
        have ``keys``, 0 for none: from the root down to the longest state."""
        p = at_root.copy()
        for level, key in zip(self.levels[:depth], keys):
            state = np.flatnonzero(key)
            self.step(level, p, key, words, state, _find(level.keys, key[state]))
        return p

    def step(self, level: Level, p: np.ndarray, key: np.ndarray, words: np.ndarray, state: np.ndarray, at: np.ndarray) -> None:
        """Change ``p`` from the level below to this one, where the contexts at ``state`` are
        the level's states ``at``, or none if that is -1."""
        state, at = state[at >= 0], at[at >= 0]
        there = _find(level.pairs, extended(key[state], words[state]))
        kept = there >= 0
        own = (level.counts[there[kept]] + PRIOR * 10 ** p[state[kept]]) / (level.seen[at[kept]] + PRIOR)
        p[state] += level.rest[at]
        p[state[kept]] = np.log10(own)


class SpreadTree(Tree):
    """A whole tree, whose levels stay tables: own, context, c, n, p, kept and rest of every
    frequent sequence, where ``rest`` is null unless the context is a state and ``kept``
    says whether that state keeps the symbol."""

    def __init__(self, train_tokens: int, distinct: int):
        self.train_tokens, self.distinct, self.tables = train_tokens, distinct, []

    @cached_property
    def levels(self) -> list[Level]:
        """All levels in memory, to look at small trees; scoring never asks for them."""
        out = []
        for t in self.tables:
            states = t.filter("rest IS NOT NULL").groupBy("context").agg(F.first("n").alias("n"), F.first("rest").alias("rest")).toArrow()
            out.append(Level(*_sorted(states, "context", "n", "rest"), *_sorted(t.filter("kept").select("own", "c").toArrow(), "own", "c")))
        return out

    def names(self) -> DataFrame:
        """(key, n, rest): a state by its key, a kept symbol (whose rest is null) by its own key and SYMBOL."""
        symbol = F.col("own").bitwiseXOR(F.lit(int(SYMBOL))).alias("key")
        states = [t.filter("rest IS NOT NULL").groupBy(F.col("context").alias("key")).agg(F.first("n").alias("n"), F.first("rest").alias("rest")) for t in self.tables]
        symbols = [t.filter("kept").select(symbol, F.col("c").alias("n"), F.lit(None).cast("double").alias("rest")) for t in self.tables]
        return reduce(DataFrame.union, states + symbols)


def _sorted(t: pa.Table, key: str, *values: str) -> list[np.ndarray]:
    keys = t.column(key).to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return [keys[order], *(t.column(v).to_numpy()[order] for v in values)]


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of ``keys``, -1 for those that are not there."""
    if not len(sorted_keys):
        return np.full(len(keys), -1)
    order = np.argsort(keys)  # a search in order is several times as fast
    keys = keys[order]
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    out = np.empty(len(keys), np.int64)
    out[order] = np.where(sorted_keys[at] == keys, at, -1)
    return out


def sequence_counts(coded: DataFrame, depth: int, below: DataFrame, often: tuple[Common, Common, Common], train_tokens: int, buckets: int, least: float) -> DataFrame:
    """(context, own, suffix, c) of the sequences of a context of ``depth`` words and a symbol
    that occur MIN_SYMBOL_COUNT times in training: keys of the context, of the sequence and of
    the sequence without its first word.

    ``below`` has the frequent sequences of ``depth`` words (own, c): a context is one of
    those with ``least`` occurrences, and the suffix is any of them. ``often`` are common
    words, sequences of ``depth - 1`` words and sequences of ``depth`` words.
    """
    contexts = below.filter(F.col("c") >= least).select(F.col("own").alias("key"))
    heavy = below.filter(F.col("c") > train_tokens / (HEAVY * buckets)).select("own").toArrow()
    heavy = np.sort(heavy.column("own").to_numpy().view(np.uint64))  # at most HEAVY * buckets
    sent = coded.sparkSession.sparkContext.broadcast((bitmap(contexts), bitmap(below.select(F.col("own").alias("key"))), heavy, often))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        contexts, suffixes, heavy, (often_words, often_shorter, often_contexts) = sent.value
        for _, block in blocks_of(batches):
            parts, first = [], (_maybe(contexts, block.alone), _maybe(suffixes, block.alone)) if depth == 1 else None
            for part in block.parts():
                words = part.vocabulary[part.codes]
                shorter, context = [np.zeros(len(words), np.uint64), *(key for key, _ in part.keys(depth))][-2:]
                at = np.flatnonzero(part.train & (part.place >= depth))
                if first:
                    at = at[first[0][part.codes[at - 1]] & first[1][part.codes[at]]]
                else:
                    at = at[_maybe(contexts, context[at])]
                    at = at[_maybe(suffixes, extended(shorter[at], words[at]))]
                own = extended(context[at], words[at])
                order = np.argsort(own)
                cut = runs(own[order])
                at = at[order[cut[:-1]]]
                parts.append((context[at], shorter[at], part.codes[at], np.diff(cut).astype("<i4")))
            context, shorter, codes, n = (np.concatenate(x) for x in zip(*parts))
            del parts
            if not len(n):
                continue
            own = extended(context, block.vocabulary[codes])
            order = np.argsort(own)
            cut = runs(own[order])
            n = np.add.reduceat(n[order], cut[:-1], dtype="<i4")
            at = order[cut[:-1]]
            # A context's sequences travel together, which packs well; a heavy one's do not.
            own, context, shorter, codes = own[at], context[at], shorter[at], codes[at]
            route = np.where(_find(heavy, context) >= 0, own, context)
            order = np.argsort(route)
            bucket, context, shorter, codes, n = _bucket(route[order], buckets), context[order], shorter[order], codes[order], n[order]
            symbols, symbol_ranks = block.vocabulary[codes], often_words.ranks(block.vocabulary)[codes]
            shorter_ranks, context_ranks = often_shorter.ranks(shorter), often_contexts.ranks(context)
            cut = runs(bucket)
            rows = []
            for x, y in zip(cut[:-1], cut[1:]):
                change = runs(context[x:y])
                head = x + change[:-1]
                rows.append((int(bucket[x]), *often_contexts.listed(context[head], context_ranks[head]), *often_shorter.listed(shorter[head], shorter_ranks[head]), pressed(np.diff(change).astype("<i4")), *often_words.listed(symbols[x:y], symbol_ranks[x:y]), pressed(n[x:y])))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["bucket", "contexts", "contexts_at", "shorter", "shorter_at", "lengths", "symbols", "symbols_at", "counts"])

    def total(t: pa.Table) -> pa.Table:
        *_, (often_words, often_shorter, often_contexts) = sent.value
        joined = lambda read, *names: np.concatenate([read(*x) for x in zip(*(t.column(n).to_pylist() for n in names))])
        small = lambda x: unpressed(x, "<i4")
        contexts, symbols = joined(often_contexts.unlisted, "contexts", "contexts_at"), joined(often_words.unlisted, "symbols", "symbols_at")
        run = np.repeat(np.arange(len(contexts), dtype=np.int32), joined(small, "lengths"))
        own = extended(contexts[run], symbols)
        order = np.argsort(own)
        cut = runs(own[order])
        totals = np.add.reduceat(joined(small, "counts")[order], cut[:-1], dtype=np.int64)
        stay = totals >= MIN_SYMBOL_COUNT
        first = order[cut[:-1][stay]]
        shorter = joined(often_shorter.unlisted, "shorter", "shorter_at")[run[first]]
        found = [contexts[run[first]], own[first], extended(shorter, symbols[first]), totals[stay]]
        return pa.table({n: c.view(np.int64) for n, c in zip(("context", "own", "suffix", "c"), found)})

    sending = coded.mapInArrow(send, "bucket long, contexts binary, contexts_at binary, shorter binary, shorter_at binary, lengths binary, symbols binary, symbols_at binary, counts binary")
    return sending.groupBy("bucket").applyInArrow(total, "context long, own long, suffix long, c long")


def grow(coded: DataFrame, tree: SpreadTree, words: DataFrame, buckets: int, depth: int, min_context: float, min_symbol: float) -> None:
    """Add the states of each length in turn; ``words`` are the frequent words (word, own, c, p)."""
    least = max(MIN_CONTEXT_COUNT, min_context * tree.train_tokens)
    below, often_words, contexts = words, common(words, "word"), Common(np.zeros(1, np.uint64))
    for n in range(1, depth + 1):
        shorter, contexts = contexts, common(below, "own")
        found = sequence_counts(coded, n, below, (often_words, shorter, contexts), tree.train_tokens, buckets, least)
        below = saved(_judged(found, below, least, min_symbol), "tree-level")
        if below.isEmpty():
            return
        tree.tables.append(below)


def _judged(found: DataFrame, below: DataFrame, least: float, min_symbol: float) -> DataFrame:
    """The divergence tests: which contexts become states (``rest``), with which symbols
    (``kept``), and each sequence's log10 probability ``p`` by the tree so far.

    All that is looked up is in ``below``: a sequence's context has ``least`` occurrences,
    and its suffix occurs at least as often as it does.
    """
    suffixes = below.select(F.col("own").alias("suffix"), F.col("p").alias("at_suffix"))
    contexts = below.filter(F.col("c") >= least).select(F.col("own").alias("context"), F.col("c").alias("n"))
    c, n, old, new = F.col("c"), F.col("n"), F.col("old"), F.col("new")
    kept = (c >= min_symbol * n) & (c > n * old) & (c * F.ln(c / (n * old)) - (c - n * old) >= SYMBOL_NATS)
    per_context = Window.partitionBy("context")
    over = lambda x: F.sum(F.when(F.col("kept"), x).otherwise(0.0)).over(per_context)
    # Symbols whose suffix gives them nearly everything leave no rest to compare.
    factor = F.greatest(1 - F.col("mass"), F.lit(1e-12)) / F.greatest(1 - F.col("mass_before"), F.lit(1e-12))
    divergence = n * (F.col("nats") + (1 - F.col("mass")) * F.ln(factor))
    t = found.join(suffixes, "suffix").withColumn("old", F.pow(F.lit(10.0), "at_suffix")).join(contexts, "context")
    t = t.withColumn("kept", kept).withColumn("new", (c + PRIOR * old) / (n + PRIOR))
    t = t.select("*", over(new).alias("mass"), over(old).alias("mass_before"), over(new * F.ln(new / old)).alias("nats"))
    t = t.withColumn("rest", F.when((F.col("mass") > 0) & (divergence >= STATE_NATS), F.log10(factor)))
    t = t.withColumn("kept", F.col("kept") & F.col("rest").isNotNull())
    p = F.when(F.col("kept"), F.log10(new)).otherwise(F.col("at_suffix") + F.coalesce("rest", F.lit(0.0)))
    return t.select("own", "context", "c", "n", p.alias("p"), "kept", "rest")


def fit(coded: DataFrame, depth: int = DEPTH, min_context: float = MIN_CONTEXT, min_symbol: float = MIN_SYMBOL) -> tuple[SpreadTree, DataFrame, int]:
    """The tree of the training texts, the totals of every block's words, and the number of buckets."""
    train = F.expr("aggregate(zip_with(lengths, held, (n, out) -> if(out, 0L, cast(n as long))), 0L, (a, b) -> a + b)")
    tokens, train_tokens = coded.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum(train), F.lit(0))).first()
    buckets = max(partitions(coded.sparkSession), math.ceil(tokens / BUCKET_ENTRIES))
    totals = saved(word_totals(coded, buckets, MIN_SYMBOL_COUNT), "word-totals")
    often = totals.filter("block IS NULL")
    tree = SpreadTree(train_tokens, often.agg(F.coalesce(F.sum("distinct"), F.lit(0))).first()[0])
    root = Tree(tree.train_tokens, tree.distinct, [])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for words, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words, counts = np.frombuffer(words, "<u8"), np.frombuffer(counts, "<i8")
                own = extended(np.zeros(len(words), np.uint64), words).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (words.view(np.int64), own, counts, root.root(counts))], names=["word", "own", "c", "p"])

    words = saved(often.select("words", "counts").mapInArrow(unpack, "word long, own long, c long, p double"), "frequent-words")
    grow(coded, tree, words, buckets, depth, min_context, min_symbol)
    return tree, totals, buckets


def looked_up(coded: DataFrame, names: DataFrame, depth: int, there: Broadcast, buckets: int) -> DataFrame:
    """(block, bucket, totals, rest) answers the names that every block wants, in the order of
    sending: ``totals`` are 0 for those that the tree does not have, and ``rest`` is that of
    the states among the others."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in blocks_of(batches):
            parts, order = block.wanted(depth, there.value)
            wanted = np.concatenate(parts)[order]
            bucket = _bucket(wanted, buckets)
            cut = runs(bucket)
            rows = [(row["block"], int(bucket[x]), packed(wanted[x:y])) for x, y in zip(cut[:-1], cut[1:])]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["block", "bucket", "names"])

    def answer(asked: pa.Table, part: pa.Table) -> pa.Table:
        keys, n, rest = _sorted(part, "key", "n", "rest")
        n, rest = np.append(n, 0), np.append(rest, np.nan)
        at = [_find(keys, unpacked(x)) for x in asked.column("names").to_pylist()]
        totals = [pressed(n[x]) for x in at]
        rests = [pressed(rest[x[~np.isnan(rest[x])]]) for x in at]
        return pa.table({"block": asked.column("block"), "bucket": asked.column("bucket"), "totals": pa.array(totals, pa.binary()), "rest": pa.array(rests, pa.binary())})

    asked = coded.mapInArrow(send, "block long, bucket long, names binary")
    bucket = F.shiftright(F.shiftrightunsigned("key", 32) * F.lit(buckets), 32).cast("long")
    return asked.groupBy("bucket").cogroup(names.withColumn("bucket", bucket).groupBy("bucket")).applyInArrow(answer, "block long, bucket long, totals binary, rest binary")


def part_of_tree(tree: Tree, parts: list[np.ndarray], order: np.ndarray, answers: list[dict]) -> Tree:
    """The tree with the levels that a block's ``answers`` to its wanted names tell."""
    joined = lambda pieces, kind: np.concatenate([np.zeros(0, kind), *pieces])
    state = np.repeat(np.arange(len(parts)) % 2 == 0, [len(p) for p in parts])[order]
    counts, rest = np.zeros((2, len(order)))
    asked = joined((unpressed(a["totals"], "<i8") for a in answers), "<i8")
    told = np.zeros(len(order))
    told[state & (asked > 0)] = joined((unpressed(a["rest"], "<f8") for a in answers), "<f8")
    counts[order], rest[order] = asked, told
    bounds = np.cumsum([len(p) for p in parts])[:-1]
    levels, counts, rest = [], np.split(counts, bounds), np.split(rest, bounds)
    for i in range(0, len(parts), 2):
        has, keeps = counts[i] > 0, counts[i + 1] > 0
        pairs = parts[i + 1][keeps] ^ SYMBOL
        by_pair = np.argsort(pairs)
        levels.append(Level(parts[i][has], counts[i][has], rest[i][has], pairs[by_pair], counts[i + 1][keeps][by_pair]))
    return Tree(tree.train_tokens, tree.distinct, levels)


def score(docs: DataFrame, held_out: Column, depth: int = DEPTH, min_context: float = MIN_CONTEXT, min_symbol: float = MIN_SYMBOL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Scores of all whole texts by a tree learnt from those that are not ``held_out``.

    Returns one row per row of ``docs``: doc_id, held_out, n_tokens (words
    and one end), n_known (tokens that training has), train_tokens,
    base_score (by word counts alone) and score, both log10 probabilities of
    the whole text. A-Z are lowered; words are runs of characters other than
    ASCII white space, told apart by 64-bit hashes. A null or empty text has
    only its end. A null in ``held_out`` counts as training, and null or
    repeated ids are rows like any others. Other columns are not read, an
    empty table gives an empty result; without training texts every token
    has probability 1 (the unknown word is all there is).
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held"))
    coded = saved_by_block(code_texts(docs, F.col("held")), "coded_texts")
    tree, totals, buckets = fit(coded, depth, min_context, min_symbol)
    levels = len(tree.tables)
    if levels:
        names = saved(tree.names(), "tree-names")
        there = coded.sparkSession.sparkContext.broadcast(bitmap(names.select("key")))
    none = F.lit(None).cast("binary").alias("rest")
    answers = totals.filter("block IS NOT NULL").select("block", F.lit(False).alias("of_tree"), "bucket", "totals", none)
    if levels:
        part = saved(looked_up(coded, names, levels, there, buckets), "tree-parts")
        answers = answers.union(part.select("block", F.lit(True), "bucket", "totals", "rest"))
    answers = answers.groupBy("block").agg(F.collect_list(F.struct("of_tree", "bucket", "totals", "rest")).alias("answers"))
    root = Tree(tree.train_tokens, tree.distinct, [])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, block in blocks_of(batches):
            answers = sorted(row["answers"], key=lambda a: a["bucket"])
            counts = np.concatenate([unpressed(a["totals"], "<i8") for a in answers if not a["of_tree"]])
            tree = part_of_tree(root, *block.wanted(levels, there.value), [a for a in answers if a["of_tree"]]) if levels else root
            at_root, sums = tree.root(counts), []
            first = _find(tree.levels[0].keys, block.alone) if levels else None
            for part in block.parts():
                base, words = at_root[part.codes], part.vocabulary[part.codes]
                p = base.copy()
                for n, (key, known) in enumerate(part.keys(levels)):
                    state = np.flatnonzero(known)
                    if n:
                        state = state[_maybe(there.value, key[state])]
                    tree.step(tree.levels[n], p, key, words, state, _find(tree.levels[n].keys, key[state]) if n else first[part.codes[state - 1]])
                sums.append([np.add.reduceat(x, part.starts) for x in ((counts > 0)[part.codes].astype(np.int64), base, p)])
            known, base, p = (np.concatenate(x) for x in zip(*sums))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(block.ids, pa.int64()),
                    pa.array(block.held),
                    pa.array(block.lengths),
                    pa.array(known),
                    pa.array(np.full(len(known), tree.train_tokens)),
                    pa.array(base),
                    pa.array(p),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return coded.join(answers, "block").mapInArrow(judge, RESULT)
