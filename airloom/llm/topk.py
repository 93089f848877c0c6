"""Exact top-k by inner product with Fagin's threshold algorithm, in blocks.

Candidates and queries are cut into blocks of bounded size; every pair of
blocks is one group. In a group each dimension has its candidates in a
sorted list. Sorted access goes down all lists of a query at once, from the
end that its sign asks for, to a depth that doubles; every row met so far in
any list is scored in full (random access). No row that was not met can
score more than the sum of the values at that depth, so a query stops when
this bound is below its kth score. Equal scores go to the smaller id, hence
"below", not "at most".
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from airloom.llm.common import blocks, partitions, runs, save

ROWS = 1 << 16  # most rows of a candidate block
QUERIES = 1 << 16  # most rows of a query block
FEW = 4096  # rows of a block that need not be divided to have work for more tasks
BATCH = 256  # queries that go down the lists together


def quantised(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of each component, x as double; values beyond long saturate."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column; shorter vectors are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()]
    if (lengths == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(lengths), dim), dtype=np.int64)
    out[np.arange(dim) < lengths[:, None]] = values
    return out


def _narrowest(least: int, most: int) -> type:
    """The narrowest integers that hold all values."""
    return next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= least and most <= np.iinfo(t).max)


def _exact_type(q: np.ndarray, x: np.ndarray):
    """The fastest type in which every inner product is exact."""
    top = [max(abs(int(a.min(initial=0))), abs(int(a.max(initial=0)))) for a in (q, x)]
    bound = top[0] * top[1] * max(1, q.shape[1])
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object


def threshold_topk(qid: np.ndarray, q: np.ndarray, xid: np.ndarray, x: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query the ids and scores of its k best rows, best first."""
    order = np.argsort(xid, kind="stable")
    xid, x = xid[order], x[order]
    n, kind = len(xid), _exact_type(q, x)
    rank = np.empty(x.shape, dtype=np.int32)  # place of each row in each list, least value first
    lists = np.argsort(x, axis=0, kind="stable")
    np.put_along_axis(rank, lists, np.arange(n, dtype=np.int32)[:, None] * np.ones((1, x.shape[1]), np.int32), axis=0)
    ascending = np.take_along_axis(x, lists, axis=0).astype(kind)
    q, x = q.astype(kind), x.astype(kind)
    lowest = -np.inf if kind in (np.float32, np.float64) else np.iinfo(np.int64).min if kind is np.int64 else -(2**200)
    found: list = [None] * len(qid)
    for start in range(0, len(qid), BATCH):
        live = np.arange(start, min(start + BATCH, len(qid)))
        depth = min(n, 4 * k)
        while len(live):
            up, down = np.where(q[live] > 0, q[live], 0), np.where(q[live] < 0, q[live], 0)
            bound = up @ ascending[n - depth] + down @ ascending[depth - 1]
            if depth < n:
                met = (up > 0).astype(np.float32) @ (rank >= n - depth).astype(np.float32).T
                met += (down < 0).astype(np.float32) @ (rank < depth).astype(np.float32).T
                met = met > 0
            else:
                met = np.ones((len(live), n), dtype=bool)
            met &= xid[None, :] != qid[live][:, None]
            rows = np.flatnonzero(met.any(axis=0))
            score = np.where(met[:, rows], q[live] @ x[rows].T, lowest)
            left = []
            for i, at in enumerate(live):
                s = score[i]
                kth = np.partition(s, len(s) - k)[len(s) - k] if len(s) >= k else lowest
                if depth < n and not (kth > lowest and bound[i] < kth):
                    left.append(at)
                    continue
                best = np.flatnonzero((s >= kth) & (s > lowest))
                best = best[np.argsort(-s[best], kind="stable")[:k]]
                found[at] = (xid[rows[best]], s[best])
            live, depth = np.array(left, dtype=np.int64), min(n, depth * 4)
    return found


def top_k(vectors: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of each query's k best rows.

    ``queries`` is a condition on ``vectors`` that marks the query rows;
    candidates are all rows but those with the query's own id. Rows with a
    null id, a null vector or a null or non-finite component take no part.
    Rows that share an id count once, with the least of their vectors in
    array order. Vectors of unequal length are compared with zeros filled
    up. With fewer than k candidates there are fewer rows; empty tables give
    none. Ties go to the smaller id. Scores beyond a long saturate.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col)
    usable = F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = save(
        vectors.select(F.col(id_col).cast("long").alias("id"), quantised(v, scale).alias("q"), queries.alias("is_query"), usable.alias("usable"))
        .filter("usable")
        .groupBy("id")
        .agg(F.min("q").alias("q"), F.max("is_query").alias("is_query")),
        "topk-vectors",
    )
    n, nq, dim, least, most = rows.agg(F.count(F.lit(1)), F.count_if("is_query"), F.max(F.size("q")), F.min(F.array_min("q")), F.max(F.array_max("q"))).first()
    dim, kind = dim or 0, _narrowest(least or 0, most or 0)
    # Large blocks: a candidate is sent once for each block of queries, a query once for each of candidates.
    nx = max(blocks(n, ROWS), min(partitions(spark), blocks(n, FEW)))
    ny = blocks(nq, QUERIES)

    def block(size: int) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(size)).cast("int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A batch's rows of one block as one row, in the narrowest integers."""
        for b in batches:
            asks, at = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            ids, m = b.column(2).to_numpy(), _matrix(b.column(3), dim).astype(kind)
            order = np.lexsort((at, asks))
            bound = np.union1d(runs(at[order]), runs(asks[order]))
            parts = [order[x:y] for x, y in zip(bound[:-1], bound[1:])]
            rows = [(bool(asks[p[0]]), int(at[p[0]]), ids[p].tobytes(), m[p].tobytes()) for p in parts]
            columns = list(zip(*rows)) if rows else [[]] * 4
            kinds = (pa.bool_(), pa.int32(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["asks", "at", "ids", "vectors"])

    asked = rows.filter("is_query").select(F.lit(True).alias("asks"), block(ny).alias("at"), "id", "q")
    packed = asked.unionByName(rows.select(F.lit(False).alias("asks"), block(nx).alias("at"), "id", "q")).mapInArrow(pack, "asks boolean, at int, ids binary, vectors binary")
    other = F.explode(F.sequence(F.lit(0), F.when(F.col("asks"), nx).otherwise(ny) - 1))
    pairs = packed.withColumn("other", other).select(
        "asks", "ids", "vectors", F.when(F.col("asks"), F.col("at")).otherwise(F.col("other")).alias("qb"), F.when(F.col("asks"), F.col("other")).otherwise(F.col("at")).alias("xb")
    )

    def unpack(t: pa.Table, asks: bool) -> tuple[np.ndarray, np.ndarray]:
        own = t.filter(t.column("asks") if asks else pc.invert(t.column("asks")))
        ids = np.frombuffer(b"".join(own.column("ids").to_pylist()), np.int64)
        return ids, np.frombuffer(b"".join(own.column("vectors").to_pylist()), kind).reshape(len(ids), dim).astype(np.int64)

    def search(t: pa.Table) -> pa.Table:
        (qid, q), (xid, x) = unpack(t, True), unpack(t, False)
        found = threshold_topk(qid, q, xid, x, k) if len(qid) and len(xid) else []
        score = [s for _, s in found]
        top = np.iinfo(np.int64).max
        return pa.table(
            {
                "query_id": np.repeat(qid[: len(found)], [len(x) for x in score]).astype(np.int64),
                "vec_id": np.concatenate([i for i, _ in found] or [np.zeros(0, np.int64)]).astype(np.int64),
                "score": np.array([min(max(int(x), -top - 1), top) for s in score for x in s], dtype=np.int64),
            }
        )

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.groupBy("qb", "xb")
        .applyInArrow(search, "query_id long, vec_id long, score long")
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
