"""Operator 9: exact top-k by inner product, exhaustive term-at-a-time.

Component ``t`` of a vector is term ``t`` with an integer weight
``floor(scale * x)``; zero weights have no posting.  Candidates are dealt into
blocks, queries too, and every query block meets every candidate block by an
equi-join on the pair of block numbers.  Inside a pair of blocks each query's
terms scatter their weighted postings into one dense score array, the k best
are selected by partition, and the results of all blocks are merged by a rank
per query.

Defined cases: vectors that are null or hold a null or non-finite component
take no part, nor do rows without id; zero vectors do; shorter vectors have no
posting for the missing terms; rows that repeat an id count once (the smallest
vector stands); ties go to the smaller id; scores beyond 64 bits saturate;
fewer than k candidates are all returned; an empty table gives no rows; other
input columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.llm.common import cut, ship

_HIT = "query_id long, vec_id long, score long"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``x`` (doubles) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long"), x.alias("x")) \
        .where(F.col("vec_id").isNotNull() & F.col("x").isNotNull()) \
        .where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))


def weights(column: pa.ChunkedArray, scale: int) -> np.ndarray:
    """Rows x terms of floor(scale * x); int64, or Python ints if those overflow."""
    flat = column.combine_chunks()
    if isinstance(flat, pa.ChunkedArray):
        flat = pa.concat_arrays(flat.chunks) if flat.num_chunks else pa.array([], column.type)
    sizes = np.diff(flat.offsets.to_numpy()) if len(flat) else np.zeros(0, int)
    values = flat.flatten().to_numpy(zero_copy_only=False)
    w = np.zeros((len(flat), int(sizes.max(initial=0))))
    w[np.arange(w.shape[1])[None, :] < sizes[:, None]] = values
    w = np.floor(scale * w)
    if np.abs(w).max(initial=0) < 2 ** 24:
        return w.astype(np.int64)
    return np.array([[int(v) for v in row] for row in w], object).reshape(w.shape)


def best_of_block(queries: tuple[np.ndarray, np.ndarray], block: tuple[np.ndarray, np.ndarray],
                  k: int) -> list[tuple[int, int, int]]:
    """(query, candidate, score) of the k best candidates of one block per query."""
    q_ids, q = queries
    ids, c = block
    order = np.argsort(ids, kind="stable")
    ids, c = ids[order], c[order]
    exact = np.int64 if q.dtype == c.dtype == np.int64 else object
    posting = [np.flatnonzero(c[:, t]) for t in range(c.shape[1])]
    weight = [c[p, t] for t, p in enumerate(posting)]
    out = []
    for own, row in zip(q_ids, q, strict=True):
        score = np.zeros(len(ids), exact)
        for t in np.flatnonzero(row[:len(posting)]):
            score[posting[t]] += row[t] * weight[t]
        if exact is object:
            score = np.array([min(max(int(v), -2 ** 63), 2 ** 63 - 1) for v in score], np.int64)
        other = np.flatnonzero(ids != own)
        s = score[other]
        if len(s) > k:                                     # all at or above the k-th best score
            floor = np.partition(s, len(s) - k)[len(s) - k]
            top = np.flatnonzero(s > floor)
            tied = np.flatnonzero(s == floor)[:k - len(top)]
            pick = np.concatenate([top, tied])
        else:
            pick = np.arange(len(s))
        out += [(int(own), int(ids[other[i]]), int(s[i])) for i in pick]
    return out


def search(vectors: DataFrame, *, k: int = 5, every: int = 50, scale: int = 256,
           block_rows: int = 16_384, query_rows: int = 2_048) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows for each query row."""
    ship(vectors.sparkSession)
    # an id on very many rows is one vector before rows are dealt by id
    rows = cut(usable(vectors).groupBy("vec_id").agg(F.min("x").alias("x")))
    queries = rows.where(F.col("vec_id") % every == 0)
    n, n_queries = rows.count(), queries.count()
    blocks, query_blocks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(n_queries / query_rows))

    def number(count: int):
        return F.pmod(F.xxhash64("vec_id"), F.lit(count)).cast("int")

    def every_block(count: int):
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = rows.withColumn("block", number(blocks)).withColumn("q_block", every_block(query_blocks))
    right = queries.withColumn("q_block", number(query_blocks)).withColumn("block", every_block(blocks))

    def ready(part: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        x = part.column("x").to_pylist()
        ids = part.column("vec_id").to_pylist()
        first: dict[int, list] = {}
        if len(set(ids)) < len(ids):
            for i, v in zip(ids, x, strict=True):
                first[i] = min(first.get(i, v), v)
            part = pa.table({"vec_id": pa.array(list(first), pa.int64()),
                             "x": pa.array(list(first.values()), pa.list_(pa.float64()))})
        return part.column("vec_id").to_numpy(), weights(part.column("x"), scale)

    def pair(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        hits = best_of_block(ready(asked), ready(candidates), k) \
            if candidates.num_rows and asked.num_rows else []
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*hits, strict=True) if hits else ([], [], []))],
                        names=["query_id", "vec_id", "score"])

    hits = left.groupBy("q_block", "block").cogroup(right.groupBy("q_block", "block")).applyInArrow(pair, _HIT)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
