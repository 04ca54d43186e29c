"""User-defined aggregates that merge (X-10, X-11): create, add, merge, result.

``windowed_user_agg`` runs such an aggregate per (window, keys) in two phases, as Spark does
its own.  First every task folds its rows into accumulators by ``add`` (Arrow batches, a
dictionary of at most ``held`` groups, sent on when full).  Only accumulators are
shuffled, so a key or window that holds a third of all rows moves one accumulator per
task.  Then each partition, sorted by group, merges its accumulators as a stream, one
group at a time, and gives one row per group.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewatch.operators.windows import _seconds, _spec


class UserAggregate:
    """Base class.  ``add`` may keep or replace the accumulator it is given; ``merge`` must be
    associative and commutative, with ``create()`` as its neutral element."""

    #: DDL of the result columns, e.g. ``"n BIGINT, top DOUBLE"``.
    output: str

    def create(self) -> Any:
        raise NotImplementedError

    def add(self, acc: Any, rows: dict[str, list]) -> Any:
        """Fold rows of one group, given as lists by input column, into ``acc``."""
        raise NotImplementedError

    def merge(self, a: Any, b: Any) -> Any:
        raise NotImplementedError

    def result(self, acc: Any) -> tuple:
        raise NotImplementedError

    def pack(self, acc: Any) -> bytes:
        return pickle.dumps(acc, protocol=5)

    def unpack(self, data: bytes) -> Any:
        return pickle.loads(data)


class HistogramMedian(UserAggregate):
    """Rows, the bin of the lower median and the fullest bin (ties: the lowest) of a number in
    bins of ``width``.  The accumulator is a sparse histogram, so it merges exactly."""

    output = "n BIGINT, median_bin BIGINT, peak_bin BIGINT"

    def __init__(self, col: str, width: float):
        self.col, self.width = col, width

    def create(self):
        return {}

    def add(self, acc, rows):
        import math
        for v in rows[self.col]:
            if v is not None and math.isfinite(v):
                b = math.floor(v / self.width)
                acc[b] = acc.get(b, 0) + 1
        return acc

    def merge(self, a, b):
        for k, n in b.items():
            a[k] = a.get(k, 0) + n
        return a

    def result(self, acc):
        n = sum(acc.values())
        if not n:
            return 0, None, None
        seen = 0
        for b in sorted(acc):
            seen += acc[b]
            if 2 * seen >= n:
                break
        return n, b, min(acc, key=lambda k: (-acc[k], k))


def user_agg(df: DataFrame, keys: Sequence[str], agg: UserAggregate, inputs: Sequence[str],
             held: int = 50_000) -> DataFrame:
    """``*keys`` and the columns of ``agg.output`` for every group of ``df``."""
    keys, inputs = list(keys), list(inputs)
    kinds = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, Any] = {}
        schema = None

        def sent() -> pa.RecordBatch:
            rows = list(groups.items())
            groups.clear()
            columns = [pa.array([g[i] for g, _ in rows], schema.field(k).type) for i, k in enumerate(keys)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([agg.pack(a) for _, a in rows], pa.binary())],
                                              names=[*keys, "_acc"])

        for batch in batches:
            schema = batch.schema
            at: dict[tuple, list[int]] = {}
            for i, g in enumerate(zip(*(batch.column(k).to_pylist() for k in keys), strict=True)):
                at.setdefault(g, []).append(i)
            values = {c: batch.column(c).to_pylist() for c in inputs}
            for g, rows in at.items():
                if g not in groups:
                    groups[g] = agg.create()
                groups[g] = agg.add(groups[g], {c: [v[i] for i in rows] for c, v in values.items()})
            if len(groups) >= held:
                yield sent()
        if groups:
            yield sent()

    names = [p.strip().split(" ")[0] for p in agg.output.split(",")]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, acc, schema, done = None, None, None, []

        def sent() -> pa.RecordBatch:
            rows = [dict(zip([*keys, *names], [*g, *r], strict=True)) for g, r in done]
            done.clear()
            columns = [pa.array([r[k] for r in rows], schema.field(k).type) for k in keys]
            return pa.RecordBatch.from_arrays([*columns, *[pa.array([r[c] for r in rows]) for c in names]], names=[*keys, *names])

        for batch in batches:
            schema = batch.schema
            for *g, data in zip(*(batch.column(k).to_pylist() for k in [*keys, "_acc"]), strict=True):
                if g == group:
                    acc = agg.merge(acc, agg.unpack(data))
                    continue
                if group is not None:
                    done.append((group, agg.result(acc)))
                group, acc = g, agg.unpack(data)
            if len(done) >= 10_000:
                yield sent()
        if group is not None:
            done.append((group, agg.result(acc)))
            yield sent()

    partial = df.select(*keys, *[c for c in inputs if c not in keys]).mapInArrow(fold, f"{kinds}, _acc BINARY")
    return partial.repartition(*[F.col(k) for k in keys]).sortWithinPartitions(*keys) \
        .mapInArrow(merge, f"{kinds}, {agg.output}")


def windowed_user_agg(df: DataFrame, ts: str, size: str | int, slide: str | int | None, keys: Sequence[str],
                      agg: UserAggregate, inputs: Sequence[str], held: int = 50_000) -> DataFrame:
    """``window_end, *keys`` and the columns of ``agg.output`` for every (window, keys)."""
    size_s = _seconds(size)
    slide_s = _seconds(slide) if slide is not None else size_s
    w = F.window(ts, _spec(size_s), _spec(slide_s)) if slide_s != size_s else F.window(ts, _spec(size_s))
    rows = df.withColumn("_w", w).select(F.col("_w").getField("end").alias("window_end"), *keys, *inputs)
    return user_agg(rows, ["window_end", *keys], agg, inputs, held)
