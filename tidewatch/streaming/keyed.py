"""Keyed second stages inside one stream query (T-3, T-9, T-12, T-14, T-15, X-12).

Each form here is a chain of stateful operators in append mode, without
``foreachBatch`` and without reading its own output back, so any sink takes it:

* ``top_n_in_stream``: windowed counts, the best N per window of every task, then the best
  N per window (T-9);
* ``revised_top_n_in_stream``: counts in map state per (window, bucket of keys), and
  the ranking of a window sent out again whenever it changes (T-3, T-12);
* ``split_late``: every row with the watermark that met it and whether it came too late (T-13);
* ``running_distinct``: bitmap chunks in map state per (window, bucket of visitors), and
  the window's running count sent out every ``every`` rows and at its end (T-14, T-15).

What comes before the stage per window is spread over buckets or tasks, so a window's keys
are never state of one key, and what reaches the window is at most ``n`` rows (or one) of
each of them per batch.  Windows are named by their end in microseconds.  All state of a window is
cleared by an event-time timer at its end, which by the watermark comes after its last row.
"""

from __future__ import annotations

import heapq
import sys as _sys
from collections import Counter
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

import pyarrow as pa
from pyspark import cloudpickle as _cloudpickle
from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewatch.functions.hashing import bitmap_offset
from tidewatch.operators.windows import _seconds
from tidewatch.streaming.wiring import use_rocksdb

# sent to the workers by value, as in ``processors``
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

TS = "event_time"
#: Bits of a chunk of the visitor bitmap.
CHUNK_BITS = 512


def _moment(us: int) -> datetime:
    """The last microsecond of the window that ends at ``us``: its rows' event time."""
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=us - 1)


class Keyed(StatefulProcessor):
    """A processor with parameters and one clean-up timer per window."""

    def __init__(self, **params):
        self.params = params

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle

    def ends(self, key: tuple) -> None:
        """Fire once the watermark has reached the end of the key's window."""
        self.handle.registerTimer(-(-key[0] // 1000))

    def close(self) -> None:
        pass


def _best(n: int, rows) -> list[tuple]:
    """The ``n`` best of (key, count): count descending, key ascending."""
    return heapq.nsmallest(n, rows, key=lambda r: (-r[1], r[0]))


def _limit_per_task(n: int, most: int = 100_000):
    """For ``mapInArrow`` over (window_us, k, cnt): each window's ``n`` best rows of a task.

    Holds at most ``n`` rows for each of ``most`` windows, then sends them on and begins anew."""

    def limit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        schema = None

        def sent() -> pa.RecordBatch:
            rows = [(w, k, c) for w, best in held.items() for k, c in _best(n, best)]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], schema.field(i).type) for i in range(3)], schema=schema)

        for batch in batches:
            schema = batch.schema
            for w, k, c in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                best = held.setdefault(w, [])
                best.append((k, c))
                if len(best) > 8 * n:
                    best[:] = _best(n, best)
            if len(held) > most:
                yield sent()
        if held:
            yield sent()

    return limit


class Best(Keyed):
    """The ``n`` best rows of a window, sent out when it ends.

    State: a list of at most ``n``; rows stream through it."""

    def init(self, handle):
        super().init(handle)
        self.best = handle.getListState("best", f"k {self.params['type']}, cnt BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.best.get()] if self.best.exists() else []

        def every():
            yield from held
            for r in rows:
                yield r.k, r.cnt

        self.best.put(_best(self.params["n"], every()))
        self.ends(key)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        self.best.clear()
        at = _moment(key[0])
        return iter([Row(window_us=key[0], k=k, cnt=c, rank=i + 1, event_time=at)
                     for i, (k, c) in enumerate(_best(self.params["n"], rows))])


class BucketCounts(Keyed):
    """Running counts of one bucket of keys in one window; its ``n`` best are sent out
    whenever they change.

    State: a map from key to count, and the list of the best.  Counts only grow, so the
    best are always among the former best and the keys of this batch."""

    def init(self, handle):
        super().init(handle)
        kind = self.params["type"]
        self.counts = handle.getMapState("counts", f"k {kind}", "cnt BIGINT")
        self.best = handle.getListState("best", f"k {kind}, cnt BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        seen = self.best.exists()                          # else nothing is in the map either
        held = [tuple(r) for r in self.best.get()] if seen else []
        new = {}
        for k, n in Counter(r.k for r in rows).items():
            before = self.counts.getValue((k,)) if seen and self.counts.containsKey((k,)) else None
            new[k] = n + (before[0] if before else 0)
            self.counts.updateValue((k,), (new[k],))
        best = _best(self.params["n"], {**dict(held), **new}.items())
        self.ends(key)
        if best == held:
            return iter([])
        self.best.put(best)
        at = _moment(key[0])
        return iter([Row(window_us=key[0], bucket=key[1], k=k, cnt=c, rank=i + 1, event_time=at)
                     for i, (k, c) in enumerate(best)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.counts.clear()
        self.best.clear()
        return iter([])


class RevisedTop(Keyed):
    """The ``n`` best of a window over its buckets, sent out again with the next revision
    number whenever they change.

    A key that left its bucket's best has ``n`` better ones there, which all come in with
    the change, so the former best and what comes in hold the new best."""

    def init(self, handle):
        super().init(handle)
        self.best = handle.getListState("best", f"k {self.params['type']}, cnt BIGINT")
        self.revision = handle.getValueState("revision", "n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = [tuple(r) for r in self.best.get()] if self.best.exists() else []
        now = dict(held)
        for r in rows:
            now[r.k] = max(r.cnt, now.get(r.k, 0))
        best = _best(self.params["n"], now.items())
        self.ends(key)
        if best == held:
            return iter([])
        self.best.put(best)
        n = 1 + (self.revision.get()[0] if self.revision.exists() else 0)
        self.revision.update((n,))
        at = _moment(key[0])
        return iter([Row(window_us=key[0], k=k, cnt=c, rank=i + 1, revision=n, event_time=at)
                     for i, (k, c) in enumerate(best)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.best.clear()
        self.revision.clear()
        return iter([])


class VisitorBits(Keyed):
    """The bitmap of one bucket of visitors in one window: the running number of its bits
    and rows is sent out once per batch.

    State: a map from chunk number to ``CHUNK_BITS`` bits, and the two numbers."""

    def init(self, handle):
        super().init(handle)
        self.chunks = handle.getMapState("chunks", "chunk BIGINT", "bits BINARY")
        self.sums = handle.getValueState("sums", "bits BIGINT, n BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        by_chunk: dict[int, set[int]] = {}
        seen = 0
        for r in rows:
            seen += 1
            if r.off is not None:
                by_chunk.setdefault(r.off // CHUNK_BITS, set()).add(r.off % CHUNK_BITS)
        known = self.sums.exists()                         # else there is no chunk either
        bits, n = self.sums.get() if known else (0, 0)
        for chunk, places in by_chunk.items():
            held = known and self.chunks.containsKey((chunk,))
            old = int.from_bytes(self.chunks.getValue((chunk,))[0], "little") if held else 0
            new = old
            for p in places:
                new |= 1 << p
            if new != old:
                bits += new.bit_count() - old.bit_count()
                self.chunks.updateValue((chunk,), (new.to_bytes(CHUNK_BITS // 8, "little"),))
        self.sums.update((bits, n + seen))
        self.ends(key)
        return iter([Row(window_us=key[0], bucket=key[1], bits=bits, n=n + seen, event_time=_moment(key[0]))])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.chunks.clear()
        self.sums.clear()
        return iter([])


class Watermarked(Keyed):
    """Every row, with the watermark of its batch and whether the row lies before it.

    No state.  The event time comes in as a number, which Spark does not take for the event
    time, so late rows are not dropped before they get here."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        at = timerValues.getCurrentWatermarkInMs() * 1000
        for r in rows:
            own = r.asDict()
            del own["_bucket"]
            yield Row(**own, late=r.ts_us is not None and r.ts_us < at, watermark_us=at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return iter([])


class RunningTotal(Keyed):
    """The sum of a window's buckets, sent out when ``every`` or more rows came since it was
    sent last, and at the window's end as its final value."""

    def init(self, handle):
        super().init(handle)
        self.parts = handle.getMapState("parts", "bucket INT", "bits BIGINT, n BIGINT")
        self.sent = handle.getValueState("sent", "n BIGINT, firing BIGINT")

    def _row(self, key, bits, n, firing, final):
        return Row(window_us=key[0], uv=bits, n_rows=n, firing=firing, final=final, event_time=_moment(key[0]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest: dict[int, tuple[int, int]] = {}
        for r in rows:                                     # counts only grow
            newest[r.bucket] = max((r.bits, r.n), newest.get(r.bucket, (0, 0)))
        for bucket, v in newest.items():
            self.parts.updateValue((bucket,), v)
        self.ends(key)
        totals = [tuple(v) for v in self.parts.values()]
        bits, n = sum(v[0] for v in totals), sum(v[1] for v in totals)
        before, firing = self.sent.get() if self.sent.exists() else (0, 0)
        if n - before < self.params["every"]:
            return iter([])
        self.sent.update((n, firing + 1))
        return iter([self._row(key, bits, n, firing + 1, False)])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        totals = [tuple(v) for v in self.parts.values()]
        _, firing = self.sent.get() if self.sent.exists() else (0, 0)
        self.parts.clear()
        self.sent.clear()
        return iter([self._row(key, sum(v[0] for v in totals), sum(v[1] for v in totals), firing + 1, True)]
                    if totals else [])


def _step(df: DataFrame, keys: list[str], processor: Keyed, output: str) -> DataFrame:
    use_rocksdb(df.sparkSession)
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor, outputStructType=output, outputMode="Append", timeMode="EventTime",
        eventTimeColumnName=TS)


def _window_end(us: str = "window_us") -> Column:
    return F.timestamp_micros(us).alias("window_end")


def _kind(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def top_n_in_stream(counts: DataFrame, n: int, key: str, by: str = "cnt") -> DataFrame:
    """T-9: ``window_end, key, <by>, rank`` of the counts of closed windows
    (``windowed_count_stream`` in append mode)."""
    kind = _kind(counts, key)
    rows = counts.select(F.unix_micros("window_end").alias("window_us"), F.col(key).alias("k"),
                         F.col(by).cast("bigint").alias("cnt"))
    few = rows.mapInArrow(_limit_per_task(n), f"window_us BIGINT, k {kind}, cnt BIGINT")
    top = _step(few, ["window_us"], Best(n=n, type=kind),
                f"window_us BIGINT, k {kind}, cnt BIGINT, rank INT, event_time TIMESTAMP")
    return top.select(_window_end(), F.col("k").alias(key), F.col("cnt").alias(by), F.col("rank").cast("bigint").alias("rank"))


def _windows(rows: DataFrame, size: str | int, slide: str | int | None) -> tuple[DataFrame, Column]:
    size_s = _seconds(size)
    slide_s = _seconds(slide) if slide is not None else size_s
    w = F.window(TS, f"{size_s} seconds", f"{slide_s} seconds") if slide_s != size_s else F.window(TS, f"{size_s} seconds")
    return rows.withColumn("_w", w), F.unix_micros("_w.end").alias("window_us")


def revised_top_n_in_stream(rows: DataFrame, n: int, key: str, size: str | int, slide: str | int | None = None,
                            buckets: int = 4) -> DataFrame:
    """T-3/T-12: ``window_end, key, cnt, rank, revision``: the ``n`` most frequent keys of every
    window, sent out again as a whole whenever they change.  The newest revision of a window
    is its final ranking once the watermark (delay and allowed lateness) has passed its end."""
    kind = _kind(rows, key)
    opened, end = _windows(rows, size, slide)
    prepared = opened.select(end, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket"),
                             F.col(key).alias("k"), F.col(TS))
    shape = f"k {kind}, cnt BIGINT, rank INT"
    first = _step(prepared, ["window_us", "bucket"], BucketCounts(n=n, type=kind),
                  f"window_us BIGINT, bucket INT, {shape}, event_time TIMESTAMP")
    top = _step(first, ["window_us"], RevisedTop(n=n, type=kind),
                f"window_us BIGINT, {shape}, revision BIGINT, event_time TIMESTAMP")
    return top.select(_window_end(), F.col("k").alias(key), "cnt", F.col("rank").cast("bigint").alias("rank"), "revision")


def newest_revision(found: DataFrame) -> DataFrame:
    """The rows of every window's last revision (a table of ``revised_top_n_in_stream``)."""
    last = found.groupBy("window_end").agg(F.max("revision").alias("revision"))
    return found.join(last, ["window_end", "revision"], "left_semi")


def running_distinct(rows: DataFrame, col: str = "user_id", size: str | int = "1 hour", every: int = 10_000,
                     buckets: int = 8) -> DataFrame:
    """T-14/T-15: ``window_end, uv, n_rows, firing, final``: the distinct visitors (bits of the
    hashed bitmap, A-5) of every window after ``n_rows`` of its rows.

    A window fires at the end of the micro-batch in which the rows since its last firing
    reach ``every``, and once more, as final, when the watermark passes its end."""
    opened, end = _windows(rows, size, None)
    off = bitmap_offset(col)
    prepared = opened.select(end, F.pmod(F.xxhash64(off), F.lit(buckets)).cast("int").alias("bucket"), off.alias("off"),
                             F.col(TS))
    first = _step(prepared, ["window_us", "bucket"], VisitorBits(),
                  "window_us BIGINT, bucket INT, bits BIGINT, n BIGINT, event_time TIMESTAMP")
    total = _step(first, ["window_us"], RunningTotal(every=every),
                  "window_us BIGINT, uv BIGINT, n_rows BIGINT, firing BIGINT, final BOOLEAN, event_time TIMESTAMP")
    return total.select(_window_end(), "uv", "n_rows", "firing", "final")


def split_late(rows: DataFrame, buckets: int = 64) -> DataFrame:
    """T-13: the rows of a watermarked stream and ``late``, ``watermark``: a row is late if its
    event time is before the watermark of the batch it comes in, which the rows before that
    batch have set.  With ``wiring.tagged_writer(base, "late")`` late rows are a table of their
    own instead of being dropped, and what is kept and what is late is all of the input.

    Spark's own late filter goes by the watermark of the batch before, so all that a stateful
    step in this place would drop is among the late rows."""
    use_rocksdb(rows.sparkSession)
    rest = [c for c in rows.columns if c != TS]
    prepared = rows.select(F.unix_micros(TS).alias("ts_us"), *rest,
                           F.pmod(F.xxhash64(*rows.columns), F.lit(buckets)).cast("int").alias("_bucket"))
    kinds = ", ".join(f"`{c}` {prepared.schema[c].dataType.simpleString()}" for c in ["ts_us", *rest])
    out = prepared.groupBy("_bucket").transformWithState(
        statefulProcessor=Watermarked(), outputStructType=f"{kinds}, late BOOLEAN, watermark_us BIGINT",
        outputMode="Append", timeMode="EventTime")
    return out.select(*[F.timestamp_micros("ts_us").alias(TS) if c == TS else F.col(c) for c in rows.columns], "late",
                      F.timestamp_micros("watermark_us").alias("watermark"))


def stored_keys(spark, checkpoint: str, variables: set[str]) -> dict[str, set[int]]:
    """T-16: the windows (end in microseconds) that the named state variables of a stopped
    query still hold, read from its state store."""
    meta = spark.read.format("state-metadata").load(checkpoint)
    operators = [r.operatorId for r in meta.select("operatorId").distinct().collect()]
    found: dict[str, set[int]] = {}
    for operator in operators:
        for name in sorted(variables):
            try:
                state = spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator) \
                    .option("stateVarName", name).load()
                found[name] = {r.w for r in state.select(F.col("key.window_us").alias("w")).distinct().collect()}
            except Exception as missing:  # noqa: BLE001  another operator's variable
                if "STDS" not in str(missing) and "state variable" not in str(missing).lower():
                    raise
    return found
