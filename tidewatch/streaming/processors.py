"""Keyed stateful processors for the order-dependent jobs (T-1 .. T-6, T-16).

Micro-batches do not deliver a key's rows sorted.  Every processor here
therefore buffers a key's rows in list state and registers an event-time
timer; once the watermark has passed a row (no earlier row of the key can
still arrive: later ones are dropped as late) the ready rows are taken in
(event time, tie-break) order and stepped through a small per-key state.
The stream result thus does not depend on how rows were split into batches.
The event time of the buffer's first row is kept beside it, so the buffer is read once per
step of the watermark that makes a row ready, and not for the timers of the job itself.

Input rows carry ``ts_us`` (event time in microseconds, the precision of a
Spark timestamp) and ``tb`` (tie-break); ``kind`` and ``tag`` carry the
job's own fields.  Timers and the watermark are in milliseconds: a row is
ready once the watermark has reached it.  Use ``run_ordered`` to attach the
columns and to start the processor.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewatch.streaming.wiring import use_rocksdb

# Processors are sent to Python workers by value: the stream's workers (on
# the driver and on executors) then need no copy of this package installed.
import sys as _sys  # noqa: E402

from pyspark import cloudpickle as _cloudpickle  # noqa: E402

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

BUFFER = StructType([StructField("ts_us", LongType()), StructField("tb", LongType()),
                     StructField("kind", StringType()), StructField("tag", StringType())])
DAY_US = 86_400_000_000


class OrderedProcessor(StatefulProcessor):
    """Buffer, wait for the watermark, then ``step`` rows in time order."""

    STATE = StructType([StructField("a", LongType()), StructField("b", LongType()),
                        StructField("c", StringType())])

    def __init__(self, **params):
        self.params = params

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buffer", BUFFER)
        self.due = handle.getValueState("due", "ts_us BIGINT")   # event time of the buffer's first row
        self.state = handle.getValueState("state", self.STATE)

    # -- subclass hooks -----------------------------------------------------
    def step(self, key: tuple, st: list, row: Row) -> list[Row]:
        raise NotImplementedError

    def on_watermark(self, key: tuple, st: list, wm: int) -> list[Row]:
        """Called after the ready rows; emit time-outs, request timers."""
        return []

    def before(self, key: tuple, st: list, ts_us: int) -> list[Row]:
        """Called before each ready row: expire what ended strictly earlier,
        so time-outs and rows interleave in event time, not by batch."""
        return []

    # -- engine -------------------------------------------------------------
    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(r.ts_us, r.tb, r.kind, r.tag) for r in rows]
        kept = self.prune(new, None)
        if kept is new:                                    # every row counts: append
            if new:
                self.buf.appendList(new)
                self.wait_for(min(t for t, *_ in new))
        elif kept:
            held = [tuple(r) for r in self.buf.get()] if self.buf.exists() else []
            self.buf.put(self.prune(held + kept, held))
            self.wait_for(min(t for t, *_ in kept))
        return iter([])

    def wait_for(self, ts_us: int) -> None:
        """Note the buffer's first row; only a row before it needs a timer of its own."""
        due = self.due.get()[0] if self.due.exists() else None
        if due is None or ts_us < due:
            self.due.update((ts_us,))
            self.timer_at(ts_us)

    def prune(self, rows: list, held: list | None) -> list:
        """Rows of a key that can still matter; the list itself when all do."""
        return rows

    def cancel_at(self, ts_us: int) -> None:
        """Take back a timer that is no longer needed."""
        self.handle.deleteTimer(-(-ts_us // 1000))

    def timer_at(self, ts_us: int) -> None:
        """Fire once the watermark (ms) has reached ``ts_us``."""
        self.handle.registerTimer(-(-ts_us // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = max(timerValues.getCurrentWatermarkInMs(),
                 expiredTimerInfo.getExpiryTimeInMs()) * 1000
        due, ready = (self.due.get()[0] if self.due.exists() else None), []
        if due is not None and due <= wm:                  # else nothing in the buffer is ready: it is not read
            rows = list(self.buf.get())
            ready = sorted((r for r in rows if r[0] <= wm), key=lambda r: (r[0], r[1]))
            rest = [r for r in rows if r[0] > wm]
            if rest:
                due = min(r[0] for r in rest)
                self.buf.put(rest)
                self.due.update((due,))
            else:
                due = None
                self.buf.clear()
                self.due.clear()
        st = list(self.state.get()) if self.state.exists() else [None, None, None]
        out: list[Row] = []
        for r in ready:
            out.extend(self.before(key, st, r[0]))
            out.extend(self.step(key, st, Row(ts_us=r[0], tb=r[1], kind=r[2], tag=r[3])))
        out.extend(self.on_watermark(key, st, wm))
        if due is not None:                                # last, so that no step has taken it back
            self.timer_at(due)
        if st == [None, None, None]:
            self.state.clear()
        else:
            self.state.update(tuple(st))
        return iter(out)

    def close(self) -> None:
        pass


def _day(us: int) -> int:
    return us // DAY_US


class ConsecutiveFailures(OrderedProcessor):
    """Q11: a failure whose next event of the key is a failure less than
    ``within_us`` later.  State: previous event time and kind."""

    OUTPUT = "user_id BIGINT, start_us BIGINT, end_us BIGINT"

    def step(self, key, st, row):
        out = []
        prev_us, _, prev_kind = st
        fail = self.params.get("fail", "fail")
        if prev_kind == fail and row.kind == fail and row.ts_us - prev_us < self.params["within_us"]:
            out.append(Row(user_id=key[0], start_us=prev_us, end_us=row.ts_us))
        st[0], st[2] = row.ts_us, row.kind
        return out

    def on_watermark(self, key, st, wm):
        # the last event can no longer start a pair once the limit has passed
        if st[0] is not None and st[0] + self.params["within_us"] <= wm:
            st[0] = st[1] = st[2] = None
        elif st[0] is not None:
            self.timer_at(st[0] + self.params["within_us"])
        return []


class ClickCap(OrderedProcessor):
    """Q9: first ``n`` clicks of a key per UTC day pass, the next one warns,
    the rest are dropped.  Of each day only the first ``n + 1`` buffered clicks
    are kept, and none once the day's warning is out, so a key's buffer is
    bounded however hot it is.  State: day and count; cleared at midnight (T-5,
    on event time).  Rows keep their event time (``event_time``), so a
    windowed count can follow in the same query."""

    OUTPUT = ("user_id BIGINT, ad_id STRING, ts_us BIGINT, tb BIGINT, province STRING, "
              "outcome STRING, event_time TIMESTAMP")
    EVENT_TIME = "event_time"

    def prune(self, rows, held):
        n = self.params["n"]
        st = self.state.get() if self.state.exists() else None
        by_day: dict[int, list] = {}
        for r in rows:
            if not (st and st[0] == _day(r[0]) and st[1] > n):
                by_day.setdefault(_day(r[0]), []).append(r)
        return [r for d in by_day.values() for r in sorted(d, key=lambda r: (r[0], r[1]))[:n + 1]]

    def _out(self, key, row, outcome):
        return Row(user_id=key[0], ad_id=str(key[1]), ts_us=row.ts_us, tb=row.tb,
                   province=row.tag, outcome=outcome,
                   event_time=datetime.fromtimestamp(row.ts_us // 1_000_000, tz=timezone.utc)
                   .replace(microsecond=row.ts_us % 1_000_000))

    def step(self, key, st, row):
        day = _day(row.ts_us)
        if st[0] != day:
            st[0], st[1] = day, 0
        st[1] += 1
        n = self.params["n"]
        if st[1] <= n:
            return [self._out(key, row, "pass")]
        if st[1] == n + 1:
            return [self._out(key, row, "warn")]
        return []

    def on_watermark(self, key, st, wm):
        if st[0] is not None:
            midnight = (st[0] + 1) * DAY_US
            if midnight <= wm:
                st[0] = st[1] = st[2] = None
            else:
                self.timer_at(midnight)
        return []


class CreateThenPay(OrderedProcessor):
    """Q12: each create is matched by the first later pay (with a
    transaction id) less than ``within_us`` after it, else times out.
    State: list of pending create times, in order; a matched create's timer is
    taken back."""

    OUTPUT = "order_id BIGINT, create_us BIGINT, pay_us BIGINT, outcome STRING"
    PENDING = StructType([StructField("create_us", LongType())])

    def init(self, handle):
        super().init(handle)
        self.pending = handle.getListState("pending", self.PENDING)

    def _row(self, key, create_us, pay_us):
        return Row(order_id=key[0], create_us=create_us, pay_us=pay_us,
                   outcome="paid" if pay_us is not None else "timeout")

    def step(self, key, st, row):
        within, out = self.params["within_us"], []
        if row.kind == "pay" and row.tag:
            for (c,) in (self.pending.get() if self.pending.exists() else ()):
                out.append(self._row(key, c, row.ts_us if row.ts_us - c < within else None))
                self.cancel_at(c + within)
            self.pending.clear()
        elif row.kind == "create":
            self.pending.appendValue((row.ts_us,))
            self.timer_at(row.ts_us + within)
        return out

    def on_watermark(self, key, st, wm):
        within = self.params["within_us"]
        times = [c for (c,) in self.pending.get()] if self.pending.exists() else []
        over = [c for c in times if c + within <= wm]
        if over:
            rest = [(c,) for c in times if c + within > wm]
            self.pending.put(rest) if rest else self.pending.clear()
        return [self._row(key, c, None) for c in over]


class OrderOutcome(OrderedProcessor):
    """Q13: first create and first pay of an order in either order.  Both
    seen -> ``paid`` / ``paid_late``; the deadline (``limit_us`` after the
    first of them) passes with one side only -> ``unpaid`` or
    ``pay_without_create``.  A pay arriving after its order was reported
    ``unpaid`` is reported ``pay_without_create`` (SURVEY §2.11 row 8; the
    batch form, which sees the whole key, calls that pair ``paid_late``).
    State: create time, pay time, phase (None, ``unpaid`` or ``done``); cleared
    ``retention_us`` after the deadline."""

    OUTPUT = "order_id BIGINT, create_us BIGINT, pay_us BIGINT, outcome STRING"

    def step(self, key, st, row):
        if st[2] == "done":
            return []
        if st[2] == "unpaid":
            if row.kind == "pay":
                st[2] = "done"
                return [Row(order_id=key[0], create_us=None, pay_us=row.ts_us,
                            outcome="pay_without_create")]
            return []
        if row.kind == "create" and st[0] is None:
            st[0] = row.ts_us
        elif row.kind == "pay" and st[1] is None:
            st[1] = row.ts_us
        if st[0] is not None and st[1] is not None:
            d = st[1] - st[0]
            outcome = "paid" if 0 <= d < self.params["limit_us"] else "paid_late"
            st[2] = "done"
            return [Row(order_id=key[0], create_us=st[0], pay_us=st[1], outcome=outcome)]
        return []

    def before(self, key, st, ts_us):
        if st[2] is None and (st[0] is not None or st[1] is not None):
            first = st[0] if st[0] is not None else st[1]
            if first + self.params["limit_us"] < ts_us:
                return self.on_watermark(key, st, ts_us - 1)
        return []

    def on_watermark(self, key, st, wm):
        if st[0] is None and st[1] is None:
            return []
        first = min(t for t in st[:2] if t is not None)
        deadline = first + self.params["limit_us"]
        forget = deadline + self.params.get("retention_us", DAY_US)
        if st[2] is not None:                              # finished: remembered for a while
            if forget <= wm:
                st[0] = st[1] = st[2] = None
            else:
                self.timer_at(forget)
            return []
        if deadline <= wm:
            self.timer_at(forget)
            if st[0] is not None:
                st[2] = "unpaid"
                return [Row(order_id=key[0], create_us=st[0], pay_us=None, outcome="unpaid")]
            st[2] = "done"
            return [Row(order_id=key[0], create_us=None, pay_us=st[1],
                        outcome="pay_without_create")]
        self.timer_at(deadline)
        return []


def run_ordered(df: DataFrame, keys: list[str], processor: OrderedProcessor,
                order: list[str], kind: Column | str, tag: Column | str | None = None
                ) -> DataFrame:
    """Attach ``ts_us``/``tb``/``kind``/``tag`` and apply ``processor`` per key
    (``transformWithState``, event-time timers, append mode)."""
    use_rocksdb(df.sparkSession)
    ts, tb = order[0], (order[1] if len(order) > 1 else None)
    prepared = df.select(
        *keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("ts_us"),
        (F.col(tb).cast("bigint") if tb else F.lit(0).cast("bigint")).alias("tb"),
        (F.col(kind) if isinstance(kind, str) else kind).cast("string").alias("kind"),
        (F.col(tag) if isinstance(tag, str) else (tag if tag is not None else F.lit(None)))
        .cast("string").alias("tag"))
    extra = {}
    if getattr(processor, "EVENT_TIME", None):
        extra["eventTimeColumnName"] = processor.EVENT_TIME
    return (prepared.groupBy(*keys)
            .transformWithState(statefulProcessor=processor,
                                outputStructType=processor.OUTPUT,
                                outputMode="Append", timeMode="EventTime", **extra))


def us_to_ts(col: str) -> Column:
    return F.timestamp_micros(F.col(col))
