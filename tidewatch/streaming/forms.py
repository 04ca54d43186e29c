"""Streaming forms of the jobs.

* same plan, windowed aggregates: page views, marketing counts, ad clicks
  (high fan-out windows as a chain: pane counts, then windows over
  ``window_time`` of the panes, which append mode accepts);
* different plan with built-ins: top-N (closed windows ranked per batch in
  ``foreachBatch``), unique visitors (``dropDuplicates`` per window then
  count), failure bursts and reconciliation (``session_window``);
* keyed second stages in the same query (``tidewatch.streaming.keyed``): ranking, revisions,
  firings by row count, late rows;
* keyed processors (``tidewatch.streaming.processors``): click cap,
  consecutive failures, create-then-pay, order outcomes.

Input frames must carry a TIMESTAMP ``event_time`` with a watermark
(``tidewatch.streaming.wiring.event_time``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tidewatch.functions.hashing import bitmap_offset
from tidewatch.functions.messages import message
from tidewatch.operators.ranking import top_n_per_window, window_report
from tidewatch.operators.windows import _seconds, pane_seconds
from tidewatch.plans import jobs
from tidewatch.streaming import keyed as K, processors as P

TS = "event_time"

# In a stream both forms keep state per (window, key); the two-stage chain
# pays for its second state store only when a row would open many windows.
STREAM_PANE_FANOUT = 60


def windowed_count_stream(df: DataFrame, size: str | int, slide: str | int | None = None,
                          keys: Sequence[str] = (), name: str = "cnt",
                          revisions: bool = False) -> DataFrame:
    """``window_end, *keys, <name>`` in append mode (each window once, when
    the watermark closes it).  ``revisions``: for update mode, which allows one
    aggregate only, so every row opens its windows directly."""
    size_s = _seconds(size)
    slide_s = _seconds(slide) if slide is not None else size_s
    if not revisions and slide_s != size_s and size_s // slide_s >= STREAM_PANE_FANOUT:
        pane = (df.groupBy(F.window(TS, f"{pane_seconds(size_s, slide_s)} seconds").alias("_p"), *keys)
                .agg(F.count(F.lit(1)).alias("_n")))
        w = F.window(F.window_time("_p"), f"{size_s} seconds", f"{slide_s} seconds")
        out = pane.groupBy(w.alias("_w"), *keys).agg(F.sum("_n").cast("bigint").alias(name))
    else:
        w = (F.window(TS, f"{size_s} seconds", f"{slide_s} seconds") if slide_s != size_s
             else F.window(TS, f"{size_s} seconds"))
        out = df.groupBy(w.alias("_w"), *keys).agg(F.count(F.lit(1)).alias(name))
    return out.select(F.col("_w.end").alias("window_end"), *keys, name)


def top_n_writer(n: int, key: str, write: Callable[[DataFrame, int], None],
                 by: str = "cnt") -> Callable[[DataFrame, int], None]:
    """T-9: rank the windows a batch closes.  In append mode a window's
    counts all arrive in the batch that closes it, so ranking inside the
    batch equals ranking the whole window."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write(top_n_per_window(batch, n, key=key, by=by), batch_id)
    return each


def hot_items_counts_stream(behaviors: DataFrame, size: str = "1 hour", slide: str = "5 minutes",
                            behavior: str = "pv") -> DataFrame:
    """Q1 stream, first stage; rank with ``top_n_writer(3, 'item_id', ...)``."""
    return windowed_count_stream(behaviors.where(F.col("behavior") == behavior), size, slide,
                                 keys=["item_id"])


def hot_items_stream(behaviors: DataFrame, n: int = jobs.TOP_N, size: str = "1 hour", slide: str = "5 minutes",
                     behavior: str = "pv") -> DataFrame:
    """Q1 as one stream query for any append sink: the counts, then the ranking as keyed
    steps after them (``keyed.top_n_in_stream``)."""
    counts = windowed_count_stream(behaviors.where(F.col("behavior") == behavior), size, slide, keys=["item_id"])
    return K.top_n_in_stream(counts, n, "item_id")


def hot_urls_revised_stream(logs: DataFrame, n: int = jobs.TOP_N, size: str = "10 minutes", slide: str = "5 seconds",
                            exclude_static: bool = False) -> DataFrame:
    """Q2 with late revisions as one stream query: give ``logs`` a watermark of delay +
    allowed lateness; every window's ranking is sent out again when a row changes it."""
    if exclude_static:
        logs = logs.where(~F.col("url").rlike(jobs.STATIC_URL))
    return K.revised_top_n_in_stream(logs, n, "url", size, slide)


def hot_items_revised_stream(behaviors: DataFrame, n: int = jobs.TOP_N, size: str = "1 hour", slide: str = "5 minutes",
                             behavior: str = "pv") -> DataFrame:
    """Q1 with late revisions, as ``hot_urls_revised_stream``."""
    return K.revised_top_n_in_stream(behaviors.where(F.col("behavior") == behavior), n, "item_id", size, slide)


def unique_visitors_firing_stream(behaviors: DataFrame, size: str = "1 hour", behavior: str = "pv",
                                  every: int = 10_000) -> DataFrame:
    """Q5 with its early firings: ``window_end, uv, n_rows, firing, final``."""
    return K.running_distinct(behaviors.where(F.col("behavior") == behavior), "user_id", size, every)


def hot_urls_counts_stream(logs: DataFrame, size: str = "10 minutes", slide: str = "5 seconds",
                           exclude_static: bool = False, revisions: bool = False) -> DataFrame:
    """Q2 stream, first stage.  For the reference's late revisions (T-12) give
    the input a watermark of delay + lateness, set ``revisions`` and run in
    update mode into ``revised_top_n_writer``, which ranks every revised window
    again as a whole."""
    if exclude_static:
        logs = logs.where(~F.col("url").rlike(jobs.STATIC_URL))
    return windowed_count_stream(logs, size, slide, keys=["url"], revisions=revisions)


def revised_top_n(spark, changelog: str, n: int, key: str, by: str = "cnt") -> DataFrame:
    """T-12: top-N of every window from the newest revision of each
    (window, key) count in a change log written in update mode.  A late row
    revises its window's count and the window is ranked again as a whole
    (the reference re-ranks only the revised keys, SURVEY §2.11 row 18)."""
    from tidewatch.streaming.wiring import latest
    return top_n_per_window(latest(spark, changelog, ["window_end", key]), n, key=key, by=by)


def revised_top_n_writer(changelog: str, n: int, key: str,
                         write: Callable[[DataFrame, int], None], by: str = "cnt"
                         ) -> Callable[[DataFrame, int], None]:
    """T-12 in ``foreachBatch`` (update mode): put the batch's revised
    (window, key) counts into the change log, then rank again every window
    the batch touched, from the newest counts of all its keys, and hand the
    new top-N to ``write``.  Only the partitions of the touched days are read
    back, and of those only the touched windows.  Once the batches have left a day
    behind, the log of the days before is compacted to one row per key."""
    from tidewatch.streaming.wiring import changelog_writer, compact, latest
    append, closed = changelog_writer(changelog), [""]

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            append(batch, batch_id)
            touched = batch.select("window_end").distinct()
            days = [r.day for r in touched.select(F.date_format("window_end", "yyyy-MM-dd").alias("day"))
                    .distinct().collect()]                 # the open windows' days: one or two
            newest = latest(batch.sparkSession, changelog, ["window_end", key], days=days)
            revised = newest.join(touched, "window_end", "left_semi")
            write(top_n_per_window(revised, n, key=key, by=by), batch_id)
            if days and min(days) > closed[0]:
                compact(batch.sparkSession, changelog, ["window_end", key], before_day=min(days))
                closed[0] = min(days)
        finally:
            batch.unpersist()
    return each


def report_writer(n: int, key: str, label: str, write: Callable[[DataFrame, int], None],
                  by: str = "cnt") -> Callable[[DataFrame, int], None]:
    """R-4 from a stream: one text block per closed window."""
    def each(batch: DataFrame, batch_id: int) -> None:
        write(window_report(top_n_per_window(batch, n, key=key, by=by), key=key, label=label), batch_id)
    return each


def marketing_by_channel_stream(rows: DataFrame, size: str = "1 hour", slide: str = "10 seconds",
                                exclude: str = "UNINSTALL") -> DataFrame:
    """Q6 stream: ``window_end, channel, behavior, cnt``."""
    return windowed_count_stream(rows.where(F.col("behavior") != exclude), size, slide,
                                 keys=["channel", "behavior"])


def marketing_total_stream(rows: DataFrame, size: str = "1 hour", slide: str = "10 seconds",
                           exclude: str = "UNINSTALL") -> DataFrame:
    """Q7 stream: the window total; ``channel`` and ``behavior`` read 'total'."""
    out = windowed_count_stream(rows.where(F.col("behavior") != exclude), size, slide)
    return out.select("window_end", F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "cnt")


def unique_visitors_running_stream(behaviors: DataFrame, size: str = "1 hour",
                                   behavior: str = "pv") -> DataFrame:
    """T-14/T-15 (Q5's early firings): running exact bitmap counts per
    (window, 32768-bit chunk), for update mode into a change log;
    ``running_uv`` sums the newest chunk counts per window.  Every trigger
    thus revises the count of the open windows; the final value is the
    batch count."""
    rows = behaviors.where(F.col("behavior") == behavior)
    off = bitmap_offset("user_id")
    return (rows.groupBy(F.window(TS, f"{_seconds(size)} seconds").alias("_w"),
                         F.bitmap_bucket_number(off).alias("chunk"))
            .agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(off))).alias("bits"))
            .select(F.col("_w.end").alias("window_end"), "chunk", "bits"))


def running_uv(spark, changelog: str) -> DataFrame:
    """``window_end, uv`` from the newest chunk counts of a change log."""
    from tidewatch.streaming.wiring import latest
    return (latest(spark, changelog, ["window_end", "chunk"]).groupBy("window_end")
            .agg(F.sum("bits").cast("bigint").alias("uv")))


def unique_visitors_stream(behaviors: DataFrame, size: str = "1 hour", behavior: str = "pv",
                           method: str = "exact") -> DataFrame:
    """Q4/Q5 stream: ``window_end, uv``.  Exact and bitmap drop duplicate
    (window, visitor) pairs (state evicted by the watermark) and count;
    ``hll`` uses ``approx_count_distinct``."""
    rows = behaviors.where(F.col("behavior") == behavior)
    w = F.window(TS, f"{_seconds(size)} seconds")
    if method == "hll":
        out = rows.groupBy(w.alias("_w")).agg(F.approx_count_distinct("user_id").alias("uv"))
        return out.select(F.col("_w.end").alias("window_end"), "uv")
    target = F.col("user_id") if method == "exact" else bitmap_offset("user_id")
    firsts = rows.select(w.alias("_w"), target.alias("_v")).dropDuplicates(["_w", "_v"])
    out = firsts.groupBy("_w").agg(F.count(F.lit(1)).alias("uv"))
    return out.select(F.col("_w.end").alias("window_end"), "uv")


def login_fail_burst_stream(logins: DataFrame, gap: str | int = 2, min_count: int = 2,
                            fail: str = "fail") -> DataFrame:
    """Q10 stream: session windows of failures (a gap of exactly ``gap``
    still merges), kept with at least ``min_count`` failures."""
    gap_s = _seconds(gap)
    s = (logins.where(F.col("event_type") == fail)
         .groupBy("user_id", F.session_window(TS, f"{gap_s} seconds").alias("_s"))
         .agg(F.count(F.lit(1)).alias("fails"), F.min(TS).alias("start_time"),
              F.max(TS).alias("end_time")))
    return (s.where(F.col("fails") >= min_count)
            .select("user_id", "start_time", "end_time", "fails",
                    F.format_string(f"login fail %d times within {gap_s}s", "fails").alias("msg")))


def tx_reconcile_stream(orders: DataFrame, receipts: DataFrame, tolerance: str | int = 60,
                        retention: str | int = "1 day") -> DataFrame:
    """Q14 stream: payments against receipts on ``tx_id`` as one session aggregate.

    Both sides become one stream; a session of a ``tx_id`` holds its rows until none came
    for ``retention`` of event time.  The earliest payment and the earliest receipt of a
    session, whatever the arrival order, are compared when it closes: within the tolerance
    they are ``matched``, else each present side gives its one-sided row, as in the batch form.
    State is one row per open session; there is no join and no Python.  A smaller
    ``retention`` (at least the tolerance) reports sooner and remembers repeats for less long."""
    tol, keep = _seconds(tolerance), _seconds(retention)
    if keep < tol:
        raise ValueError("retention must cover the tolerance")
    pays = orders.where((F.col("event_type") == "pay") & (F.coalesce("tx_id", F.lit("")) != ""))
    none = {"order_id": F.lit(None).cast("bigint"), "pay_channel": F.lit(None).cast("string")}

    def side(df: DataFrame, is_pay: bool, **own) -> DataFrame:
        tb = _order(df)[1:]
        return df.select(TS, "tx_id", F.lit(is_pay).alias("_pay"),
                         (F.col(tb[0]).cast("bigint") if tb else F.lit(0).cast("bigint")).alias("_tb"),
                         *[F.col(c).alias(c) if c in own else v.alias(c) for c, v in none.items()])

    rows = side(pays, True, order_id=1).unionByName(side(receipts.where(F.col("tx_id").isNotNull()), False, pay_channel=1))
    first = F.struct(F.col(TS).alias("at"), "_tb", "order_id", "pay_channel")
    held = rows.groupBy("tx_id", F.session_window(TS, f"{keep} seconds").alias("_s")) \
        .agg(F.min(F.when(F.col("_pay"), first)).alias("_p"), F.min(F.when(~F.col("_pay"), first)).alias("_r"))
    near = F.abs(F.unix_micros("_p.at") - F.unix_micros("_r.at")) <= tol * 1_000_000
    p, r = (lambda c: F.col(f"_p.{c}")), (lambda c: F.col(f"_r.{c}"))

    def row(outcome: str, pay: bool, receipt: bool):
        empty = lambda kind: F.lit(None).cast(kind)
        return F.struct(*[x.alias(n) for n, x in (
            ("order_id", p("order_id") if pay else empty("bigint")), ("pay_time", p("at") if pay else empty("timestamp")),
            ("receipt_time", r("at") if receipt else empty("timestamp")),
            ("pay_channel", r("pay_channel") if receipt else empty("string")), ("outcome", F.lit(outcome)))])

    apart = F.filter(F.array(F.when(F.col("_p").isNotNull(), row("order_only", True, False)),
                             F.when(F.col("_r").isNotNull(), row("receipt_only", False, True))), lambda x: x.isNotNull())
    found = F.when(F.coalesce(near, F.lit(False)), F.array(row("matched", True, True))).otherwise(apart)
    return held.select("tx_id", F.explode(found).alias("_o")).select("tx_id", "_o.*") \
        .withColumn("msg", jobs._msg_of(F.col("outcome"), jobs.RECONCILE_MSG))


def _order(df: DataFrame) -> list[str]:
    return [TS, *[c for c in ("event_id", "seq") if c in df.columns][:1]]


def ad_click_cap_stream(clicks: DataFrame, n: int = 100) -> DataFrame:
    """Q9 stream: ``user_id, ad_id, event_time, province, outcome, msg``."""
    out = P.run_ordered(clicks, ["user_id", "ad_id"], P.ClickCap(n=n), _order(clicks),
                        kind=F.lit("click"), tag="province")
    day = F.date_from_unix_date(F.floor(F.unix_seconds("event_time") / 86400).cast("int"))
    msg = message(f"user %s clicked ad %s more than {n} times on %s", F.col("user_id").cast("string"),
                  F.col("ad_id").cast("string"), day.cast("string"))
    return out.select("user_id", "ad_id", "event_time", F.col("tb"), "province", "outcome",
                      F.when(F.col("outcome") == "warn", msg).alias("msg"))


def ad_clicks_after_cap_stream(clicks: DataFrame, n: int = 100, size: str = "1 hour",
                               slide: str = "5 seconds") -> DataFrame:
    """Q9 main output as one query: the cap processor, then the windowed
    province counts over passed clicks (event time carried through the
    processor, so the second stateful step closes windows by watermark)."""
    passed = ad_click_cap_stream(clicks, n).where(F.col("outcome") == "pass")
    return windowed_count_stream(passed, size, slide, keys=["province"])


def login_fail_consecutive_stream(logins: DataFrame, within: str | int = 2,
                                  fail: str = "fail") -> DataFrame:
    """Q11 stream: ``user_id, start_time, end_time, msg``."""
    w = _seconds(within) * 1_000_000
    out = P.run_ordered(logins, ["user_id"], P.ConsecutiveFailures(within_us=w, fail=fail),
                        _order(logins), kind="event_type")
    return out.select("user_id", P.us_to_ts("start_us").alias("start_time"),
                      P.us_to_ts("end_us").alias("end_time"),
                      F.lit(f"login fail 2 times within {_seconds(within)}s").alias("msg"))


def order_timeout_pattern_stream(orders: DataFrame, within: str | int = "9 minutes"
                                 ) -> DataFrame:
    """Q12 stream: ``order_id, create_time, pay_time, outcome, msg``."""
    w = _seconds(within) * 1_000_000
    out = P.run_ordered(orders, ["order_id"], P.CreateThenPay(within_us=w), _order(orders),
                        kind="event_type", tag="tx_id")
    return out.select("order_id", P.us_to_ts("create_us").alias("create_time"),
                      P.us_to_ts("pay_us").alias("pay_time"), "outcome",
                      F.when(F.col("outcome") == "paid", "order paid in time")
                      .otherwise("no payment in time").alias("msg"))


def order_outcomes_stream(orders: DataFrame, limit: str | int = "15 minutes",
                          retention: str | int = "1 day") -> DataFrame:
    """Q13 stream: ``order_id, create_time, pay_time, outcome, msg``.  Deadlines
    and rows interleave in event time.  A create-only order is ``unpaid`` at
    its deadline, and a pay after that deadline is ``pay_without_create``
    (the batch form, seeing the whole key, calls that pair ``paid_late``;
    SURVEY §2.11 row 8).  A pay at exactly the limit is ``paid_late`` in
    both forms.  A finished order is remembered for ``retention`` after its
    deadline, so that a late second pay is not taken for a new order, and then
    its state is cleared."""
    w = _seconds(limit) * 1_000_000
    out = P.run_ordered(orders, ["order_id"],
                        P.OrderOutcome(limit_us=w, retention_us=_seconds(retention) * 1_000_000),
                        _order(orders), kind="event_type")
    return out.select("order_id", P.us_to_ts("create_us").alias("create_time"),
                      P.us_to_ts("pay_us").alias("pay_time"), "outcome",
                      jobs._msg_of(F.col("outcome"), jobs.OUTCOME_MSG).alias("msg"))
