"""The fourteen jobs (Q1 .. Q14) as DataFrame functions over record frames.

Each takes a typed frame (see ``tidewatch.sources.decode`` for the record
types; ``event_time`` is the event time) and returns the result frame.  The
functions are plain transformations: the same call serves a file read and,
where Structured Streaming accepts the plan, a stream
(``tidewatch.streaming`` has the other stream forms).

Rows with equal event time are ordered by a tie-break column when the frame
has one (``event_id`` for the test tables, ``seq`` for text sources).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.messages import message
from tidewatch.operators.interval_top import interval_top_n
from tidewatch.operators.limits import cap_per_key
from tidewatch.operators.ranking import top_n_per_window, window_report
from tidewatch.operators.reconcile import first_pair_outcomes, interval_match
from tidewatch.operators.sequences import bursts, followed_by, strict_pairs
from tidewatch.operators.windows import (
    _seconds, windowed_count, windowed_count_sets, windowed_distinct,
)

TS = "event_time"
TIEBREAKS = ("event_id", "seq")

# Fixed values taken from the reference jobs: top 3; hot items over 1 h
# sliding 5 min; hot URLs over 10 min sliding 5 s; page views and unique
# visitors per 1 h; marketing over 1 h sliding 10 s without UNINSTALL; ad
# clicks over 1 h sliding 5 s; 100 clicks per user and ad per day; 2 failed
# logins within 2 s; pay within 9 min (pattern) and 15 min (state); receipt
# within 60 s.
TOP_N = 3
# From this many windows per row on, top-N ranks intervals of windows, not every window.
INTERVAL_FANOUT = 60
STATIC_URL = r"\.(css|js|ico|png)$"


def order_of(df: DataFrame, ts: str = TS) -> list[str]:
    """Event time, then the first tie-break column the frame carries."""
    return [ts, *[c for c in TIEBREAKS if c in df.columns][:1]]


# --- Q1 / Q2: windowed top-N -------------------------------------------------

def hot_items(behaviors: DataFrame, n: int = TOP_N, size: str = "1 hour",
              slide: str = "5 minutes", behavior: str = "pv") -> DataFrame:
    """Q1: every ``slide``, the ``n`` items with most ``behavior`` rows in the
    last ``size`` -> ``window_end, item_id, cnt, rank``."""
    counts = windowed_count(behaviors.where(F.col("behavior") == behavior), TS, size, slide,
                            keys=["item_id"])
    return top_n_per_window(counts, n, key="item_id")


def hot_urls(logs: DataFrame, n: int = TOP_N, size: str = "10 minutes",
             slide: str = "5 seconds", exclude_static: bool = False) -> DataFrame:
    """Q2: every ``slide``, the ``n`` most requested URLs of the last ``size``
    -> ``window_end, url, cnt, rank``.  ``exclude_static`` applies the
    reference's (disabled) filter of css/js/ico/png resources (F-5)."""
    if exclude_static:
        logs = logs.where(~F.col("url").rlike(STATIC_URL))
    if _seconds(size) // _seconds(slide) >= INTERVAL_FANOUT:
        return interval_top_n(logs, TS, size, slide, "url", n)
    counts = windowed_count(logs, TS, size, slide, keys=["url"])
    return top_n_per_window(counts, n, key="url")


def hot_items_report(behaviors: DataFrame, **kw) -> DataFrame:
    """R-4: Q1 as one text block per window."""
    return window_report(hot_items(behaviors, **kw), key="item_id", label="item")


def hot_urls_report(logs: DataFrame, **kw) -> DataFrame:
    """R-4: Q2 as one text block per window."""
    return window_report(hot_urls(logs, **kw), key="url", label="url")


# --- Q3 .. Q5: page views and unique visitors ---------------------------------

def page_views(behaviors: DataFrame, size: str = "1 hour", behavior: str = "pv") -> DataFrame:
    """Q3: ``window_end, pv`` (the reference prints a bare count; the window
    is added, and the count is BIGINT)."""
    return windowed_count(behaviors.where(F.col("behavior") == behavior), TS, size, name="pv")


def unique_visitors(behaviors: DataFrame, size: str = "1 hour", behavior: str = "pv",
                    method: str = "exact") -> DataFrame:
    """Q4 (exact), Q5 (``method='bitmap'``, the reference's hashed bitmap)
    and the sketch form (``'hll'``) -> ``window_end, uv``."""
    return windowed_distinct(behaviors.where(F.col("behavior") == behavior), TS, size,
                             col="user_id", name="uv", method=method)


# --- Q6 / Q7: marketing counts -----------------------------------------------

def marketing_by_channel(rows: DataFrame, size: str = "1 hour", slide: str = "10 seconds",
                         exclude: str = "UNINSTALL") -> DataFrame:
    """Q6: ``window_end, channel, behavior, cnt`` without ``exclude``."""
    return windowed_count(rows.where(F.col("behavior") != exclude), TS, size, slide,
                          keys=["channel", "behavior"])


def marketing_total(rows: DataFrame, size: str = "1 hour", slide: str = "10 seconds",
                    exclude: str = "UNINSTALL") -> DataFrame:
    """Q7: the window total; ``channel`` and ``behavior`` both read 'total'."""
    counts = windowed_count(rows.where(F.col("behavior") != exclude), TS, size, slide)
    return counts.select("window_end", F.lit("total").alias("channel"),
                         F.lit("total").alias("behavior"), "cnt")


def marketing_rollup(rows: DataFrame, size: str = "1 hour", slide: str = "10 seconds",
                     exclude: str = "UNINSTALL") -> DataFrame:
    """Q6 and Q7 in one read: grouping sets over pane counts."""
    return windowed_count_sets(rows.where(F.col("behavior") != exclude), TS, size, slide,
                               keys=["channel", "behavior"])


# --- Q8 / Q9: ad clicks -------------------------------------------------------

def ad_clicks_by_province(clicks: DataFrame, size: str = "1 hour",
                          slide: str = "5 seconds", province: str = "province") -> DataFrame:
    """Q8: ``window_end, province, cnt`` (or the column that names the province)."""
    return windowed_count(clicks, TS, size, slide, keys=[province])


def ad_click_cap(clicks: DataFrame, n: int = 100, keys: tuple[str, ...] = ("user_id", "ad_id")
                 ) -> DataFrame:
    """Q9 first stage: clicks tagged ``pass`` (first ``n`` of a key's UTC
    day) or ``warn`` (the ``n + 1``-th, one per key and day); the rest are
    dropped.  ``msg`` is set on warnings."""
    capped = cap_per_key(clicks, list(keys), n, order_of(clicks))
    msg = message(f"user %s clicked ad %s more than {n} times on %s",
                  F.col(keys[0]).cast("string"), F.col(keys[1]).cast("string"),
                  F.col("day").cast("string"))
    return capped.withColumn("msg", F.when(F.col("outcome") == "warn", msg))


def ad_click_warnings(clicks: DataFrame, n: int = 100,
                      keys: tuple[str, ...] = ("user_id", "ad_id")) -> DataFrame:
    """Q9 side output: ``*keys, day, msg``, one per offending key and day."""
    return (ad_click_cap(clicks, n, keys).where(F.col("outcome") == "warn")
            .select(*keys, "day", "msg"))


def ad_clicks_after_cap(clicks: DataFrame, n: int = 100, size: str = "1 hour",
                        slide: str = "5 seconds", province: str = "province",
                        keys: tuple[str, ...] = ("user_id", "ad_id")) -> DataFrame:
    """Q9 main output: Q8 over the clicks that passed the cap."""
    passed = ad_click_cap(clicks, n, keys).where(F.col("outcome") == "pass")
    return ad_clicks_by_province(passed, size, slide, province)


# --- Q10 / Q11: failed logins --------------------------------------------------

def login_fail_burst(logins: DataFrame, gap: str | int = 2, min_count: int = 2,
                     fail: str = "fail") -> DataFrame:
    """Q10: failures of a user with no gap above ``gap`` seconds between them
    (successes in between ignored), at least ``min_count`` of them
    -> ``user_id, start_time, end_time, fails, msg``.  Each burst once."""
    gap_s = _seconds(gap)
    b = bursts(logins.where(F.col("event_type") == fail), ["user_id"], order_of(logins),
               gap_s, min_count)
    return b.select("user_id", "start_time", "end_time", F.col("n").alias("fails"),
                    message(f"login fail %d times within {gap_s}s", "n").alias("msg"))


def login_fail_consecutive(logins: DataFrame, within: str | int = 2, fail: str = "fail",
                           keyed: bool = True) -> DataFrame:
    """Q11: a failure directly followed (next event of the user) by another
    less than ``within`` seconds later -> ``user_id, start_time, end_time,
    msg``.  ``keyed=False`` matches across users, as the reference's pattern
    literally does."""
    w = _seconds(within)
    is_fail = F.col("event_type") == fail
    keys = ["user_id"] if keyed else []
    carry = [] if keyed else ["user_id"]
    p = strict_pairs(logins, keys, order_of(logins), is_fail, is_fail, w, carry=carry)
    user = F.col("user_id") if keyed else F.col("first_user_id")
    return p.select(user.alias("user_id"), "start_time", "end_time",
                    F.lit(f"login fail 2 times within {w}s").alias("msg"))


# --- Q12 .. Q14: orders, payments, receipts -----------------------------------

def order_timeout_pattern(orders: DataFrame, within: str | int = "9 minutes",
                          keys: tuple[str, ...] = ("order_id",)) -> DataFrame:
    """Q12: every ``create`` followed by a ``pay`` with a transaction id less
    than ``within`` later is ``paid``, else ``timeout`` (side output) ->
    ``*keys, create_time, pay_time, outcome, msg``."""
    w = _seconds(within)
    is_create = F.col("event_type") == "create"
    is_pay = (F.col("event_type") == "pay") & (F.coalesce(F.col("tx_id"), F.lit("")) != "")
    m = followed_by(orders, list(keys), order_of(orders), is_create, is_pay, w)
    outcome = F.when(F.col("matched"), "paid").otherwise("timeout")
    msg = F.when(F.col("matched"), F.lit("order paid in time")).otherwise(F.lit("no payment in time"))
    return m.select(*keys, F.col("start_time").alias("create_time"),
                    F.col("end_time").alias("pay_time"), outcome.alias("outcome"), msg.alias("msg"))


OUTCOME_MSG = {
    "paid": "order paid in time",
    "paid_late": "order paid after its limit",
    "unpaid": "order not paid within its limit",
    "pay_without_create": "payment for an unknown order",
}


def _msg_of(outcome: Column, table: dict[str, str]) -> Column:
    out = None
    for k, v in table.items():
        out = (F.when(outcome == k, v) if out is None else out.when(outcome == k, v))
    return out


def order_outcomes(orders: DataFrame, limit: str | int = "15 minutes",
                   keys: tuple[str, ...] = ("order_id",)) -> DataFrame:
    """Q13: first create and first pay of an order, in either order
    -> ``*keys, create_time, pay_time, outcome, msg`` with outcome ``paid``,
    ``paid_late``, ``unpaid`` or ``pay_without_create``."""
    r = first_pair_outcomes(orders, list(keys), order_of(orders),
                            F.col("event_type") == "create", F.col("event_type") == "pay",
                            _seconds(limit))
    return r.withColumn("msg", _msg_of(F.col("outcome"), OUTCOME_MSG))


RECONCILE_MSG = {
    "matched": "payment and receipt agree",
    "order_only": "no receipt for this payment",
    "receipt_only": "no payment for this receipt",
}


def tx_reconcile(orders: DataFrame, receipts: DataFrame, tolerance: str | int = 60) -> DataFrame:
    """Q14: payments (``pay`` rows with a transaction id) against receipts on
    ``tx_id`` within ±``tolerance`` seconds -> ``tx_id, order_id, pay_time,
    receipt_time, pay_channel, outcome, msg`` with outcome ``matched``,
    ``order_only`` or ``receipt_only``.  Duplicates of a ``tx_id`` on either
    side are dropped, the earliest kept."""
    pays = orders.where((F.col("event_type") == "pay")
                        & (F.coalesce(F.col("tx_id"), F.lit("")) != ""))
    j = interval_match(pays, receipts, "tx_id", order_of(pays), order_of(receipts),
                       _seconds(tolerance), cols_l=["order_id"], cols_r=["pay_channel"])
    outcome = (F.when(F.col("outcome") == "left_only", "order_only")
               .when(F.col("outcome") == "right_only", "receipt_only").otherwise("matched"))
    return j.select("tx_id", F.col("l_order_id").alias("order_id"),
                    F.col(f"l_{TS}").alias("pay_time"), F.col(f"r_{TS}").alias("receipt_time"),
                    F.col("r_pay_channel").alias("pay_channel"), outcome.alias("outcome"),
                    _msg_of(outcome, RECONCILE_MSG).alias("msg"))
