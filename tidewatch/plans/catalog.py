"""Registered queries: the jobs run over the driver's test tables.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables.  Stand-in parameters follow SURVEY §7.4: the reference's second-scale
limits find nothing in ``events`` (about 14 rows an hour at sf0.01), so the
pattern jobs use hours; window sizes and slides are the reference's except
where noted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.operators import sketches
from tidewatch.operators.user_aggregate import HistogramMedian, windowed_user_agg
from tidewatch.operators.windows import windowed_distinct
from tidewatch.plans import jobs, streams
from tidewatch.plans.decoded import KINDS, decoded
from tidewatch.session import checkpoint_root
from tidewatch.sources import tables as T

# Stand-in limits for the pattern jobs on the test tables.
CAP_N = streams.CAP_N
PATTERN_LIMIT = "6 hours"
RECONCILE_TOLERANCE = "1 hour"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "events")


def q_hot_items(spark, sf_dir):
    return jobs.hot_items(T.user_behavior(_events(spark, sf_dir)), behavior="click")


def q_hot_items_report(spark, sf_dir):
    return jobs.hot_items_report(T.user_behavior(_events(spark, sf_dir)), behavior="click")


def q_hot_urls(spark, sf_dir):
    return jobs.hot_urls(T.access_log(_events(spark, sf_dir)))


def q_page_views(spark, sf_dir):
    return jobs.page_views(T.user_behavior(_events(spark, sf_dir)), behavior="view")


def q_unique_visitors(spark, sf_dir):
    return jobs.unique_visitors(T.user_behavior(_events(spark, sf_dir)), behavior="view")


def q_unique_visitors_bitmap(spark, sf_dir):
    return jobs.unique_visitors(T.user_behavior(_events(spark, sf_dir)), behavior="view",
                                method="bitmap")


def q_unique_visitors_hll(spark, sf_dir):
    """A-6 held against the exact count: the sketch must lie within three of its
    standard errors (1.04 / sqrt(2^lg_k)) of it, or one visitor."""
    views = T.user_behavior(_events(spark, sf_dir))
    exact = jobs.unique_visitors(views, behavior="view")
    sketch = jobs.unique_visitors(views, behavior="view", method="hll").withColumnRenamed("uv", "estimate")
    near = F.abs(F.col("estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), 3 * 1.04 / 64 * F.col("uv"))
    return exact.join(sketch, "window_end").select("window_end", "uv", near.alias("within_three_errors"))


def q_unique_visitors_stored(spark, sf_dir):
    """A-6 from a stored table: hourly sketches are written once, then rolled up to sliding
    days from the table alone; held against the exact count as above."""
    views = T.user_behavior(_events(spark, sf_dir)).where("behavior = 'view'")
    base = f"{checkpoint_root(spark)}/sketches/{uuid.uuid4().hex}"
    sketches.update(views, base, "event_time", "user_id")
    rolled = sketches.rollup(sketches.stored(spark, base), "1 day", "6 hours", name="estimate")
    exact = windowed_distinct(views, "event_time", "1 day", "user_id", "6 hours")
    near = F.abs(F.col("estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), 3 * sketches.error(12) * F.col("uv"))
    return exact.join(rolled, "window_end").select("window_end", "uv", near.alias("within_three_errors"))


def q_value_profile(spark, sf_dir):
    """X-10: a user aggregate that merges, per hour and event type."""
    return windowed_user_agg(_events(spark, sf_dir), "ts", "1 hour", None, ["event_type"], HistogramMedian("value", 10.0),
                             ["value"])


def q_hot_urls_dynamic(spark, sf_dir):
    return jobs.hot_urls(T.access_log(_events(spark, sf_dir)), exclude_static=True)


def q_hot_urls_report(spark, sf_dir):
    return jobs.hot_urls_report(T.access_log(_events(spark, sf_dir)))


# Marketing: 'error' plays UNINSTALL.
def q_marketing_by_channel(spark, sf_dir):
    return jobs.marketing_by_channel(T.marketing(_events(spark, sf_dir)), exclude="error")


def q_marketing_total(spark, sf_dir):
    return jobs.marketing_total(T.marketing(_events(spark, sf_dir)), exclude="error")


def q_marketing_rollup(spark, sf_dir):
    return jobs.marketing_rollup(T.marketing(_events(spark, sf_dir)), exclude="error")


# Ad clicks: Q8 and Q9 read one relation; provinces are looked up after the
# cap and the counts, by their number.
def _ad_clicks(spark, sf_dir) -> DataFrame:
    return T.ad_click(_events(spark, sf_dir))


def _named(df: DataFrame, spark, sf_dir) -> DataFrame:
    return T.with_province(df, T.table(spark, sf_dir, "nation"))


def q_ad_clicks_by_province(spark, sf_dir):
    r = jobs.ad_clicks_by_province(_ad_clicks(spark, sf_dir), province="province_key")
    return _named(r, spark, sf_dir).select("window_end", "province", "cnt")


def q_ad_click_cap(spark, sf_dir):
    r = jobs.ad_click_cap(_ad_clicks(spark, sf_dir), n=CAP_N)
    return _named(r, spark, sf_dir).select("user_id", "ad_id", "province", "event_time", "event_id", "day",
                                           "seq_no", "outcome", "msg")


def q_ad_click_warnings(spark, sf_dir):
    return jobs.ad_click_warnings(_ad_clicks(spark, sf_dir), n=CAP_N)


def q_ad_clicks_after_cap(spark, sf_dir):
    r = jobs.ad_clicks_after_cap(_ad_clicks(spark, sf_dir), n=CAP_N, province="province_key")
    return _named(r, spark, sf_dir).select("window_end", "province", "cnt")


def q_login_fail_burst(spark, sf_dir):
    return jobs.login_fail_burst(T.login(_events(spark, sf_dir)), gap=PATTERN_LIMIT,
                                 fail=T.LOGIN_FAIL)


def q_login_fail_consecutive(spark, sf_dir):
    return jobs.login_fail_consecutive(T.login(_events(spark, sf_dir)), within=PATTERN_LIMIT,
                                       fail=T.LOGIN_FAIL)


def q_order_timeout_pattern(spark, sf_dir):
    return jobs.order_timeout_pattern(T.order_events(_events(spark, sf_dir)),
                                      within=PATTERN_LIMIT)


def q_order_outcomes(spark, sf_dir):
    return jobs.order_outcomes(T.order_events(_events(spark, sf_dir)), limit=PATTERN_LIMIT,
                               keys=("order_id", "day"))


def q_tx_reconcile(spark, sf_dir):
    ev = _events(spark, sf_dir)
    return jobs.tx_reconcile(T.order_events(ev), T.receipts(ev), tolerance=RECONCILE_TOLERANCE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "hot_items": q_hot_items,
    "hot_items_report": q_hot_items_report,
    "hot_urls": q_hot_urls,
    "hot_urls_dynamic": q_hot_urls_dynamic,
    "hot_urls_report": q_hot_urls_report,
    "page_views": q_page_views,
    "unique_visitors": q_unique_visitors,
    "unique_visitors_bitmap": q_unique_visitors_bitmap,
    "unique_visitors_hll": q_unique_visitors_hll,
    "unique_visitors_stored": q_unique_visitors_stored,
    "value_profile": q_value_profile,
    "marketing_by_channel": q_marketing_by_channel,
    "marketing_total": q_marketing_total,
    "marketing_rollup": q_marketing_rollup,
    "ad_clicks_by_province": q_ad_clicks_by_province,
    "ad_click_cap": q_ad_click_cap,
    "ad_click_warnings": q_ad_click_warnings,
    "ad_clicks_after_cap": q_ad_clicks_after_cap,
    "login_fail_burst": q_login_fail_burst,
    "login_fail_consecutive": q_login_fail_consecutive,
    "order_timeout_pattern": q_order_timeout_pattern,
    "order_outcomes": q_order_outcomes,
    "tx_reconcile": q_tx_reconcile,
    **{f"decode_{kind}": decoded(kind) for kind in KINDS},
    "stream_page_views": streams.q_page_views,
    "stream_hot_items": streams.q_hot_items,
    "stream_login_fail_burst": streams.q_login_fail_burst,
    "stream_hot_items_ranked": streams.q_hot_items_ranked,
    "stream_hot_urls_revised": streams.q_hot_urls_revised,
    "stream_unique_visitors_firing": streams.q_unique_visitors_firing,
    "stream_tx_reconcile": streams.q_tx_reconcile,
    "stream_login_fail_consecutive": streams.q_login_fail_consecutive,
    "stream_order_timeout_pattern": streams.q_order_timeout_pattern,
    "stream_ad_click_cap": streams.q_ad_click_cap,
}
