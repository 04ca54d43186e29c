"""Registered queries that run as Structured Streaming jobs.

Each reads ``events`` as a stream, handles what is there (``availableNow``)
with its checkpoint and output under the shared checkpoint folder, and returns
the output.  Windows and sessions still open at the end of the input are not
part of it: the watermark, the time of the last event of the query's kind (the
kind is filtered below the watermark), has not passed them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from tidewatch.operators.ranking import top_n_per_window
from tidewatch.session import checkpoint_root
from tidewatch.sources import tables as T
from tidewatch.streaming import forms, keyed, wiring

GAP = "6 hours"
#: Clicks of a user on an ad that pass per day, as in the batch query.
CAP_N = 1
#: Slide of the revised ranking here: every row opens five windows instead of 120.
REVISED_SLIDE = "2 minutes"


def _stream(spark, sf_dir: str) -> DataFrame:
    """``events`` as a stream with event time ``ts`` and no delay."""
    schema = T.table(spark, sf_dir, "events").schema
    events = wiring.read_table_stream(spark, f"{sf_dir}/events.parquet*", schema)
    # NTZ wall clocks become instants of UTC, whatever the session zone
    utc = F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
    return events.withColumn("ts", utc).withWatermark("ts", "0 seconds")


def _plain(found: DataFrame) -> DataFrame:
    """Instants back to the wall clocks of the test tables."""
    return found.select(*[
        F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, unix_micros({n}) / 1000000)").alias(n)
        if t == "timestamp" else F.col(n) for n, t in found.dtypes])


def _finish(out: DataFrame, name: str, rank=None) -> DataFrame:
    """Run ``out`` over what has arrived and read its output back."""
    spark = out.sparkSession
    run = f"{name}-{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/stream-out/{run}"

    def write(batch: DataFrame, batch_id: int) -> None:    # overwritten when a batch is replayed
        (rank(batch) if rank else batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = wiring.start(out, run, foreach_batch=write, available_now=True)
    query.awaitTermination()
    return _plain(spark.read.parquet(path).drop("batch"))


def _to_files(out: DataFrame, name: str) -> DataFrame:
    """As ``_finish``, through Spark's own file sink: the query has no code per batch."""
    spark = out.sparkSession
    run = f"{name}-{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/stream-out/{run}"
    wiring.start(out, run, sink="parquet", path=path, available_now=True).awaitTermination()
    return _plain(spark.read.schema(out.schema).parquet(path))


def q_page_views(spark, sf_dir: str) -> DataFrame:
    views = T.user_behavior(_stream(spark, sf_dir)).where("behavior = 'view'")
    return _finish(forms.windowed_count_stream(views, "1 hour", name="pv"), "page-views")


def q_hot_items(spark, sf_dir: str) -> DataFrame:
    counts = forms.hot_items_counts_stream(T.user_behavior(_stream(spark, sf_dir)), behavior="click")
    return _finish(counts, "hot-items", lambda b: top_n_per_window(b, 3, key="item_id"))


def q_login_fail_burst(spark, sf_dir: str) -> DataFrame:
    logins = T.login(_stream(spark, sf_dir))
    return _finish(forms.login_fail_burst_stream(logins, gap=GAP, fail=T.LOGIN_FAIL), "bursts")


def q_hot_items_ranked(spark, sf_dir: str) -> DataFrame:
    """Counts and ranking in one query (T-9)."""
    return _to_files(forms.hot_items_stream(T.user_behavior(_stream(spark, sf_dir)), behavior="click"), "hot-items-ranked")


def q_hot_urls_revised(spark, sf_dir: str) -> DataFrame:
    """The newest revision of every window, closed or not (T-3, T-12)."""
    out = forms.hot_urls_revised_stream(T.access_log(_stream(spark, sf_dir)), slide=REVISED_SLIDE)
    return keyed.newest_revision(_to_files(out, "hot-urls-revised")).drop("revision")


def q_unique_visitors_firing(spark, sf_dir: str) -> DataFrame:
    """The final firing of every closed window (T-14, T-15)."""
    out = forms.unique_visitors_firing_stream(T.user_behavior(_stream(spark, sf_dir)), behavior="view", every=100)
    return _to_files(out, "unique-visitors").where("final").select("window_end", "uv", "n_rows")


def q_tx_reconcile(spark, sf_dir: str) -> DataFrame:
    events = _stream(spark, sf_dir)
    out = forms.tx_reconcile_stream(T.order_events(events), T.receipts(_stream(spark, sf_dir)), tolerance="1 hour")
    return _to_files(out, "tx-reconcile")


def q_login_fail_consecutive(spark, sf_dir: str) -> DataFrame:
    logins = T.login(_stream(spark, sf_dir))
    return _to_files(forms.login_fail_consecutive_stream(logins, within=GAP, fail=T.LOGIN_FAIL), "consecutive")


def q_order_timeout_pattern(spark, sf_dir: str) -> DataFrame:
    orders = T.order_events(_stream(spark, sf_dir))
    return _to_files(forms.order_timeout_pattern_stream(orders, within=GAP), "create-then-pay")


def q_ad_click_cap(spark, sf_dir: str) -> DataFrame:
    clicks = T.ad_click(_stream(spark, sf_dir)).withColumn("province", F.col("province_key").cast("string"))
    return _to_files(forms.ad_click_cap_stream(clicks, n=CAP_N), "click-cap") \
        .select("user_id", "ad_id", "event_time", F.col("tb").alias("event_id"), "outcome", "msg")
