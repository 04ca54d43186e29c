"""Stream forms against the batch forms.

Input is written as several Parquet files in time order (rows inside a file
shuffled) and read one file per micro-batch with ``availableNow``.  A
sentinel row far in the future, of a kind the job keeps, moves the
watermark past every real row so all windows and timers close.
"""

import random
import uuid

from pyspark.sql import functions as F

from tidewatch.plans import jobs
from tidewatch.sources import tables as T
from tidewatch.streaming import forms as S, wiring as Wr

from conftest import SF_SMALL
from helpers import frame, ts

FAR = 2 * 10 ** 9   # sentinel time (2033), epoch seconds


def _files(spark, df, tmp_path, n=4, seed=1):
    """Write ``df`` as ``n`` time-ordered files; return the stream."""
    src = str(tmp_path / f"in-{uuid.uuid4().hex[:6]}")
    rows = sorted(df.collect(), key=lambda r: r.event_time)
    step = max(1, -(-len(rows) // n))
    rnd = random.Random(seed)
    for i in range(0, len(rows), step):
        chunk = rows[i:i + step]
        rnd.shuffle(chunk)
        spark.createDataFrame(chunk, df.schema).coalesce(1).write.mode("append").parquet(src)
    return Wr.read_table_stream(spark, src, df.schema, max_files=1)


def _run(df, mode="append"):
    name = f"t_{uuid.uuid4().hex[:8]}"
    q = Wr.start(df, name, mode=mode, available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    return df.sparkSession.sql(f"SELECT * FROM {name}")


def _bag(df, cols):
    rows = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(rows, key=lambda t: tuple((v is None, v if v is not None else 0) for v in t))


def _events_with_sentinel(spark, kind):
    ev = T.table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    sentinel = spark.createDataFrame([(10 ** 7, FAR, 0, kind, 0.0, '{"k": 1}')],
                                     "event_id BIGINT, ts BIGINT, user_id BIGINT, event_type STRING, "
                                     "value DOUBLE, props STRING") \
        .withColumn("ts", F.timestamp_seconds("ts"))
    return ev, ev.unionByName(sentinel)


def test_page_views_and_unique_visitors_stream(spark, tmp_path):
    ev, with_sentinel = _events_with_sentinel(spark, "view")
    batch_pv = _bag(jobs.page_views(T.user_behavior(ev), behavior="view"), ["window_end", "pv"])
    batch_uv = _bag(jobs.unique_visitors(T.user_behavior(ev), behavior="view"), ["window_end", "uv"])
    # the adapter reads ``ts``; event_time comes back out of it
    ub = Wr.event_time(T.user_behavior(_files(
        spark, with_sentinel.withColumnRenamed("ts", "event_time"), tmp_path)
        .withColumnRenamed("event_time", "ts")))
    pv = _bag(_run(S.windowed_count_stream(ub.where(F.col("behavior") == "view"), "1 hour",
                                           name="pv")), ["window_end", "pv"])
    assert pv == batch_pv
    ub2 = Wr.event_time(T.user_behavior(_files(
        spark, with_sentinel.withColumnRenamed("ts", "event_time"), tmp_path)
        .withColumnRenamed("event_time", "ts")))
    uv = _bag(_run(S.unique_visitors_stream(ub2, behavior="view")), ["window_end", "uv"])
    assert uv == batch_uv


def test_hot_items_stream_ranks_closed_windows(spark, tmp_path):
    ev, with_sentinel = _events_with_sentinel(spark, "click")
    batch = _bag(jobs.hot_items(T.user_behavior(ev), behavior="click"),
                 ["window_end", "item_id", "cnt", "rank"])
    ub = Wr.event_time(T.user_behavior(_files(
        spark, with_sentinel.withColumnRenamed("ts", "event_time"), tmp_path)
        .withColumnRenamed("event_time", "ts")))
    got = []
    sink = S.top_n_writer(3, "item_id", lambda b, i: got.extend(
        tuple(r) for r in b.select("window_end", "item_id", "cnt", "rank").collect()))
    name = f"t_{uuid.uuid4().hex[:8]}"
    q = Wr.start(S.hot_items_counts_stream(ub, behavior="click"), name, foreach_batch=sink,
                 available_now=True)
    q.awaitTermination(300)
    far = ts(FAR)
    assert sorted(r for r in got if r[0] < far) == batch


def test_high_fanout_window_chain(spark, tmp_path):
    rnd = random.Random(4)
    rows = [(rnd.choice(["bj", "sh"]), 1000 + rnd.randrange(0, 7200)) for _ in range(60)]
    df = frame(spark, "province STRING, event_time BIGINT", rows)
    batch = _bag(jobs.ad_clicks_by_province(df), ["window_end", "province", "cnt"])
    s = frame(spark, "province STRING, event_time BIGINT", rows + [("bj", FAR)])
    got = _bag(_run(S.windowed_count_stream(Wr.event_time(_files(spark, s, tmp_path)), "1 hour",
                                            "5 seconds", keys=["province"])),
               ["window_end", "province", "cnt"])
    assert [r for r in got if r[0] < ts(FAR)] == batch


LOGIN_ROWS = [(1, "fail", 100, 0), (1, "fail", 101, 1), (1, "fail", 102, 2),
              (2, "fail", 100, 3), (2, "success", 101, 4), (2, "fail", 101, 5),
              (3, "fail", 200, 6), (3, "fail", 202, 7), (4, "fail", 300, 8), (4, "fail", 305, 9)]
LOGIN = "user_id BIGINT, event_type STRING, event_time BIGINT, seq BIGINT"


def test_login_streams(spark, tmp_path):
    df = frame(spark, LOGIN, LOGIN_ROWS)
    s = frame(spark, LOGIN, LOGIN_ROWS + [(9, "fail", FAR, 99)])
    burst_b = _bag(jobs.login_fail_burst(df), ["user_id", "start_time", "end_time", "fails"])
    burst_s = _bag(_run(S.login_fail_burst_stream(Wr.event_time(_files(spark, s, tmp_path),
                                                                delay="3 seconds"))),
                   ["user_id", "start_time", "end_time", "fails"])
    assert burst_s == burst_b
    cons_b = _bag(jobs.login_fail_consecutive(df), ["user_id", "start_time", "end_time"])
    cons_s = _bag(_run(S.login_fail_consecutive_stream(
        Wr.event_time(_files(spark, s, tmp_path), delay="3 seconds"))),
        ["user_id", "start_time", "end_time"])
    assert cons_s == cons_b


ORDER = "order_id BIGINT, event_type STRING, tx_id STRING, event_time BIGINT, seq BIGINT"
ORDER_ROWS = [(1, "create", "", 1000), (1, "pay", "t1", 1100),
              (2, "create", "", 1000), (2, "pay", "t2", 1000 + 900),
              (3, "pay", "t3", 990), (3, "create", "", 1000),
              (4, "create", "", 1000), (5, "pay", "t5", 1500),
              (6, "create", "", 1200), (6, "create", "", 1300), (6, "pay", "t6", 1400)]


def test_order_streams(spark, tmp_path):
    rows = [(*r, i) for i, r in enumerate(ORDER_ROWS)]
    df = frame(spark, ORDER, rows)
    s = frame(spark, ORDER, rows + [(99, "create", "", FAR, 99)])
    cols = ["order_id", "create_time", "pay_time", "outcome"]
    b = _bag(jobs.order_outcomes(df, limit=900), cols)
    got = _bag(_run(S.order_outcomes_stream(Wr.event_time(_files(spark, s, tmp_path)), limit=900)),
               cols)
    assert [r for r in got if r[0] != 99] == b
    b = _bag(jobs.order_timeout_pattern(df, within=540), cols)
    got = _bag(_run(S.order_timeout_pattern_stream(Wr.event_time(_files(spark, s, tmp_path)),
                                                   within=540)), cols)
    assert [r for r in got if r[0] != 99] == b


def test_click_cap_stream(spark, tmp_path):
    day = 86400 * 10
    rows = [(7, "a", "bj", day + i, i) for i in range(6)] + [(7, "a", "bj", day + 86400 + 5, 50),
                                                            (8, "b", "sh", day + 3, 60)]
    ddl = "user_id BIGINT, ad_id STRING, province STRING, event_time BIGINT, seq BIGINT"
    df = frame(spark, ddl, rows)
    s = frame(spark, ddl, rows + [(99, "z", "x", FAR, 99)])
    b = _bag(jobs.ad_click_cap(df, n=3), ["user_id", "ad_id", "event_time", "outcome"])
    got = _bag(_run(S.ad_click_cap_stream(Wr.event_time(_files(spark, s, tmp_path)), n=3)),
               ["user_id", "ad_id", "event_time", "outcome"])
    assert [r for r in got if r[0] != 99] == b


def test_reconcile_stream(spark, tmp_path):
    orders = [(1, "pay", "a", 1000, 0), (2, "pay", "b", 1000, 1), (3, "pay", "c", 1000, 2),
              (4, "create", "", 1000, 3)]
    recs = [("a", "wechat", 1030, 0), ("b", "alipay", 1200, 1), ("z", "wechat", 1100, 2)]
    rdl = "tx_id STRING, pay_channel STRING, event_time BIGINT, seq BIGINT"
    o, r = frame(spark, ORDER, orders), frame(spark, rdl, recs)
    cols = ["tx_id", "outcome"]
    b = _bag(jobs.tx_reconcile(o, r), cols)
    so = Wr.event_time(_files(spark, frame(spark, ORDER, orders + [(9, "pay", "s", FAR, 9)]),
                              tmp_path), delay="10 seconds")
    sr = Wr.event_time(_files(spark, frame(spark, rdl, recs + [("s", "x", FAR, 9)]), tmp_path),
                       delay="10 seconds")
    got = _bag(_run(S.tx_reconcile_stream(so, sr)), cols)
    assert [x for x in got if x[0] != "s"] == b


def test_late_revisions_rerank_whole_window(spark, tmp_path):
    # window [0, 600): a wins first; a late burst of c (inside the lateness) revises it
    first = [("a", 10), ("a", 20), ("b", 30), ("z", 700)]
    late = [("c", 40), ("c", 41), ("c", 42), ("z", 705)]
    ddl = "url STRING, event_time BIGINT"
    src = str(tmp_path / "urls")
    for part in (first, late, [("z", 2000)]):
        frame(spark, ddl, part).coalesce(1).write.mode("append").parquet(src)
    st = Wr.event_time(Wr.read_table_stream(spark, src, frame(spark, ddl, first).schema,
                                            max_files=1), delay="61 seconds")
    counts = S.hot_urls_counts_stream(st, size="10 minutes", slide="10 minutes")
    log = str(tmp_path / "log")
    q = Wr.start(counts, f"t_{uuid.uuid4().hex[:8]}", mode="update",
                 foreach_batch=Wr.changelog_writer(log), available_now=True)
    q.awaitTermination(300)
    top = S.revised_top_n(spark, log, 3, "url")
    w0 = sorted((r.rank, r.url, r.cnt) for r in top.collect() if r.window_end == ts(600))
    assert w0 == [(1, "c", 3), (2, "a", 2), (3, "b", 1)]


def test_running_unique_visitors_reach_batch_count(spark, tmp_path):
    ev, with_sentinel = _events_with_sentinel(spark, "view")
    batch = _bag(jobs.unique_visitors(T.user_behavior(ev), behavior="view", method="bitmap"),
                 ["window_end", "uv"])
    ub = Wr.event_time(T.user_behavior(_files(
        spark, with_sentinel.withColumnRenamed("ts", "event_time"), tmp_path)
        .withColumnRenamed("event_time", "ts")))
    log = str(tmp_path / "uvlog")
    q = Wr.start(S.unique_visitors_running_stream(ub, behavior="view"),
                 f"t_{uuid.uuid4().hex[:8]}", mode="update",
                 foreach_batch=Wr.changelog_writer(log), available_now=True)
    q.awaitTermination(300)
    got = _bag(S.running_uv(spark, log), ["window_end", "uv"])
    assert [r for r in got if r[0] < ts(FAR)] == batch


def test_tagged_writer_splits_outcomes(spark, tmp_path):
    rows = [(1, "paid"), (2, "timeout"), (3, "paid")]
    df = spark.createDataFrame(rows, "order_id BIGINT, outcome STRING")
    base = str(tmp_path / "tagged")
    w = Wr.tagged_writer(base)
    w(df, 0)
    w(df, 1)
    w(df, 0)                                               # replayed: replaces its own files
    got = spark.read.parquet(base)
    assert got.count() == 6 and got.where("outcome = 'paid' AND batch = 0").count() == 2
    log, top = str(tmp_path / "log"), str(tmp_path / "top")
    counts = frame(spark, "window_end BIGINT, url STRING, cnt BIGINT", [(10, "a", 1), (10, "b", 2)], "window_end")
    for each, path, n in ((Wr.changelog_writer(log), log, 2), (Wr.batch_writer(top), top, 2)):
        each(counts, 5)
        each(counts, 5)
        assert spark.read.parquet(path).count() == n


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    ddl = "url STRING, event_time BIGINT"
    src = str(tmp_path / "late")
    for part in ([("a", 1000)], [("a", 5000)], [("a", 100)], [("a", 9000)]):
        frame(spark, ddl, part).coalesce(1).write.mode("append").parquet(src)
    st = Wr.event_time(Wr.read_table_stream(spark, src, frame(spark, ddl, [("a", 1)]).schema,
                                            max_files=1), delay="60 seconds")
    name = f"t_{uuid.uuid4().hex[:8]}"
    late = Wr.LateRows(spark, name)
    q = Wr.start(S.windowed_count_stream(st, "10 minutes", keys=["url"]), name,
                 available_now=True)
    q.awaitTermination(300)
    ends = sorted(r.window_end for r in spark.sql(f"SELECT * FROM {name}").collect())
    assert ts(600) not in ends                  # the row at 100 s came too late
    assert Wr.dropped_late_rows(q) >= 1
    assert late.close() == 1


def test_clicks_after_cap_stream(spark, tmp_path):
    day = 86400 * 10
    rows = [(7, "a", "bj", day + i, i) for i in range(6)] + [(8, "b", "sh", day + 3, 60),
                                                            (7, "a", "bj", day + 7300, 61)]
    ddl = "user_id BIGINT, ad_id STRING, province STRING, event_time BIGINT, seq BIGINT"
    df = frame(spark, ddl, rows)
    # two sentinels: the later one releases the earlier from the processor,
    # whose event time then closes the downstream windows
    s = frame(spark, ddl, rows + [(99, "z", "x", FAR, 99), (98, "z", "x", FAR + 7200, 98)])
    cols = ["window_end", "province", "cnt"]
    b = _bag(jobs.ad_clicks_after_cap(df, n=3, slide="30 minutes"), cols)
    got = _bag(_run(S.ad_clicks_after_cap_stream(Wr.event_time(_files(spark, s, tmp_path)), n=3,
                                                 slide="30 minutes")), cols)
    assert [r for r in got if r[0] < ts(FAR)] == b


def test_text_line_stream_decoded(spark, tmp_path):
    from tidewatch.sources.decode import decode_login
    from tidewatch.sources.text import read_lines
    src = tmp_path / "lines"
    src.mkdir()
    (src / "a.csv").write_text("71,10.0.0.1,fail,1700000042\n71,10.0.0.1,fail,1700000043\n")
    (src / "b.csv").write_text("71,10.0.0.1,fail,1700000044\n9,10.0.0.2,fail,1700900000\n")
    logins = Wr.event_time(decode_login(read_lines(spark, str(src), stream=True,
                                                   max_files_per_trigger=1)),
                           delay="3 seconds")
    got = _bag(_run(S.login_fail_consecutive_stream(logins)), ["user_id", "start_time", "end_time"])
    assert got == [(71, ts(1700000042), ts(1700000043)), (71, ts(1700000043), ts(1700000044))]


def test_pay_after_unpaid_deadline_stream(spark, tmp_path):
    rows = [(1, "create", "", 1000, 0), (2, "create", "", 1000, 1)]
    later = [(1, "pay", "t1", 5000, 2)]                       # long after the 900 s deadline
    ddl_rows = rows + later + [(99, "create", "", FAR, 99)]
    src = str(tmp_path / "late-pay")
    for part in (rows, later, [(99, "create", "", FAR, 99)]):
        frame(spark, ORDER, part).coalesce(1).write.mode("append").parquet(src)
    st = Wr.event_time(Wr.read_table_stream(spark, src, frame(spark, ORDER, ddl_rows).schema,
                                            max_files=1))
    got = _bag(_run(S.order_outcomes_stream(st, limit=900)), ["order_id", "outcome"])
    assert [r for r in got if r[0] != 99] == [(1, "pay_without_create"), (1, "unpaid"),
                                              (2, "unpaid")]


def test_processors_match_batch_on_event_table(spark, tmp_path):
    """Microsecond event times, many keys, rows shuffled inside each file."""
    ev = T.table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    sent = (spark.createDataFrame(
        [(10 ** 8, FAR, 0, "error", 0.0, "{}"), (10 ** 8 + 1, FAR + 86400, 0, "signup", 0.0, "{}"),
         (10 ** 8 + 2, FAR + 2 * 86400, 0, "purchase", 0.0, "{}")],
        "event_id BIGINT, ts BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
        .withColumn("ts", F.timestamp_seconds("ts")))
    src = _files(spark, ev.unionByName(sent).withColumnRenamed("ts", "event_time"), tmp_path, n=5)

    def stream():
        return src.withColumnRenamed("event_time", "ts")

    far = ts(FAR)
    cols = ["user_id", "start_time", "end_time"]
    b = _bag(jobs.login_fail_consecutive(T.login(ev), within="6 hours", fail="error"), cols)
    s = _bag(_run(S.login_fail_consecutive_stream(Wr.event_time(T.login(stream())),
                                                  within="6 hours", fail="error")), cols)
    assert [r for r in s if r[1] < far] == b
    cols = ["order_id", "create_time", "pay_time", "outcome"]
    b = _bag(jobs.order_timeout_pattern(T.order_events(ev), within="6 hours"), cols)
    s = _bag(_run(S.order_timeout_pattern_stream(Wr.event_time(T.order_events(stream())),
                                                 within="6 hours")), cols)
    assert [r for r in s if r[1] < far] == b


def test_reconcile_stream_matches_batch_on_event_table(spark, tmp_path):
    """Duplicated transaction ids arriving out of order inside a batch: the
    stream keeps the earliest of each, as the batch form does."""
    ev = T.table(spark, SF_SMALL, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    sent = (spark.createDataFrame(
        [(10 ** 8, FAR, 10 ** 9, "signup", 0.0, "{}"),
         (10 ** 8 + 1, FAR + 86400, 10 ** 9, "purchase", 0.0, "{}")],
        "event_id BIGINT, ts BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
        .withColumn("ts", F.timestamp_seconds("ts")))
    src = _files(spark, ev.unionByName(sent).withColumnRenamed("ts", "event_time"), tmp_path, n=5)
    stream = src.withColumnRenamed("event_time", "ts")
    cols = ["tx_id", "order_id", "pay_time", "receipt_time", "outcome"]
    b = _bag(jobs.tx_reconcile(T.order_events(ev), T.receipts(ev), tolerance="1 hour"), cols)
    s = _bag(_run(S.tx_reconcile_stream(Wr.event_time(T.order_events(stream), delay="2 hours"),
                                        Wr.event_time(T.receipts(stream), delay="2 hours"),
                                        tolerance="1 hour")), cols)
    assert [r for r in s if not str(r[0]).startswith(str(10 ** 9))] == b


def test_revised_top_n_writer_reports_each_revision(spark, tmp_path):
    first = [("a", 10), ("a", 20), ("b", 30), ("z", 700)]
    late = [("c", 40), ("c", 41), ("c", 42), ("z", 705)]
    ddl = "url STRING, event_time BIGINT"
    src = str(tmp_path / "urls2")
    for part in (first, late):
        frame(spark, ddl, part).coalesce(1).write.mode("append").parquet(src)
    st = Wr.event_time(Wr.read_table_stream(spark, src, frame(spark, ddl, first).schema,
                                            max_files=1), delay="61 seconds")
    counts = S.hot_urls_counts_stream(st, size="10 minutes", slide="10 minutes")
    reports = []
    sink = S.revised_top_n_writer(str(tmp_path / "log2"), 3, "url", lambda b, i: reports.append(
        sorted((r.rank, r.url, r.cnt) for r in b.collect() if r.window_end == ts(600))))
    q = Wr.start(counts, f"t_{uuid.uuid4().hex[:8]}", mode="update", foreach_batch=sink,
                 available_now=True)
    q.awaitTermination(300)
    reports = [r for r in reports if r]
    assert reports[0] == [(1, "a", 2), (2, "b", 1)]
    assert reports[-1] == [(1, "c", 3), (2, "a", 2), (3, "b", 1)]


def test_marketing_streams(spark, tmp_path):
    ev, with_sentinel = _events_with_sentinel(spark, "click")
    mk_b = T.marketing(ev).where(F.col("behavior") != "error")
    cols = ["window_end", "channel", "behavior", "cnt"]
    b_keys = _bag(jobs.marketing_by_channel(T.marketing(ev), slide="10 minutes", exclude="error"),
                  cols)
    b_total = _bag(jobs.marketing_total(T.marketing(ev), slide="10 minutes", exclude="error"),
                   ["window_end", "cnt"])
    src = _files(spark, with_sentinel.withColumnRenamed("ts", "event_time"), tmp_path)
    mk = Wr.event_time(T.marketing(src.withColumnRenamed("event_time", "ts")))
    mk = mk.where(F.col("behavior") != "error")
    far = ts(FAR)
    got = _bag(_run(S.windowed_count_stream(mk, "1 hour", "10 minutes",
                                            keys=["channel", "behavior"])), cols)
    assert [r for r in got if r[0] < far] == b_keys
    got = _bag(_run(S.windowed_count_stream(mk, "1 hour", "10 minutes")), ["window_end", "cnt"])
    assert [r for r in got if r[0] < far] == b_total
    assert mk_b.count() > 0


def test_unique_visitors_bitmap_stream(spark, tmp_path):
    ev, with_sentinel = _events_with_sentinel(spark, "view")
    b = _bag(jobs.unique_visitors(T.user_behavior(ev), behavior="view", method="bitmap"),
             ["window_end", "uv"])
    ub = Wr.event_time(T.user_behavior(_files(
        spark, with_sentinel.withColumnRenamed("ts", "event_time"), tmp_path)
        .withColumnRenamed("event_time", "ts")))
    got = _bag(_run(S.unique_visitors_stream(ub, behavior="view", method="bitmap")),
               ["window_end", "uv"])
    assert [r for r in got if r[0] < ts(FAR)] == b


def _parts(spark, tmp_path, ddl, parts):
    """One file per part, one part per micro-batch."""
    src = str(tmp_path / f"parts-{uuid.uuid4().hex[:6]}")
    for k, part in enumerate(parts):
        frame(spark, ddl, part).coalesce(1).write.parquet(f"{src}/p{k:03d}.parquet")
        import time
        time.sleep(0.02)                                   # files are taken in the order of their times
    return Wr.read_table_stream(spark, f"{src}/*.parquet", frame(spark, ddl, parts[0]).schema, max_files=1)


def test_late_rows_revise_the_real_windows(spark, tmp_path):
    """10 min / 5 s windows, 1 s delay, 1 min lateness: a row 29 s after a window's end revises
    it, one 90 s after is dropped there (and still counts in its later windows)."""
    ddl = "url STRING, event_time BIGINT"
    parts = [[("a", 10_000), ("b", 10_000), ("b", 10_001)], [("b", 10_603)], [("b", 10_604)],
             [("a", 10_574)], [("b", 10_605)], [("a", 10_514), ("b", 10_605)], [("b", 11_900)]]
    st = Wr.event_time(_parts(spark, tmp_path, ddl, parts), delay="61 seconds")
    log, got = str(tmp_path / "revisions"), {}

    def keep(b, i):
        for r in b.collect():
            got.setdefault(r.window_end, {})[i] = got.get(r.window_end, {}).get(i, []) + [(r.rank, r.url, r.cnt)]

    q = Wr.start(S.hot_urls_counts_stream(st, revisions=True), f"t_{uuid.uuid4().hex[:8]}", mode="update",
                 foreach_batch=S.revised_top_n_writer(log, 3, "url", keep), available_now=True)
    q.awaitTermination(300)
    assert q.exception() is None
    newest = {(r.window_end, r.url): r.cnt for r in Wr.latest(spark, log, ["window_end", "url"]).collect()}
    assert newest[ts(10_600), "a"] == newest[ts(10_575), "a"] == 3    # 10_000, 10_574 and 10_514
    assert newest[ts(10_515), "a"] == 1                    # 10_514 came more than 61 s late
    last = got[ts(10_600)][max(got[ts(10_600)])]
    assert sorted(last) == [(1, "a", 3), (2, "b", 2)]
    assert Wr.compact(spark, log, ["window_end", "url"], "2000-01-01") == 1
    again = {(r.window_end, r.url): r.cnt for r in Wr.latest(spark, log, ["window_end", "url"]).collect()}
    assert again == newest and spark.read.parquet(log).select("batch").distinct().count() == 1


def _state_rows(q):
    return [sum(o.numRowsTotal for o in p.stateOperators) for p in q.recentProgress]


def test_finished_orders_leave_the_state(spark, tmp_path):
    n = 20
    parts = [[(k, "create", "", 1000, k) for k in range(n)] + [(k, "pay", "t", 1100, n + k) for k in range(n)],
             [(900, "create", "", 50_000, 900)], [(901, "create", "", 50_001, 901)], [(902, "create", "", 50_002, 902)]]
    st = Wr.event_time(_parts(spark, tmp_path, ORDER, parts))
    name = f"t_{uuid.uuid4().hex[:8]}"
    q = Wr.start(S.order_outcomes_stream(st, limit=900, retention=600), name, available_now=True)
    q.awaitTermination(300)
    got = spark.sql(f"SELECT * FROM {name}")
    assert got.where("outcome = 'paid'").count() == n
    assert {r.msg for r in got.where("outcome = 'paid'").collect()} == {"order paid in time"}
    rows = _state_rows(q)
    assert max(rows) >= n and rows[-1] <= 3 * 3            # only the orders still open are held


def test_hot_click_key_keeps_a_bounded_buffer(spark, tmp_path):
    ddl = "user_id BIGINT, ad_id STRING, province STRING, event_time BIGINT, seq BIGINT"
    day = 86400 * 20
    parts = [[(7, "a", "bj", day + k % 80_000, k) for k in range(100_000)],
             [(7, "a", "bj", day + 80_001, 200_000)], [(8, "b", "sh", day + 90_000, 200_001)],
             [(8, "b", "sh", day + 400_000, 200_002)]]
    st = Wr.event_time(_parts(spark, tmp_path, ddl, parts))
    name = f"t_{uuid.uuid4().hex[:8]}"
    q = Wr.start(S.ad_click_cap_stream(st, n=100), name, available_now=True)
    q.awaitTermination(300)
    got = spark.sql(f"SELECT * FROM {name}").where("user_id = 7").collect()
    assert sorted(r.outcome for r in got) == ["pass"] * 100 + ["warn"]
    assert [r.msg for r in got if r.outcome == "warn"] == ["user 7 clicked ad a more than 100 times on 1970-01-21"]
    assert max(_state_rows(q)) <= 400                      # not the 100,000 rows of the key


def test_reports_from_a_stream(spark, tmp_path):
    ddl = "url STRING, event_time BIGINT"
    st = Wr.event_time(_parts(spark, tmp_path, ddl, [[("/a", 100), ("/a", 101), ("/b", 102)], [("/b", FAR)]]))
    got = []
    q = Wr.start(S.hot_urls_counts_stream(st), f"t_{uuid.uuid4().hex[:8]}", available_now=True,
                 foreach_batch=S.report_writer(3, "url", "url", lambda b, i: got.extend(r.report for r in b.collect())))
    q.awaitTermination(300)
    assert any("No.1 url=/a count=2" in r and "No.2 url=/b count=1" in r for r in got)


def test_change_log_of_closed_days_is_compacted(spark, tmp_path):
    """A long stream's log keeps one revision per key for the days it has left behind."""
    import os
    ddl, src, log = "url STRING, event_time BIGINT", str(tmp_path / "in"), str(tmp_path / "log")
    parts = [[("a", 10)], [("a", 20), ("b", 30)], [("b", 31), ("b", 32)], [("c", 3 * 86400)], [("c", 3 * 86400 + 5)]]
    for part in parts:
        frame(spark, ddl, part).coalesce(1).write.mode("append").parquet(src)
    st = Wr.event_time(Wr.read_table_stream(spark, src, frame(spark, ddl, parts[0]).schema, max_files=1), delay="5 days")
    out = {}
    sink = S.revised_top_n_writer(log, 3, "url", lambda b, i: out.update({(r.window_end, r["rank"]): (r.url, r.cnt) for r in b.collect()}))
    q = Wr.start(S.hot_urls_counts_stream(st, size="10 minutes", slide="10 minutes", revisions=True), f"t_{uuid.uuid4().hex[:8]}",
                 mode="update", foreach_batch=sink, available_now=True)
    q.awaitTermination(300)
    assert {k: v for k, v in out.items() if k[0] == ts(600)} == {(ts(600), 1): ("b", 3), (ts(600), 2): ("a", 2)}
    assert len([x for x in os.listdir(f"{log}/day=1970-01-01") if x.startswith("batch=")]) == 1
    newest = S.revised_top_n(spark, log, 3, "url").where("window_end < '1970-01-02'").collect()
    assert sorted((r["rank"], r.url, r.cnt) for r in newest) == [(1, "b", 3), (2, "a", 2)]
