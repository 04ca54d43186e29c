from datetime import datetime

import pytest

from pyspark.sql import functions as F

from tidewatch.operators.windows import windowed_count, windowed_count_sets, windowed_distinct
from tidewatch.operators.ranking import top_n_per_window, window_report
from tidewatch.plans import jobs
from tidewatch.sources import tables as T

from conftest import SF_SMALL
from helpers import frame, ts

DDL = "k STRING, user_id BIGINT, event_time BIGINT"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_event_on_window_edge_belongs_to_later_window(spark):
    df = frame(spark, DDL, [("a", 1, 3600), ("a", 1, 3599)])
    got = _rows(windowed_count(df, "event_time", "1 hour", keys=["k"]))
    assert got == [(ts(3600), "a", 1), (ts(7200), "a", 1)]


def test_empty_windows_are_not_emitted(spark):
    df = frame(spark, DDL, [("a", 1, 0), ("a", 1, 5 * 3600)])
    got = _rows(windowed_count(df, "event_time", "1 hour", keys=["k"]))
    assert [r[0] for r in got] == [ts(3600), ts(6 * 3600)]


def test_sliding_counts_match_brute_force(spark):
    import random
    rnd = random.Random(7)
    rows = [(rnd.choice("ab"), 1, rnd.randrange(0, 4 * 3600)) for _ in range(300)]
    df = frame(spark, DDL, rows)
    size, slide = 600, 10
    expect = {}
    for k, _, t in rows:
        first_end = (t // slide + 1) * slide
        for e in range(first_end, first_end + size, slide):
            expect[(ts(e), k)] = expect.get((ts(e), k), 0) + 1
    for panes in (True, False):
        got = {(r.window_end, r.k): r.cnt
               for r in windowed_count(df, "event_time", size, slide, keys=["k"],
                                       panes=panes).collect()}
        assert got == expect


def test_pane_windows_cross_day_buckets(spark):
    # a pane in the last hour of a day feeds windows owned by the next day
    rows = [("a", 1, 86400 - 1), ("a", 1, 86400 + 1)]
    df = frame(spark, DDL, rows)
    got = {r.window_end: r.cnt for r in
           windowed_count(df, "event_time", 3600, 5, keys=["k"], panes=True).collect()}
    # panes 86395 and 86400 each feed 720 windows; they share all but one end
    assert len(got) == 721 and got[ts(86400)] == 1 and got[ts(86405)] == 2
    assert min(got) == ts(86400) and max(got) == ts(86400 + 3600) and got[max(got)] == 1


def test_count_sets_equal_separate_counts(spark):
    ev = T.marketing(T.table(spark, SF_SMALL, "events"))
    sets = windowed_count_sets(ev, "event_time", "1 hour", "10 minutes", ["channel", "behavior"])
    per_key = windowed_count(ev, "event_time", "1 hour", "10 minutes", keys=["channel", "behavior"])
    total = windowed_count(ev, "event_time", "1 hour", "10 minutes").select(
        "window_end", F.lit("total").alias("channel"), F.lit("total").alias("behavior"), "cnt")
    assert _rows(sets) == _rows(per_key.unionByName(total))


def test_distinct_methods(spark):
    ub = T.user_behavior(T.table(spark, SF_SMALL, "events"))
    exact = {r.window_end: r.uv for r in jobs.unique_visitors(ub, behavior="view").collect()}
    bitmap = {r.window_end: r.uv for r in
              jobs.unique_visitors(ub, behavior="view", method="bitmap").collect()}
    hll = {r.window_end: r.uv for r in
           jobs.unique_visitors(ub, behavior="view", method="hll").collect()}
    assert exact == bitmap          # no collisions among small ids
    assert hll.keys() == exact.keys()
    assert all(abs(hll[k] - exact[k]) <= max(1, 0.1 * exact[k]) for k in exact)


def test_top_n_ties_broken_by_key(spark):
    df = spark.createDataFrame(
        [(1, "b", 5), (1, "a", 5), (1, "c", 5), (1, "d", 9), (2, "x", 1)],
        "window_end INT, item STRING, cnt BIGINT")
    got = _rows(top_n_per_window(df, 3, key="item"))
    assert got == [(1, "a", 5, 2), (1, "b", 5, 3), (1, "d", 9, 1), (2, "x", 1, 1)]


def test_window_report(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 1), 7, 3, 1)],
                               "window_end TIMESTAMP, item_id BIGINT, cnt BIGINT, rank BIGINT")
    text = window_report(df, key="item_id").first().report
    assert "time: 2024-01-01 01:00:00" in text and "No.1 item=7 count=3" in text


def test_hot_urls_static_filter(spark):
    df = frame(spark, "url STRING, event_time BIGINT",
               [("/a.css", 1), ("/a.css", 2), ("/page", 3)])
    got = {r.url for r in jobs.hot_urls(df, exclude_static=True).collect()}
    assert got == {"/page"}


def test_windowed_agg_with_pandas_udf(spark):
    import pandas as pd
    from tidewatch.operators.windows import windowed_agg

    @F.pandas_udf("double")
    def spread(v: pd.Series) -> float:
        return float(v.max() - v.min())

    df = frame(spark, "k STRING, v DOUBLE, event_time BIGINT",
               [("a", 1.0, 10), ("a", 4.0, 20), ("b", 2.0, 30), ("a", 9.0, 4000)])
    # Spark runs grouped pandas UDFs apart from built-in aggregates
    got = _rows(windowed_agg(df, "event_time", "1 hour", None, ["k"], spread("v").alias("spread")))
    assert got == [(ts(0), ts(3600), "a", 3.0), (ts(0), ts(3600), "b", 0.0),
                   (ts(3600), ts(7200), "a", 0.0)]
    got = _rows(windowed_agg(df, "event_time", "1 hour", "30 minutes", [], F.count("*").alias("n")))
    assert got[0] == (ts(-1800), ts(1800), 3)


@pytest.mark.parametrize("size,slide,span", [(3600, 300, 3 * 86400), (600, 5, 20000),
                                             (2 * 86400, 3600, 6 * 86400), (120, 60, 5000)])
def test_pane_sweep_matches_brute_force_for_shapes(spark, size, slide, span):
    import random
    rnd = random.Random(size + slide)
    rows = [(rnd.choice("abc"), 1, rnd.randrange(0, span)) for _ in range(250)]
    rows += [("a", 1, 86400 - 1), ("a", 1, 86400)]          # around a day edge
    df = frame(spark, DDL, rows)
    expect = {}
    for k, _, t in rows:
        first_end = (t // slide + 1) * slide
        for e in range(first_end, first_end + size, slide):
            expect[(ts(e), k)] = expect.get((ts(e), k), 0) + 1
    got = {(r.window_end, r.k): r.cnt for r in
           windowed_count(df, "event_time", size, slide, keys=["k"], panes=True).collect()}
    assert got == expect
    totals = {}
    for (e, _), c in expect.items():
        totals[e] = totals.get(e, 0) + c
    got = {r.window_end: r.cnt for r in
           windowed_count(df, "event_time", size, slide, panes=True).collect()}
    assert got == totals


def brute_windows(rows, size, slide):
    """Counts per (window end, key): windows start at every multiple of the slide."""
    out = {}
    for k, _, t in rows:
        start = t // slide * slide
        while start > t - size:
            out[ts(start + size), k] = out.get((ts(start + size), k), 0) + 1
            start -= slide
    return out


SHAPES = [(100, 7), (3600, 420), (95, 10), (600, 600), (10, 20), (200_000, 7_000)]


@pytest.mark.parametrize("size,slide", SHAPES)
def test_any_slide_gives_the_windows_of_the_definition(spark, size, slide):
    import random
    rnd = random.Random(size)
    rows = [(rnd.choice("ab"), rnd.randrange(5), 86_300 + rnd.randrange(0, 4 * min(size, 4000))) for _ in range(150)]
    df = frame(spark, DDL, rows)
    want = brute_windows(rows, size, slide)
    ntz = df.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
    for d in (df, ntz):
        for panes in (True, False):
            got = {(r.window_end, r.k): r.cnt for r in
                   windowed_count(d, "event_time", size, slide, keys=["k"], panes=panes).collect()}
            assert got == want, panes


@pytest.mark.parametrize("size,slide", [(100, 7), (3600, 420), (95, 10)])
def test_sliding_sketches_count_the_visitors_of_any_slide(spark, size, slide):
    import random
    rnd = random.Random(slide)
    rows = [("a", rnd.randrange(30), 86_300 + rnd.randrange(0, 2 * size)) for _ in range(120)]
    seen = {}
    for _, u, t in rows:
        for (end, _k) in brute_windows([("a", u, t)], size, slide):
            seen.setdefault(end, set()).add(u)
    got = {r.window_end: r.uv for r in windowed_distinct(frame(spark, DDL, rows), "event_time", size, "user_id",
                                                         slide=slide, method="hll").collect()}
    assert got == {end: len(us) for end, us in seen.items()}


def test_sweep_branch_of_count_sets_at_full_fan_out(spark):
    import random
    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), 1, rnd.randrange(0, 9000)) for _ in range(200)]
    df = frame(spark, DDL, rows)
    got = {(r.window_end, r.k): r.cnt for r in windowed_count_sets(df, "event_time", "1 hour", "10 seconds", ["k"]).collect()}
    want = brute_windows(rows, 3600, 10)
    for (end, _), n in list(want.items()):
        want[end, "total"] = want.get((end, "total"), 0) + n
    assert got == want


def test_sweep_takes_the_configured_partitions(spark):
    from tidewatch.operators.windows import _expansion_partitions
    df = spark.range(1)
    assert _expansion_partitions(df) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _expansion_partitions(df, 5000) == 5000


def _plan(df):
    import contextlib
    import io
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_bitmap_count_is_hashed_not_sorted(spark):
    ub = T.user_behavior(T.table(spark, SF_SMALL, "events"))
    assert "SortAggregate" not in _plan(jobs.unique_visitors(ub, behavior="view", method="bitmap"))


@pytest.mark.parametrize("n", [100, 5000])
def test_cap_is_limited_per_hour_before_the_day(spark, n):
    clicks = T.ad_click(T.table(spark, SF_SMALL, "events"))
    plan = _plan(jobs.ad_click_cap(clicks, n=n))
    assert plan.count("Window [") + plan.count("Window (") >= 2 or plan.count("+- Window") >= 2
    assert "_hour" in plan and (n > 1000 or "WindowGroupLimit" in plan)


def test_cap_equals_plain_numbering_at_any_n(spark):
    import random
    rnd = random.Random(8)
    rows = [(1, "a", 86400 * 3 + rnd.randrange(0, 200_000), k) for k in range(400)]
    df = frame(spark, "user_id BIGINT, ad_id STRING, event_time BIGINT, seq BIGINT", rows)
    for n in (1, 37, 1500):
        got = sorted((r.seq, r.outcome) for r in jobs.ad_click_cap(df, n=n).collect())
        want, days = [], {}
        for u, a, t, k in sorted(rows, key=lambda r: (r[2], r[3])):
            days[t // 86400] = days.get(t // 86400, 0) + 1
            if days[t // 86400] <= n + 1:
                want.append((k, "pass" if days[t // 86400] <= n else "warn"))
        assert got == sorted(want)
