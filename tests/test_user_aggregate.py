"""Mergeable user aggregates and stored sketches against plain Python."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidewatch.operators import sketches as K
from tidewatch.operators.user_aggregate import HistogramMedian, UserAggregate, user_agg, windowed_user_agg
from tidewatch.operators.windows import windowed_distinct

from helpers import epoch, frame

ROW = "user_id BIGINT, kind STRING, value DOUBLE, event_time BIGINT"


def _rows(seed, n):
    r = random.Random(seed)
    hot = [("hot", r.gauss(50, 30)) for _ in range(n // 3)]
    rest = [(r.choice("abcdef") if r.random() > 0.05 else None, r.choice([None, math.nan, r.gauss(0, 99)])) for _ in range(n - n // 3)]
    return [(k % 17, kind, v, r.randrange(3 * 3600)) for k, (kind, v) in enumerate(hot + rest)]


def _brute(rows, width, size=3600, slide=3600):
    groups = defaultdict(list)
    for _, kind, v, t in rows:
        end = (t // slide) * slide + slide
        while end - size <= t:
            groups[end, kind].append(v)
            end += slide
    out = {}
    for g, vs in groups.items():
        bins = sorted(math.floor(v / width) for v in vs if v is not None and math.isfinite(v))
        c = Counter(bins)
        out[g] = (len(bins), bins[(len(bins) - 1) // 2] if bins else None, min(c, key=lambda b: (-c[b], b)) if c else None)
    return out


def _found(df):
    return {(epoch(r.window_end), r.kind): (r.n, r.median_bin, r.peak_bin) for r in df.collect()}


def test_user_aggregate_equals_plain_python(spark):
    rows = _rows(1, 900)
    df = frame(spark, ROW, rows).repartition(5)
    agg = HistogramMedian("value", 10.0)
    got = windowed_user_agg(df, "event_time", "1 hour", None, ["kind"], agg, ["value"])
    assert got.columns == ["window_end", "kind", "n", "median_bin", "peak_bin"]
    assert _found(got) == _brute(rows, 10.0)
    slid = windowed_user_agg(df, "event_time", "1 hour", "20 minutes", ["kind"], agg, ["value"], held=3)
    assert _found(slid) == _brute(rows, 10.0, 3600, 1200)          # also with a dictionary that is full at once
    assert windowed_user_agg(df.where("false"), "event_time", "1 hour", None, ["kind"], agg, ["value"]).count() == 0


def test_a_hot_key_moves_one_accumulator_per_task(spark):
    df = spark.range(20_000).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("value")).repartition(6)

    class Counted(UserAggregate):
        output = "n BIGINT, merges BIGINT"

        def create(self):
            return (0, 0)

        def add(self, acc, rows):
            return acc[0] + len(rows["value"]), acc[1]

        def merge(self, a, b):
            return a[0] + b[0], a[1] + b[1] + 1

        def result(self, acc):
            return acc

    (row,) = user_agg(df, ["k"], Counted(), ["value"]).collect()
    assert row.n == 20_000 and row.merges <= 5


def test_stored_sketches_roll_up_and_are_replaced(spark, tmp_path):
    r = random.Random(3)
    rows = [(r.randrange(400), None, 0.0, r.randrange(4 * 86400)) for _ in range(6000)]
    df = frame(spark, ROW, rows)
    base = str(tmp_path / "sketches")
    K.update(df.where("event_time < '1970-01-04'"), base, "event_time", "user_id")
    K.update(df.where("event_time >= '1970-01-03'"), base, "event_time", "user_id")      # the third day again, and the fourth
    table = K.stored(spark, base)
    assert table.count() == df.select(F.date_trunc("hour", "event_time")).distinct().count()
    near = 3 * K.error(12)
    for size, slide in (("1 day", None), ("12 hours", "3 hours")):
        exact = {r.window_end: r.uv for r in windowed_distinct(df, "event_time", size, "user_id", slide).collect()}
        got = {r.window_end: r.uv for r in K.rollup(table, size, slide).collect()}
        assert set(got) == set(exact) and all(abs(got[w] - exact[w]) <= max(1, near * exact[w]) for w in exact)
    lo, hi = "1970-01-02 06:00:00", "1970-01-03 18:00:00"
    want = df.where((F.col("event_time") >= lo) & (F.col("event_time") < hi)).select("user_id").distinct().count()
    from datetime import date, datetime
    part = K.stored(spark, base, date(1970, 1, 2), date(1970, 1, 3))
    got = K.estimate(part, datetime(1970, 1, 2, 6), datetime(1970, 1, 3, 18)).first().uv
    assert abs(got - want) <= near * want
    assert "PartitionFilters: [isnotnull(day" in part._jdf.queryExecution().toString()
    # a day that is written again with fewer rows counts those only
    K.update(df.where("event_time < '1970-01-02' AND user_id < 10"), base, "event_time", "user_id")
    first = {epoch(r.window_end): r.uv for r in K.rollup(K.stored(spark, base), "1 day").collect()}
    assert first[86400] == 10 and first[2 * 86400] > 300
