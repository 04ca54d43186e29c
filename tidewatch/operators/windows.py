"""Event-time window aggregates (W-1 .. W-5, A-1 .. A-9, P-3).

Windows are half-open and aligned to the epoch, as ``window()`` gives them.
Results carry ``window_end`` (the reference's ``windowEnd``), the keys and
the measure.

Sliding windows multiply every input row by ``size / slide``.  When that
factor is large the *pane path* counts first per (key, pane; one slide wide, or
gcd(size, slide) where the slide does not divide the size) and only then
spreads each pane to the windows that contain it, so the fan-out applies to
pane counts rather than raw rows (SURVEY §4).  Both paths
plan as partial + final hash aggregates: a hot key or a busy window is
combined map-side before any shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.functions.hashing import bitmap_offset

# From this many windows per row on, the pane sweep is taken by default: it
# shuffles pane counts twice, where ``window()`` shuffles up to ``size/slide``
# partial counts per pane.  Below it the extra sort does not pay.
PANE_FANOUT = 10


def _seconds(spec: str | int) -> int:
    """'1 hour' / '5 minutes' / '10 seconds' / 300 -> seconds."""
    if isinstance(spec, int):
        return spec
    n, unit = spec.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return int(n) * mult[unit.rstrip("s")]


def _spec(seconds: int) -> str:
    return f"{seconds} seconds"


def _keys(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def _expansion_partitions(df: DataFrame, partitions: int | None = None) -> int:
    """Partitions for a shuffle whose output grows ``size/slide``-fold: the
    caller's number or ``spark.sql.shuffle.partitions``.  It is given
    explicitly, because AQE would coalesce the small pane rows by their bytes."""
    return partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def pane_seconds(size_s: int, slide_s: int) -> int:
    """Width of a pane: every window is a whole number of panes, also when the
    slide does not divide the size."""
    return math.gcd(size_s, slide_s)


def _owner_bucket_seconds(size_s: int, slide_s: int) -> int:
    """Time bucket that owns window ends: one day, or more for longer windows,
    a whole number of slides."""
    b = max(86400, size_s)
    return -(-b // slide_s) * slide_s


def _pane_second(pane: DataFrame) -> Column:
    """Start of a pane (``_ps``) in seconds since the epoch, zone-free for a
    ``TIMESTAMP_NTZ``."""
    if dict(pane.dtypes)["_ps"] == "timestamp_ntz":
        return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', _ps)")
    return F.unix_seconds("_ps")


def _time_of(pane: DataFrame, second: str) -> Column:
    """Back from seconds to the pane's own time type."""
    if dict(pane.dtypes)["_ps"] == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ'1970-01-01 00:00:00' + "
                      f"make_dt_interval(CAST({second} DIV 86400 AS INT), 0, 0, {second} % 86400)")
    return F.timestamp_seconds(second)


class _Grid:
    """Window ends of one (size, slide), in seconds: ``size`` after every
    multiple of the slide.  Panes start at multiples of ``gcd(size, slide)``,
    which also divides every end, so a pane ``[p, p + g)`` lies in the windows
    that end from ``up(p + g)`` to the last end not after ``p + size``."""

    def __init__(self, size_s: int, slide_s: int):
        self.size, self.slide, self.pane = size_s, slide_s, pane_seconds(size_s, slide_s)
        self.bucket = _owner_bucket_seconds(size_s, slide_s)

    def up(self, t: Column) -> Column:
        """The first window end at or after ``t``."""
        return t + F.pmod(F.lit(self.size % self.slide) - t, F.lit(self.slide))

    def first(self, pane: Column) -> Column:
        return self.up(pane + self.pane)

    def after(self, pane: Column) -> Column:
        """The first end whose window no longer holds the pane."""
        return self.up(pane + self.size + self.pane)

    def owner(self, end: Column) -> Column:
        """Bucket ``b`` owns the ends in ``(b, b + bucket]``."""
        at = end - self.pane
        return at - F.pmod(at, F.lit(self.bucket))

    def owners(self, pane: Column) -> Column:
        """The (at most two) buckets that own a window holding the pane."""
        return F.array_distinct(F.array(self.owner(self.first(pane)),
                                        self.owner(self.after(pane) - self.slide)))

    def bucket_first(self) -> Column:
        return self.up(F.col("_bk") + self.pane)

    def bucket_after(self) -> Column:
        return self.up(F.col("_bk") + self.bucket + self.pane)

    def ends(self) -> Column:
        return F.explode(F.sequence("_lo", "_hi", F.lit(self.slide).cast("bigint"))).alias("_we")


def spread_panes(pane: DataFrame, size_s: int, slide_s: int, part: Sequence[str],
                 partitions: int | None = None) -> DataFrame:
    """Pane rows (``_ps`` = pane start, plus keys and measures) -> one row per
    (window end, pane) for the sliding windows that contain the pane.

    The windows are generated after a shuffle of the *pane* rows on
    ``part`` + an owner bucket ``_bk``: bucket ``b`` owns the window ends in
    ``(b, b + B]``, and a pane is sent to each (at most two) bucket owning a
    window that contains it.  A later ``groupBy('_we', *part, '_bk')`` (``_we``:
    the window end in seconds) is then satisfied by this partitioning, so the
    exploded rows are summed where they are made and never cross the network.
    A key's rows per task are bounded by the panes of a bucket, however hot the
    key.
    """
    grid = _Grid(size_s, slide_s)
    p = F.col("_p")
    shuffled = (pane.withColumn("_p", _pane_second(pane)).drop("_ps")
                .withColumn("_bk", F.explode(grid.owners(p)))
                .repartition(_expansion_partitions(pane, partitions), *[F.col(c) for c in part],
                             F.col("_bk")))
    return (shuffled.withColumn("_lo", F.greatest(grid.first(p), grid.bucket_first()))
            .withColumn("_hi", F.least(grid.after(p), grid.bucket_after()) - slide_s)
            .where("_lo <= _hi").withColumn("_we", grid.ends()).drop("_lo", "_hi", "_p"))


def sweep_stretches(pane: DataFrame, size_s: int, slide_s: int, keys: Sequence[str],
                    name: str = "cnt", partitions: int | None = None) -> DataFrame:
    """Sliding-window sums of pane counts (``_ps``, ``*keys``, ``_n``) as stretches of
    window ends with one count: ``*keys, _bk, _lo, _hi, <name>``, found by a sweep.

    A pane adds ``_n`` at the first window end that holds it and takes it off
    at the first one that no longer does.  Per (key, owner bucket) the change
    points are summed, and a running sum over them gives the count from one change
    point to the next, from the first window end ``_lo`` to the last ``_hi`` (seconds).

    Partitioning: pane rows are shuffled once on (keys, owner bucket).  The
    change-point aggregate and the running sum reuse that partitioning, so no
    further exchange is planned.  A key holds at most the panes of one bucket
    and of one window in a task, however hot it is.
    """
    grid = _Grid(size_s, slide_s)
    p = F.col("_p")
    shuffled = (pane.withColumn("_p", _pane_second(pane)).drop("_ps")
                .withColumn("_bk", F.explode(grid.owners(p)))
                .repartition(_expansion_partitions(pane, partitions), *[F.col(c) for c in keys],
                             F.col("_bk")))
    deltas = shuffled.select(
        *keys, "_bk",
        F.explode(F.array(F.struct(grid.first(p).alias("t"), F.col("_n").alias("d")),
                          F.struct(grid.after(p).alias("t"), (-F.col("_n")).alias("d")))).alias("_c"))
    points = (deltas.groupBy(*keys, "_bk", F.col("_c.t").alias("_t"))
              .agg(F.sum("_c.d").alias("_d")))
    spec = Window.partitionBy(*keys, "_bk").orderBy("_t")
    run = (points
           .withColumn(name, F.sum("_d").over(spec.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
           .withColumn("_next", F.lead("_t").over(spec)))
    return (run.where((F.col(name) > 0) & F.col("_next").isNotNull())
            .withColumn("_lo", F.greatest(F.col("_t"), grid.bucket_first()))
            .withColumn("_hi", F.least(F.col("_next"), grid.bucket_after()) - slide_s)
            .where("_lo <= _hi").select(*keys, "_bk", "_lo", "_hi", name))


def sweep_pane_counts(pane: DataFrame, size_s: int, slide_s: int, keys: Sequence[str],
                      name: str = "cnt", partitions: int | None = None) -> DataFrame:
    """``window_end, *keys, <name>``, one row per non-empty window: the stretches of
    ``sweep_stretches``, each with its window ends from ``sequence``.  Every output row is
    produced exactly once and no aggregate ever runs over the exploded rows."""
    held = sweep_stretches(pane, size_s, slide_s, keys, name, partitions)
    return (held.select(_Grid(size_s, slide_s).ends(), *keys, name)
            .select(_time_of(pane, "_we").alias("window_end"), *keys, name))


def pane_counts(df: DataFrame, ts: str, size_s: int, slide_s: int, keys: Sequence[str | Column]) -> DataFrame:
    """Rows counted per (pane, keys): ``_ps, *keys, _n``."""
    start = F.window(ts, _spec(pane_seconds(size_s, slide_s))).getField("start")
    return df.groupBy(start.alias("_ps"), *keys).agg(F.count(F.lit(1)).alias("_n"))


def _use_panes(size: int, slide: int | None, panes: bool | str) -> bool:
    if slide is None or slide == size:
        return False
    if slide > size:                                       # windows with gaps: window() has none
        return True
    if panes == "auto":
        return size // slide >= PANE_FANOUT
    return bool(panes)


def windowed_count(df: DataFrame, ts: str, size: str | int, slide: str | int | None = None,
                   keys: Sequence[str | Column] = (), name: str = "cnt",
                   panes: bool | str = "auto") -> DataFrame:
    """``count(*)`` per (window, keys) -> ``window_end, *keys, <name>``."""
    size_s = _seconds(size)
    slide_s = _seconds(slide) if slide is not None else None
    keys = _keys(keys)
    if _use_panes(size_s, slide_s, panes):
        pane = pane_counts(df, ts, size_s, slide_s, keys)
        key_names = [c for c in pane.columns if c not in ("_ps", "_n")]
        return sweep_pane_counts(pane, size_s, slide_s, key_names, name)
    else:
        w = (F.window(ts, _spec(size_s), _spec(slide_s)) if slide_s
             else F.window(ts, _spec(size_s)))
        out = df.groupBy(w.alias("_w"), *keys).agg(F.count(F.lit(1)).alias(name))
    rest = [c for c in out.columns if c not in ("_w",)]
    return out.select(F.col("_w").getField("end").alias("window_end"), *rest)


def windowed_distinct(df: DataFrame, ts: str, size: str | int, col: str,
                      slide: str | int | None = None, keys: Sequence[str | Column] = (),
                      name: str = "uv", method: str = "exact", lg_k: int = 12) -> DataFrame:
    """Distinct ``col`` per (window, keys).

    exact   ``count(DISTINCT col)``: Spark de-duplicates (window, keys, col)
            in a partial aggregate, shuffles on that triple, then counts, so
            no window's visitors are ever held in one set (A-4).
    bitmap  distinct offsets of the reference's 2^29-bit bitmap hash (A-5),
            collisions included: a visitor is its bit, and the set bits are
            counted as the exact form counts visitors, by hash aggregates.
    hll     mergeable HyperLogLog sketches (A-6); with a sliding window each
            pane keeps one sketch and windows union their panes' sketches.
    """
    keys = _keys(keys)
    size_s = _seconds(size)
    slide_s = _seconds(slide) if slide is not None else None
    if method == "hll":
        if slide_s and slide_s != size_s:
            pane = (df.groupBy(F.window(ts, _spec(pane_seconds(size_s, slide_s))).getField("start").alias("_ps"), *keys)
                    .agg(F.hll_sketch_agg(F.col(col), lg_k).alias("_sk")))
            key_names = [c for c in pane.columns if c not in ("_ps", "_sk")]
            ends = spread_panes(pane, size_s, slide_s, key_names)
            return (ends.groupBy("_we", *key_names, "_bk")
                    .agg(F.hll_sketch_estimate(F.hll_union_agg("_sk")).alias(name))
                    .select(_time_of(pane, "_we").alias("window_end"), *key_names, name))
        else:
            out = (df.groupBy(F.window(ts, _spec(size_s)).alias("_w"), *keys)
                   .agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(col), lg_k)).alias(name)))
    elif method == "bitmap":
        w = (F.window(ts, _spec(size_s), _spec(slide_s)) if slide_s
             else F.window(ts, _spec(size_s)))
        out = df.groupBy(w.alias("_w"), *keys).agg(F.count_distinct(bitmap_offset(col)).alias(name))
    else:
        w = (F.window(ts, _spec(size_s), _spec(slide_s)) if slide_s
             else F.window(ts, _spec(size_s)))
        out = df.groupBy(w.alias("_w"), *keys).agg(F.count_distinct(F.col(col)).alias(name))
    rest = [c for c in out.columns if c != "_w"]
    return out.select(F.col("_w").getField("end").alias("window_end"), *rest)


def windowed_count_sets(df: DataFrame, ts: str, size: str | int, slide: str | int,
                        keys: Sequence[str], total_label: str = "total",
                        name: str = "cnt") -> DataFrame:
    """Per-key counts and the window total from one read (A-7 + A-8), the
    result of ``GROUPING SETS ((w, *keys), (w))``.  In total rows every key
    column holds ``total_label``.

    High fan-out: one pane aggregate feeds two sweeps (per key, and over
    pane counts summed across keys).  Low fan-out: ``window()`` and
    ``GROUPING SETS`` in one aggregate; the partial aggregate collapses the
    expanded rows map-side, so what is shuffled is already per (window,
    keys) of each task.
    """
    size_s, slide_s = _seconds(size), _seconds(slide)
    if _use_panes(size_s, slide_s, "auto"):
        pane = pane_counts(df, ts, size_s, slide_s, keys)
        per_key = sweep_pane_counts(pane, size_s, slide_s, list(keys), name)
        pane_total = pane.groupBy("_ps").agg(F.sum("_n").alias("_n"))
        totals = (sweep_pane_counts(pane_total, size_s, slide_s, [], name)
                  .select("window_end", *[F.lit(total_label).alias(k) for k in keys], name))
        return per_key.unionByName(totals)
    w = (F.window(ts, _spec(size_s), _spec(slide_s)) if slide_s != size_s
         else F.window(ts, _spec(size_s)))
    total = (1 << len(keys)) - 1
    agg = (df.select(w.getField("end").alias("window_end"), *keys)
           .groupingSets([["window_end", *keys], ["window_end"]], "window_end", *keys)
           .agg(F.count(F.lit(1)).alias(name), F.grouping_id().alias("_g")))
    cols = [F.when(F.col("_g") == total, F.lit(total_label)).otherwise(F.col(k)).alias(k)
            for k in keys]
    return agg.select("window_end", *cols, name)


def windowed_agg(df: DataFrame, ts: str, size: str | int, slide: str | int | None,
                 keys: Sequence[str | Column], *aggs: Column) -> DataFrame:
    """X-10/X-11: any aggregates per (window, keys), built-in or a grouped
    pandas UDF supplied by the caller -> ``window_start, window_end, *keys,
    *aggs``.  The window bounds play the reference's window-function
    context (``window.getEnd``)."""
    size_s = _seconds(size)
    slide_s = _seconds(slide) if slide is not None else None
    w = (F.window(ts, _spec(size_s), _spec(slide_s)) if slide_s and slide_s != size_s
         else F.window(ts, _spec(size_s)))
    out = df.groupBy(w.alias("_w"), *_keys(keys)).agg(*aggs)
    rest = [c for c in out.columns if c != "_w"]
    return out.select(F.col("_w.start").alias("window_start"),
                      F.col("_w.end").alias("window_end"), *rest)
