"""Ordered per-key patterns: strict pairs, followed-by with time-out, bursts
(M-1 .. M-5, T-18).

All three need each key's events in time order.  Partitioning a window
function by the key alone would put a hot key (a third of all rows, say)
into one task.  Instead rows are partitioned by (key, time bucket), and
each bucket also receives a *halo*: copies of the neighbouring bucket's
rows that lie within the pattern's time limit of the shared edge.  A
pattern bounded by ``within`` then never needs rows beyond its own bucket
and halo, so one key's history is spread over as many tasks as it has
buckets, and every frame is a running one (linear, spill-able sorts).

The halo is produced with ``explode`` on a one- or two-element array, so
the input is scanned once; at most ``within / bucket`` of the rows are
copied (25 % with the default bucket of four limits).  Buckets are at least
a minute for pairs (so a key's burst of activity still spreads over many
tasks) and an hour for bursts (which also keep one summary row per key and
bucket).

``order`` is the event-time column followed by tie-break columns: rows with
equal event time are taken in tie-break order, so results never depend on
how the input happened to be split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

MIN_BUCKET_SECONDS = 60
MIN_RUN_BUCKET_SECONDS = 3600


def default_bucket(limit_seconds: int, floor: int = MIN_BUCKET_SECONDS) -> int:
    return max(4 * limit_seconds, floor)


def _interval(seconds: int) -> Column:
    return F.expr(f"INTERVAL {int(seconds)} SECONDS")


def _with_halo(df: DataFrame, ts: str, bucket_s: int, halo_s: int, ahead: bool) -> DataFrame:
    """Add ``_b`` (bucket start) and ``_halo``; copy edge rows to the neighbour.

    ahead=True : rows in the first ``halo_s`` of bucket b are copied into
                 bucket b-1 (a row's *next* events within the limit).
    ahead=False: rows in the last ``halo_s`` of bucket b (edge included) are
                 copied into bucket b+1 (a row's *previous* event).
    """
    if halo_s > bucket_s:
        raise ValueError("bucket must be at least the pattern's time limit")
    b = F.window(ts, f"{bucket_s} seconds").getField("start")
    own = F.struct(b.alias("b"), F.lit(False).alias("h"))
    if ahead:
        near = F.col(ts) < b + _interval(halo_s)
        other = F.struct((b - _interval(bucket_s)).alias("b"), F.lit(True).alias("h"))
    else:
        near = F.col(ts) >= b + _interval(bucket_s - halo_s)
        other = F.struct((b + _interval(bucket_s)).alias("b"), F.lit(True).alias("h"))
    parts = F.when(near, F.array(own, other)).otherwise(F.array(own))
    return (df.withColumn("_p", F.explode(parts))
            .withColumn("_b", F.col("_p.b")).withColumn("_halo", F.col("_p.h")).drop("_p"))


def _order_cols(order: Sequence[str], desc: bool = False) -> list[Column]:
    return [F.col(c).desc() if desc else F.col(c).asc() for c in order]


def strict_pairs(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 first: Column, then: Column, within_s: int,
                 carry: Sequence[str] = (), bucket_s: int | None = None) -> DataFrame:
    """M-1: a ``first`` row whose very next row of the same key is a ``then``
    row, less than ``within_s`` later (strict contiguity, ``next``).

    Overlapping matches are all kept (a chain of three gives two pairs).
    Returns ``*keys, start_time, end_time`` plus ``first_<c>``/``next_<c>``
    for each ``carry`` column.  ``keys=()`` matches across the whole stream,
    as the reference's unkeyed pattern does.
    """
    ts = order[0]
    bucket_s = bucket_s or default_bucket(within_s)
    x = df.select(*keys, *order, *[c for c in carry if c not in order],
                  first.alias("_first"), then.alias("_then"))
    x = _with_halo(x, ts, bucket_s, within_s, ahead=True)
    spec = Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order))
    nxt = {c: F.lead(c).over(spec) for c in {ts, "_then", *carry}}
    x = x.select("*", *[v.alias(f"_next_{c}") for c, v in nxt.items()])
    hit = (~F.col("_halo") & F.col("_first") & F.coalesce(F.col("_next__then"), F.lit(False))
           & (F.col(f"_next_{ts}") < F.col(ts) + _interval(within_s)))
    return x.where(hit).select(
        *keys, F.col(ts).alias("start_time"), F.col(f"_next_{ts}").alias("end_time"),
        *[F.col(c).alias(f"first_{c}") for c in carry],
        *[F.col(f"_next_{c}").alias(f"next_{c}") for c in carry])


def followed_by(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                first: Column, then: Column, within_s: int,
                carry: Sequence[str] = (), bucket_s: int | None = None) -> DataFrame:
    """M-2 + M-4: every ``first`` row with the earliest later ``then`` row of
    its key less than ``within_s`` after it (relaxed contiguity,
    ``followedBy``), else a time-out.

    Returns ``*keys, start_time, end_time (NULL on time-out), matched`` and
    ``then_<c>`` for each ``carry`` column of the matching row.  Several
    ``first`` rows before one ``then`` all match it, as partial matches do.
    The earliest later row is a running minimum over the rows in descending
    order, so each bucket is one linear pass.
    """
    ts = order[0]
    bucket_s = bucket_s or default_bucket(within_s)
    extra = [c for c in carry if c not in order]
    x = df.select(*keys, *order, *extra, first.alias("_first"), then.alias("_then"))
    x = _with_halo(x, ts, bucket_s, within_s, ahead=True)
    later = (Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order, desc=True))
             .rowsBetween(Window.unboundedPreceding, -1))
    cand = F.when(F.col("_then"), F.struct(*[F.col(c) for c in order],
                                           *[F.col(c).alias(f"then_{c}") for c in carry]))
    x = x.withColumn("_m", F.min(cand).over(later)).where(~F.col("_halo") & F.col("_first"))
    ok = F.col("_m").isNotNull() & (F.col(f"_m.{ts}") < F.col(ts) + _interval(within_s))
    return x.select(
        *keys, F.col(ts).alias("start_time"),
        F.when(ok, F.col(f"_m.{ts}")).alias("end_time"), ok.alias("matched"),
        *[F.when(ok, F.col(f"_m.then_{c}")).alias(f"then_{c}") for c in carry])


def bursts(df: DataFrame, keys: Sequence[str], order: Sequence[str], gap_s: int,
           min_count: int = 2, bucket_s: int | None = None) -> DataFrame:
    """T-18: runs of a key's rows with no gap above ``gap_s`` (a gap of exactly
    ``gap_s`` still joins), kept when they hold at least ``min_count`` rows.

    Returns ``*keys, start_time, end_time, n``.  A run may span any number of
    buckets.  Each row is flagged as a run start from its previous row (found
    through the halo), and rows are collapsed into *segments*: the rows of
    one bucket that follow the same start (the bucket's leading rows, whose
    run began earlier, form its *head* segment).  Only heads need
    information from other buckets: the latest start before their bucket, a
    running maximum over one summary row per (key, bucket).  Segments are
    then summed per run.  The rows are read and sorted once; everything
    after the segments is small (bounded by runs and buckets, not rows).
    """
    ts = order[0]
    bucket_s = bucket_s or default_bucket(gap_s, MIN_RUN_BUCKET_SECONDS)
    x = _with_halo(df.select(*keys, *order), ts, bucket_s, gap_s, ahead=False)
    spec = Window.partitionBy(*keys, "_b").orderBy(*_order_cols(order))
    x = x.withColumn("_prev", F.lag(ts).over(spec)).where(~F.col("_halo"))
    is_start = F.col("_prev").isNull() | (F.col(ts) > F.col("_prev") + _interval(gap_s))
    start_at = F.when(is_start, F.col(ts))
    x = x.withColumn("_local", F.max(start_at).over(spec.rowsBetween(Window.unboundedPreceding, 0)))
    segs = (x.groupBy(*keys, "_b", "_local")
            .agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("_first"), F.max(ts).alias("_last")))

    heads = segs.where(F.col("_local").isNull())
    per_bucket = (segs.groupBy(*keys, "_b")
                  .agg(F.max("_local").alias("_last_start"),
                       F.max(F.when(F.col("_local").isNull(), F.col("n"))).alias("_head_n")))
    before = (Window.partitionBy(*keys).orderBy("_b")
              .rowsBetween(Window.unboundedPreceding, -1))
    carried = (per_bucket.select(*keys, "_b", "_head_n",
                                 F.max("_last_start").over(before).alias("_run"))
               .where(F.col("_head_n").isNotNull()).drop("_head_n"))
    # null-safe keys: no inferred IS NOT NULL filter, so every branch keeps the
    # same plan below ``segs`` and Spark reuses its shuffle instead of
    # reading the input again
    c = carried.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_b").alias("_c_b"), "_run")
    cond = F.col("_b").eqNullSafe(F.col("_c_b"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    head_runs = heads.join(c, cond).select(*keys, "_run", "n", "_first", "_last")
    body_runs = (segs.where(F.col("_local").isNotNull())
                 .select(*keys, F.col("_local").alias("_run"), "n", "_first", "_last"))
    return (body_runs.unionByName(head_runs).groupBy(*keys, "_run")
            .agg(F.sum("n").alias("n"), F.min("_first").alias("start_time"),
                 F.max("_last").alias("end_time"))
            .where(F.col("n") >= min_count)
            .select(*keys, "start_time", "end_time", "n"))


def sequence_match(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: Column,
                   then: Column, within_s: int, contiguity: str = "strict",
                   carry: Sequence[str] = (), bucket_s: int | None = None) -> DataFrame:
    """Two-step pattern ``first`` -> ``then`` within ``within_s`` per key
    (M-1 .. M-5), bound to a keyed (``keys``) or unkeyed (``()``) stream.

    ``strict``   the very next row must be a ``then`` row (``next``); only
                 matches are returned.
    ``relaxed``  any later ``then`` row (``followedBy``); every ``first`` row
                 is returned, ``matched`` false for a time-out.
    """
    if contiguity == "strict":
        return strict_pairs(df, keys, order, first, then, within_s, carry, bucket_s)
    if contiguity == "relaxed":
        return followed_by(df, keys, order, first, then, within_s, carry, bucket_s)
    raise ValueError("contiguity is 'strict' or 'relaxed'")
