"""Two-sided matching: payments and receipts, creates and pays
(J-1 .. J-4, J-6, T-8, T-17).

Both operators first keep the earliest row per key on each side (a partial
+ final ``min`` aggregate, so a hot key is collapsed map-side).  The outer
join after that sees at most one row per key on either side: it cannot
fan out, and no key holds more than two rows in any task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _interval(seconds: int) -> Column:
    return F.expr(f"INTERVAL {int(seconds)} SECONDS")


def earliest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                     cols: Sequence[str], prefix: str) -> DataFrame:
    """One row per key: the first in ``order``; ``cols`` renamed ``prefix+c``."""
    payload = [c for c in cols if c not in order]
    best = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in payload]))
    return (df.groupBy(*keys).agg(best.alias("_e"))
            .select(*keys, *[F.col(f"_e.{c}").alias(prefix + c) for c in cols]))


def interval_match(left: DataFrame, right: DataFrame, key: str, order_l: Sequence[str],
                   order_r: Sequence[str], tolerance_s: int,
                   cols_l: Sequence[str] = (), cols_r: Sequence[str] = ()) -> DataFrame:
    """J-1: full outer equi-join on ``key`` with |Δt| <= ``tolerance_s``.

    Each side is first reduced to its earliest row per key (duplicates of a
    transaction are dropped, the earliest kept).  Output: ``key``, the left
    and right times and ``cols`` (prefixed ``l_``/``r_``) and ``outcome``:
    ``matched`` (J-2), ``left_only`` (J-3) or ``right_only`` (J-4).  A key on
    both sides but too far apart yields one row of each one-sided kind.
    """
    tl, tr = order_l[0], order_r[0]
    lcols = [tl, *[c for c in cols_l if c != tl]]
    rcols = [tr, *[c for c in cols_r if c != tr]]
    L = earliest_per_key(left, [key], order_l, lcols, "l_").withColumnRenamed(key, "_lk")
    R = earliest_per_key(right, [key], order_r, rcols, "r_").withColumnRenamed(key, "_rk")
    lt, rt = F.col("l_" + tl), F.col("r_" + tr)
    cond = ((F.col("_lk") == F.col("_rk")) & (rt >= lt - _interval(tolerance_s))
            & (rt <= lt + _interval(tolerance_s)))
    j = L.join(R, cond, "full_outer")
    outcome = (F.when(F.col("_lk").isNotNull() & F.col("_rk").isNotNull(), "matched")
               .when(F.col("_lk").isNotNull(), "left_only").otherwise("right_only"))
    return j.select(F.coalesce("_lk", "_rk").alias(key),
                    *[F.col("l_" + c) for c in lcols], *[F.col("r_" + c) for c in rcols],
                    outcome.alias("outcome"))


def first_pair_outcomes(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                        is_first: Column, is_second: Column, limit_s: int) -> DataFrame:
    """T-17: per key, the first ``first`` row and the first ``second`` row,
    in either arrival order, classified as

    ``paid``                0 <= Δ < limit
    ``paid_late``           Δ >= limit, or the second before the first
    ``unpaid``              first without second
    ``pay_without_create``  second without first

    Returns ``*keys, create_time, pay_time, outcome``.
    """
    ts = order[0]
    tagged = df.select(*keys, *order, is_first.alias("_a"), is_second.alias("_b"))
    key_struct = F.struct(*[F.col(c) for c in order])
    per_key = (tagged.where(F.col("_a") | F.col("_b")).groupBy(*keys)
               .agg(F.min(F.when(F.col("_a"), key_struct)).alias("_c"),
                    F.min(F.when(F.col("_b"), key_struct)).alias("_p")))
    c, p = F.col(f"_c.{ts}"), F.col(f"_p.{ts}")
    outcome = (F.when(c.isNotNull() & p.isNotNull() & (p >= c) & (p < c + _interval(limit_s)), "paid")
               .when(c.isNotNull() & p.isNotNull(), "paid_late")
               .when(c.isNotNull(), "unpaid").otherwise("pay_without_create"))
    return per_key.select(*keys, c.alias("create_time"), p.alias("pay_time"),
                          outcome.alias("outcome"))
