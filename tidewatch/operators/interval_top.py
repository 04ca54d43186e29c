"""Top-N of sliding windows without a row per (key, window): interval top-N (R-1, R-2, W-3).

A key's count is constant over a stretch of windows (``sweep_stretches``).  The window
ends are cut into blocks of ``g`` and every key's stretches into cells, one per (key,
block), with the least and the greatest count of the key there:

1. *Bounds.*  A key whose stretches fill a block has its least count in all windows of
   it.  The N-th best of these (count, then key) bounds the block: what ranks behind it
   is in no window's top N.  Only N rows per block and task are shuffled for that
   (Spark's partial group limit).
2. *Pruning.*  A cell whose greatest count ranks behind its block's bound is dropped,
   before any row is made per window and before the shuffle of the next step.
3. *Intervals.*  Of what is left, every place in a block where some key's count changes
   is one bit of a mask; between two of them nothing changes, so rows are ranked once
   per interval.  Only the N winners of an interval become a row per window.

A block with fewer than N keys that fill it has no bound and keeps all its cells.
Cells of one block are sorted by Spark, not gathered, so many survivors spill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.operators.windows import _seconds, _time_of, pane_counts, sweep_stretches

#: Most window ends in a block: its change places are the bits of a long.
MOST = 60


def block_of(size_s: int, slide_s: int) -> int:
    """Window ends in a block: a quarter of those a row falls into, within the mask's width."""
    return max(2, min(MOST, size_s // slide_s // 4))


def _bit(at: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), at.cast("int"))


def cells(held: DataFrame, size_s: int, slide_s: int, key: str, name: str, g: int) -> DataFrame:
    """One row per (key, block) of the stretches ``held``: ``_sub`` (the block), ``_least`` (null
    where the key does not fill the block), ``_most``, ``_mask`` and the stretches' ``_pieces``.

    The grouping refines (key, owner bucket), by which the stretches are partitioned: no shuffle.
    """
    offset = size_s % slide_s
    lo, hi = (((F.col(c) - offset) / slide_s).cast("bigint") for c in ("_lo", "_hi"))
    cut_up = held.select(key, "_bk", name, lo.alias("_i"), hi.alias("_j")).withColumn(
        "_sub", F.explode(F.sequence(F.floor(F.col("_i") / g), F.floor(F.col("_j") / g))))
    base = F.col("_sub") * g
    placed = cut_up.withColumn("_a", (F.greatest("_i", base) - base).cast("int")) \
        .withColumn("_z", (F.least(F.col("_j"), base + (g - 1)) - base).cast("int"))
    bits = _bit(F.col("_a")).bitwiseOR(F.when(F.col("_z") < g - 1, _bit(F.col("_z") + 1)).otherwise(F.lit(0)))
    return (placed.groupBy(key, "_bk", "_sub")
            .agg(F.min(name).alias("_min"), F.max(name).alias("_most"), F.sum(F.col("_z") - F.col("_a") + 1).alias("_n"),
                 F.bit_or(bits).alias("_mask"),
                 F.collect_list(F.struct("_a", "_z", F.col(name).alias("_c"))).alias("_pieces"))
            .withColumn("_least", F.when(F.col("_n") == g, F.col("_min"))).drop("_min", "_n", "_bk"))


def bounds(found: DataFrame, key: str, n: int) -> DataFrame:
    """``_sub, _bc, _bkey``: the N-th best (least count, key) of the keys that fill a block."""
    order = Window.partitionBy("_sub").orderBy(F.desc("_least"), F.asc(key))
    return (found.where(F.col("_least").isNotNull()).select("_sub", "_least", key)
            .withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).where(F.col("_r") == n)
            .select("_sub", F.col("_least").alias("_bc"), F.col(key).alias("_bkey")))


def candidates(found: DataFrame, key: str, n: int) -> DataFrame:
    """The cells that may reach the top ``n`` of some window of their block, cut into intervals:
    ``_sub, _at, _last, key, _c``, the rows of the rank step."""
    behind = (F.col("_most") < F.col("_bc")) | ((F.col("_most") == F.col("_bc")) & (F.col(key) > F.col("_bkey")))
    alive = found.join(bounds(found, key, n), "_sub", "left").where(F.col("_bc").isNull() | ~behind)
    cuts = F.bit_or("_mask").over(Window.partitionBy("_sub"))
    piece = alive.select("_sub", key, cuts.alias("_cuts"), "_pieces") \
        .select("_sub", key, "_cuts", F.explode("_pieces").alias("_p"))
    is_cut = lambda i: F.call_function("shiftright", F.col("_cuts"), i).bitwiseAND(F.lit(1)) == 1
    starts = F.filter(F.sequence("_p._a", "_p._z"), is_cut)
    spans = F.transform("_starts", lambda at, i: F.struct(
        at.alias("at"), F.coalesce(F.get("_starts", i + 1) - 1, F.col("_p._z")).alias("last")))
    return (piece.withColumn("_starts", starts).withColumn("_s", F.explode(spans))
            .select("_sub", F.col("_s.at").alias("_at"), F.col("_s.last").alias("_last"), key, F.col("_p._c").alias("_c")))


def interval_top_n(df: DataFrame, ts: str, size: str | int, slide: str | int, key: str, n: int,
                   name: str = "cnt", rank_col: str = "rank", block: int | None = None) -> DataFrame:
    """``window_end, key, <name>, rank``: the ``n`` most frequent keys of every sliding window
    (ties by key ascending), the same rows as ranking ``windowed_count`` per window."""
    size_s, slide_s = _seconds(size), _seconds(slide)
    g = block or block_of(size_s, slide_s)
    if not 1 <= g <= MOST:
        raise ValueError(f"a block has 1 to {MOST} window ends")
    pane = pane_counts(df, ts, size_s, slide_s, [key])
    found = cells(sweep_stretches(pane, size_s, slide_s, [key], name), size_s, slide_s, key, name, g)
    order = Window.partitionBy("_sub", "_at").orderBy(F.desc("_c"), F.asc(key))
    top = (candidates(found, key, n).withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n))
    ends = F.explode(F.sequence("_at", "_last")).alias("_i")
    return (top.select("_sub", key, "_c", "_r", ends)
            .withColumn("_we", (F.col("_sub") * g + F.col("_i")) * slide_s + size_s % slide_s)
            .select(_time_of(pane, "_we").alias("window_end"), key, F.col("_c").alias(name),
                    F.col("_r").cast("bigint").alias(rank_col)))


