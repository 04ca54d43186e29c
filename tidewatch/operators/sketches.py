"""A table of stored distinct-count sketches (A-6), rolled up without reading events again.

``update`` writes one HyperLogLog sketch per (slot, keys), partitioned by the slot's UTC day;
a day that is written again replaces its sketches.  ``rollup`` unions the stored sketches
to any window whose size and slide are whole numbers of slots, and ``estimate`` to any
range; both read the partitions of their days only.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewatch.operators.windows import _seconds, _spec

#: Standard error of an estimate, by lg_k.
def error(lg_k: int) -> float:
    return 1.04 / 2 ** (lg_k / 2)


def sketches(events: DataFrame, ts: str, col: str, keys: Sequence[str] = (), slot: str | int = "1 hour",
             lg_k: int = 12) -> DataFrame:
    """``slot_start, *keys, sketch, day``: partial sketches are merged per (slot, keys)."""
    start = F.window(ts, _spec(_seconds(slot))).getField("start")
    return (events.where(F.col(col).isNotNull()).groupBy(start.alias("slot_start"), *keys)
            .agg(F.hll_sketch_agg(F.col(col), lg_k).alias("sketch"))
            .withColumn("day", F.to_date("slot_start")))


def update(events: DataFrame, base: str, ts: str, col: str, keys: Sequence[str] = (), slot: str | int = "1 hour",
           lg_k: int = 12) -> None:
    """Write the sketches of ``events``, which hold whole days; those days are replaced."""
    (sketches(events, ts, col, keys, slot, lg_k).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(base))


def stored(spark: SparkSession, base: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """The stored sketches of the days from ``first`` to ``last``."""
    table = spark.read.parquet(base)
    if first is not None:
        table = table.where(F.col("day") >= F.lit(first))
    return table if last is None else table.where(F.col("day") <= F.lit(last))


def rollup(table: DataFrame, size: str | int, slide: str | int | None = None, keys: Sequence[str] = (),
           name: str = "uv") -> DataFrame:
    """``window_end, *keys, <name>``: estimates for windows over the stored slots."""
    size_s = _seconds(size)
    slide_s = _seconds(slide) if slide is not None else size_s
    w = F.window("slot_start", _spec(size_s), _spec(slide_s)) if slide_s != size_s else F.window("slot_start", _spec(size_s))
    return (table.groupBy(w.alias("_w"), *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
            .select(F.col("_w").getField("end").alias("window_end"), *keys, name))


def estimate(table: DataFrame, start, end, keys: Sequence[str] = (), name: str = "uv") -> DataFrame:
    """``*keys, <name>`` over the slots that start in [start, end)."""
    inside = table.where((F.col("slot_start") >= F.lit(start)) & (F.col("slot_start") < F.lit(end)))
    return inside.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias(name))
