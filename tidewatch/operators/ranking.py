"""Top-N per window and its text report (R-1 .. R-5, T-9).

``row_number() <= N`` lets Spark place a *partial* window-group limit before
the shuffle: every map task forwards at most N rows per window, so a window
with millions of keys never lands whole in one task.  Ties on the measure
are broken by key ascending (the reference leaves them to arrival order).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.functions.time import display_time


def top_n_per_window(df: DataFrame, n: int, key: str, by: str = "cnt",
                     window_col: str = "window_end", rank_col: str = "rank",
                     partition: Sequence[str] = ()) -> DataFrame:
    """Rows ranked 1..N by ``by`` descending within each window (and
    ``partition`` columns), with a BIGINT ``rank`` column."""
    spec = (Window.partitionBy(window_col, *partition)
            .orderBy(F.col(by).desc(), F.col(key).asc()))
    ranked = df.withColumn("_rn", F.row_number().over(spec)).where(F.col("_rn") <= n)
    return ranked.withColumn(rank_col, F.col("_rn").cast("bigint")).drop("_rn")


def window_report(top: DataFrame, key: str, by: str = "cnt", window_col: str = "window_end",
                  rank_col: str = "rank", label: str = "item") -> DataFrame:
    """One text block per window (R-4): banner, time, one line per rank.

    Collects at most N rows per window (the input is already top-N)."""
    lines = F.transform(
        F.sort_array(F.collect_list(F.struct(F.col(rank_col), F.col(key).cast("string").alias("k"),
                                             F.col(by).alias("v")))),
        lambda r: F.format_string(f"No.%d {label}=%s count=%d", r["rank"] if rank_col == "rank"
                                  else r[rank_col], r["k"], r["v"]))
    banner = F.lit("=" * 40)
    return (top.groupBy(window_col)
            .agg(F.concat_ws("\n", banner, F.concat(F.lit("time: "), display_time(F.col(window_col))),
                             F.array_join(lines, "\n"), banner).alias("report")))
