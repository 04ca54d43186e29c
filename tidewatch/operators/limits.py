"""Per-key rate cap with a warning (T-6, T-5, T-7).

Rows of each (keys, UTC day) group are numbered in event-time order: the
first ``n`` pass, row ``n + 1`` becomes the one warning, later rows are
dropped (that is the cap itself).  The first ``n + 1`` rows of a day lie within
the first ``n + 1`` rows of each hour of it, so rows are first limited per
(key, hour) and only the survivors are numbered per day.  A hot key's day is
thus spread over its hours, whatever ``n`` is; where Spark also plans its
partial group limit (``n`` under its threshold) even less is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tidewatch.functions.time import utc_day


def cap_per_key(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[str],
                daily: bool = True, day_col: str = "day") -> DataFrame:
    """All input columns plus ``day`` (when daily), ``seq_no`` and
    ``outcome`` = ``pass`` | ``warn``; rows past ``n + 1`` are left out."""
    ts = order[0]
    part = [*keys]
    if daily:
        df = df.withColumn(day_col, utc_day(ts, ntz=dict(df.dtypes)[ts] == "timestamp_ntz"))
        part.append(day_col)
    first = [F.col(c) for c in order]
    t = F.col(ts)
    hour = F.hour(t) if dict(df.dtypes)[ts] == "timestamp_ntz" else F.floor(F.unix_seconds(t) / 3600)
    hourly = Window.partitionBy(*part, "_hour").orderBy(*first)
    df = (df.withColumn("_hour", hour).withColumn("_rh", F.row_number().over(hourly))
          .where(F.col("_rh") <= n + 1).drop("_rh", "_hour"))
    spec = Window.partitionBy(*part).orderBy(*first)
    out = df.withColumn("_rn", F.row_number().over(spec)).where(F.col("_rn") <= n + 1)
    return (out.withColumn("seq_no", F.col("_rn").cast("bigint"))
            .withColumn("outcome", F.when(F.col("_rn") <= n, "pass").otherwise("warn"))
            .drop("_rn"))
