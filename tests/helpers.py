"""Small-row helpers for tests: frames from tuples with epoch-second times."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F


def ts(sec: int) -> datetime:
    return datetime.fromtimestamp(sec, tz=timezone.utc).replace(tzinfo=None)


def frame(spark, ddl: str, rows, time_col: str | None = "event_time"):
    """Rows with epoch seconds in ``time_col`` -> TIMESTAMP column."""
    df = spark.createDataFrame(rows, ddl)
    if time_col:
        df = df.withColumn(time_col, F.timestamp_seconds(F.col(time_col)))
    return df


def lines(spark, text: str):
    return spark.createDataFrame([(l,) for l in text.strip().splitlines()], "value STRING")


def epoch(dt) -> int:
    return int(dt.replace(tzinfo=timezone.utc).timestamp())
