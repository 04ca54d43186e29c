from datetime import datetime

from pyspark.sql import functions as F

from tidewatch.functions import bitmap_offset, next_utc_midnight


def _py_offset(s: str) -> int:
    h = 0
    for ch in s:
        h = (h * 61 + ord(ch)) & ((1 << 64) - 1)   # 64-bit wrap, as the JVM long
    return h & ((1 << 29) - 1)


def test_bitmap_offset_known_value(spark):
    df = spark.createDataFrame([(543462,)], "u BIGINT")
    assert df.select(bitmap_offset("u").alias("o")).first().o == 398203944


def test_bitmap_offset_long_ids_match_wrapping_arithmetic(spark):
    ids = [9223372036854775807, 1234567890123456789, 0, 7]
    df = spark.createDataFrame([(i,) for i in ids], "u BIGINT")
    got = {r.u: r.o for r in df.select("u", bitmap_offset("u").alias("o")).collect()}
    assert got == {i: _py_offset(str(i)) for i in ids}


def test_next_utc_midnight(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 23, 59, 59),)], "t TIMESTAMP")
    assert df.select(next_utc_midnight("t").alias("m")).first().m == datetime(2024, 1, 2)


def test_utc_day_ignores_session_zone(spark):
    from tidewatch.functions import utc_day
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([(1700000000 - 3600,)], "s BIGINT").select(
            F.timestamp_seconds("s").alias("t"))   # 2023-11-14 21:13 UTC, 13:13 in LA
        got = df.select(utc_day("t", ntz=False).alias("d"), F.to_date("t").alias("local")).first()
        assert str(got.d) == "2023-11-14"
        df2 = spark.createDataFrame([(1700000000 + 3 * 3600,)], "s BIGINT").select(
            F.timestamp_seconds("s").alias("t"))   # 2023-11-15 01:53 UTC, still the 14th in LA
        got = df2.select(utc_day("t", ntz=False).alias("d"), F.to_date("t").alias("local")).first()
        assert str(got.d) == "2023-11-15" and str(got.local) == "2023-11-14"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
