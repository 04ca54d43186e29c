"""Raw text lines -> typed record frames (S-4 .. S-9).

Every decoder takes a frame with one string column ``value`` (what
``spark.read.text`` and ``spark.readStream.text`` give) and returns the
record type of one reference job, with ``event_time`` as TIMESTAMP.  One
``select`` of ``split``/``cast`` per decoder: the work stays in codegen.

``mode="strict"`` casts with ANSI semantics, so a malformed line fails the
job as it does in the reference.  ``mode="permissive"`` uses ``try_cast`` and
adds a boolean ``malformed`` column and the line itself (``raw``), for lines with
missing fields, bad numbers or bad times alike; nothing is dropped silently:
``split_malformed`` parts the records from the lines to set aside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.functions.time import from_epoch_millis, from_epoch_seconds, parse_access_time

# Seconds and milliseconds a Spark timestamp can hold; anything beyond is malformed.
_MOST = {"s": 253_402_300_799, "ms": 253_402_300_799_999}


def _cast(c: Column, type_: str, strict: bool) -> Column:
    return c.cast(type_) if strict else c.try_cast(type_)


def _decode(lines: DataFrame, sep: str, fields: list[tuple[str, int, str]],
            time_field: tuple[int, str] | None, mode: str,
            extra: dict[str, Column] | None = None) -> DataFrame:
    strict = mode == "strict"
    parts = F.split(F.col("value"), sep)
    cols = []
    for name, idx, type_ in fields:
        raw = parts.getItem(idx) if strict else F.get(parts, F.lit(idx))
        cols.append((name, raw if type_ == "string" else _cast(raw, type_, strict)))
    if time_field is not None:
        idx, unit = time_field
        secs = _cast(parts.getItem(idx) if strict else F.get(parts, F.lit(idx)), "bigint", strict)
        if not strict:
            secs = F.when(F.abs(secs) <= _MOST[unit], secs)
        ts = from_epoch_seconds(secs) if unit == "s" else from_epoch_millis(secs)
        cols.append(("event_time", ts))
    for name, c in (extra or {}).items():
        cols.append((name, c))
    return _select(lines, cols, strict)


def _select(lines: DataFrame, cols: list[tuple[str, Column]], strict: bool) -> DataFrame:
    """The record columns; not strict: also ``malformed`` and the line as ``raw``."""
    named = [c.alias(n) for n, c in cols]
    if strict:
        return lines.select(*named)
    bad = F.lit(False)
    for n, _ in cols:
        bad = bad | F.col(n).isNull()
    return lines.select(*named, F.col("value").alias("raw")).withColumn("malformed", bad)


def split_malformed(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines as ``value``) of a permissively decoded frame."""
    return (decoded.where(~F.col("malformed")).drop("malformed", "raw"),
            decoded.where("malformed").select(F.col("raw").alias("value")))


def decode_user_behavior(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``user,item,category,behavior,epoch_s`` (S-4)."""
    return _decode(lines, ",", [("user_id", 0, "bigint"), ("item_id", 1, "bigint"),
                                ("category_id", 2, "int"), ("behavior", 3, "string")],
                   (4, "s"), mode)


def decode_ad_click(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``user,ad,province,city,epoch_s`` (S-5)."""
    return _decode(lines, ",", [("user_id", 0, "bigint"), ("ad_id", 1, "bigint"),
                                ("province", 2, "string"), ("city", 3, "string")],
                   (4, "s"), mode)


def decode_login(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``user,ip,success|fail,epoch_s`` (S-6)."""
    return _decode(lines, ",", [("user_id", 0, "bigint"), ("ip", 1, "string"),
                                ("event_type", 2, "string")], (3, "s"), mode)


def decode_order_event(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``order,create|pay,tx,epoch_s`` (S-7).  ``split`` keeps an empty ``tx``
    as ``''`` (the CSV reader would turn it into NULL)."""
    return _decode(lines, ",", [("order_id", 0, "bigint"), ("event_type", 1, "string"),
                                ("tx_id", 2, "string")], (3, "s"), mode)


def decode_receipt(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``tx,channel,epoch_s`` (S-8)."""
    return _decode(lines, ",", [("tx_id", 0, "string"), ("pay_channel", 1, "string")],
                   (2, "s"), mode)


def decode_marketing(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``user,behavior,channel,epoch_ms`` (the generated marketing rows)."""
    return _decode(lines, ",", [("user_id", 0, "string"), ("behavior", 1, "string"),
                                ("channel", 2, "string")], (3, "ms"), mode)


def decode_access_log(lines: DataFrame, mode: str = "strict") -> DataFrame:
    """``ip user - dd/MM/yyyy:HH:mm:ss +zzzz METHOD url`` (S-9)."""
    strict = mode == "strict"
    parts = F.split(F.col("value"), " ")
    at = [parts.getItem(i) if strict else F.get(parts, F.lit(i)) for i in range(7)]
    cols = [("ip", at[0]), ("user_id", at[1]), ("event_time", parse_access_time(at[3], at[4], strict)),
            ("method", at[5]), ("url", at[6])]
    return _select(lines, cols, strict)


DECODERS = {
    "user_behavior": decode_user_behavior,
    "ad_click": decode_ad_click,
    "login": decode_login,
    "order_event": decode_order_event,
    "receipt": decode_receipt,
    "marketing": decode_marketing,
    "access_log": decode_access_log,
}
