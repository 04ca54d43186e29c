"""Registered queries of the line decoders: lines composed from ``events``.

Every event becomes one line of a record type's text format; events of type
``view`` are cut short, so that each decoder also meets malformed lines.  The
permissive decoder's fields, with times as epoch seconds, are the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidewatch.sources import tables as T
from tidewatch.sources.decode import DECODERS

SECOND = "timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"
CUT = "event_type = 'view'"


def _text(*parts: str) -> Column:
    return F.concat_ws(",", *[F.expr(p).cast("string") for p in parts])


def _lines() -> dict[str, Column]:
    tx = "CASE WHEN event_type = 'purchase' THEN concat('t', event_id) ELSE '' END"
    kind = "CASE WHEN event_type = 'purchase' THEN 'pay' ELSE 'create' END"
    return {
        "user_behavior": _text("user_id", "event_id", "event_id % 10", "event_type", SECOND),
        "ad_click": _text("user_id", "event_id", "concat('p', user_id % 25)", "concat('c', user_id % 7)", SECOND),
        "login": _text("user_id", "concat('10.0.0.', user_id % 250)", "event_type", SECOND),
        "order_event": _text("user_id", kind, tx, SECOND),
        "receipt": _text("concat('t', event_id)", "event_type", SECOND),
        "marketing": _text("user_id", "event_type", "concat('ch', user_id % 5)", f"{SECOND} * 1000"),
        "access_log": F.concat_ws(
            " ", F.expr("concat('10.0.0.', user_id % 250)"), F.col("user_id").cast("string"), F.lit("-"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"), F.lit("GET"),
            F.concat(F.lit("/"), F.col("event_type"))),
    }


def decoded(kind: str) -> Callable:
    """Query of one decoder: event id, its fields, the time in seconds, the flag."""

    def query(spark, sf_dir) -> DataFrame:
        events = T.table(spark, sf_dir, "events")
        sep = " " if kind == "access_log" else ","
        whole = _lines()[kind]
        line = F.when(F.expr(CUT), F.substring_index(whole, sep, 1)).otherwise(whole)
        # the event id follows as one more field, which names the result row through ``raw``
        found = DECODERS[kind](events.select(F.concat_ws(sep, line, F.col("event_id").cast("string")).alias("value")),
                               mode="permissive")
        names = [c for c in found.columns if c not in ("event_time", "raw", "malformed")]
        return found.select(F.substring_index("raw", sep, -1).cast("bigint").alias("event_id"),
                            *names, F.unix_seconds("event_time").alias("epoch_s"), "malformed")

    return query


KINDS = ("user_behavior", "ad_click", "login", "order_event", "receipt", "marketing", "access_log")


def oracle(kind: str) -> str:
    """The same fields straight from ``events``: a cut line has its first field,
    then the event id, and nothing else."""
    second = "epoch(date_trunc('second', ts))::BIGINT"
    ip = "'10.0.0.' || (user_id % 250)"
    fields = {
        "user_behavior": [("user_id", "user_id", "BIGINT"), ("item_id", "event_id", "BIGINT"),
                          ("category_id", "event_id % 10", "INTEGER"), ("behavior", "event_type", "VARCHAR")],
        "ad_click": [("user_id", "user_id", "BIGINT"), ("ad_id", "event_id", "BIGINT"),
                     ("province", "'p' || (user_id % 25)", "VARCHAR"), ("city", "'c' || (user_id % 7)", "VARCHAR")],
        "login": [("user_id", "user_id", "BIGINT"), ("ip", ip, "VARCHAR"), ("event_type", "event_type", "VARCHAR")],
        "order_event": [("order_id", "user_id", "BIGINT"),
                        ("event_type", "CASE event_type WHEN 'purchase' THEN 'pay' ELSE 'create' END", "VARCHAR"),
                        ("tx_id", "CASE event_type WHEN 'purchase' THEN 't' || event_id ELSE '' END", "VARCHAR")],
        "receipt": [("tx_id", "'t' || event_id", "VARCHAR"), ("pay_channel", "event_type", "VARCHAR")],
        "marketing": [("user_id", "user_id", "VARCHAR"), ("behavior", "event_type", "VARCHAR"),
                      ("channel", "'ch' || (user_id % 5)", "VARCHAR")],
        "access_log": [("ip", ip, "VARCHAR"), ("user_id", "user_id", "VARCHAR"),
                       ("method", "'GET'", "VARCHAR"), ("url", "'/' || event_type", "VARCHAR")],
    }[kind]
    columns = []
    for k, (name, value, type_) in enumerate(fields):
        cut = value if k == 0 else "event_id" if k == 1 else "NULL"
        columns.append(f"CASE WHEN {CUT} THEN CAST({cut} AS {type_}) ELSE CAST({value} AS {type_}) END AS {name}")
    return (f"SELECT event_id, {', '.join(columns)}, CASE WHEN NOT {CUT} THEN {second} END AS epoch_s, "
            f"{CUT} AS malformed FROM events").replace(f"NOT {CUT}", f"NOT ({CUT})")
