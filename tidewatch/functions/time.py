"""Event-time helpers (X-2 .. X-5, T-10)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the access-log clock format of the reference's sample line,
# extended with its zone offset field so the offset is honoured.
ACCESS_LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss Z"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def from_epoch_seconds(col: Column | str) -> Column:
    """Epoch seconds -> TIMESTAMP (the reference multiplies by 1000 at parse)."""
    return F.timestamp_seconds(_c(col))


def from_epoch_millis(col: Column | str) -> Column:
    return F.timestamp_millis(_c(col))


def parse_access_time(day_time: Column | str, offset: Column | str, strict: bool = True) -> Column:
    """``day/month/year:time`` + zone offset -> TIMESTAMP, offset applied.  Not
    strict: null where the text is no such time."""
    parse = F.to_timestamp if strict else F.try_to_timestamp
    form = ACCESS_LOG_TIME_FORMAT if strict else F.lit(ACCESS_LOG_TIME_FORMAT)
    return parse(F.concat_ws(" ", _c(day_time), _c(offset)), form)


def utc_day(ts: Column | str, ntz: bool = True) -> Column:
    """UTC calendar day of an event time, whatever the session zone.

    ``TIMESTAMP_NTZ`` (``ntz=True``) is a UTC wall clock: its date as
    stored.  ``TIMESTAMP`` is an instant: its day number since the epoch
    (``to_date`` would use the session zone)."""
    if ntz:
        return F.to_date(_c(ts))
    return F.date_from_unix_date(F.floor(F.unix_seconds(_c(ts)) / 86400).cast("int"))


def next_utc_midnight(ts: Column | str, ntz: bool = True) -> Column:
    """Start of the following UTC day: when a daily counter resets (X-5)."""
    if ntz:
        return F.date_trunc("DAY", _c(ts)).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return F.timestamp_seconds((F.floor(F.unix_seconds(_c(ts)) / 86400) + 1) * 86400)


def display_time(ts: Column | str) -> Column:
    """Printable window time for text reports (X-4)."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ss")
