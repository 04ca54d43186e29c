"""Column expressions shared by the jobs (all JVM-side built-ins)."""

from tidewatch.functions.hashing import bitmap_offset, BITMAP_BITS, HASH_SEED
from tidewatch.functions.time import (
    display_time, from_epoch_millis, from_epoch_seconds, next_utc_midnight,
    parse_access_time, utc_day,
)
from tidewatch.functions.messages import message

__all__ = [
    "bitmap_offset", "BITMAP_BITS", "HASH_SEED", "display_time",
    "from_epoch_millis", "from_epoch_seconds", "next_utc_midnight",
    "parse_access_time", "utc_day", "message",
]
