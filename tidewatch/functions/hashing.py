"""Bit offset of a visitor id in the hourly unique-visitor bitmap (A-5, X-6).

The reference hashes the decimal text of the id with ``h = h * seed + char``
in 64-bit arithmetic and keeps the low bits of a 2^29-bit bitmap.  Masking
after every step keeps the same low bits (2^29 divides 2^64, so wrap-around
does not change them) and never overflows, so ANSI mode stays on.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's for identical offsets:
# polynomial seed 61, bitmap of 2^29 bits (offset mask 2^29 - 1).
HASH_SEED = 61
BITMAP_BITS = 29


def bitmap_offset(col: Column | str, seed: int = HASH_SEED,
                  bits: int = BITMAP_BITS) -> Column:
    """Offset of ``col`` (any type, hashed as its string form) in the bitmap."""
    mask = (1 << bits) - 1
    chars = F.split(F.col(col).cast("string") if isinstance(col, str)
                    else col.cast("string"), "")
    return F.aggregate(
        chars, F.lit(0).cast("bigint"),
        lambda acc, ch: (acc * F.lit(seed) + F.ascii(ch)).bitwiseAND(F.lit(mask).cast("bigint")))
