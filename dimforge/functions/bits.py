"""Bit-packed activity history: bit ``width-1`` is the most recent day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: 31 days fit in the low bits of a signed 32-bit integer.
HISTORY_WIDTH = 31


def day_bit(day, as_of, width: int = HISTORY_WIDTH) -> Column:
    """2^(width-1 - days between day and as_of) as BIGINT; 0 outside the window."""
    back = F.datediff(as_of, day)
    return F.when((back >= 0) & (back < width),
                  F.call_function("shiftleft", F.lit(1).cast("bigint"), F.lit(width - 1) - back)
                  ).otherwise(F.lit(0).cast("bigint"))


def bits_text(col) -> Column:
    """Base-2 text without padding (0 -> '0')."""
    return F.bin(col)


def popcount(col, width: int = HISTORY_WIDTH) -> Column:
    """Number of set bits among the low ``width`` bits (at most 63)."""
    return F.bit_count(col.bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))).cast("bigint")


def popcount32(col) -> Column:
    """Number of set bits among the low 32 bits."""
    return popcount(col, 32)
