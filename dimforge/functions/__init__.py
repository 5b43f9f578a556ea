"""Column-level helpers (all built-in Spark expressions, no UDFs)."""

from dimforge.functions.scalars import band, clock_to_seconds, exact_int, day_of
from dimforge.functions.bits import day_bit, bits_text, popcount32

__all__ = ["band", "clock_to_seconds", "exact_int", "day_of", "day_bit", "bits_text", "popcount32"]
