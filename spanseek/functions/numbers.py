"""Numbers as they are printed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splits a double into two halves whose products with small numbers are exact.
SPLIT = 134217729.0


def two_decimals(value: Column) -> Column:
    """Rounded to two decimals as ``:.2f`` prints: by the exact value, exact halves to the even digit."""
    scaled = value * 100
    low = F.floor(scaled)
    rest = scaled - low
    high = value * SPLIT - (value * SPLIT - value)
    # What the product lost in rounding tells on which side of a half it lies.
    lost = (high * 100 - scaled) + (value - high) * 100
    even = F.pmod(low, F.lit(2)) == 0
    up = (rest > 0.5) | ((rest == 0.5) & ((lost > 0) | ((lost == 0) & ~even)))
    return (low + up.cast("int")).cast("double") / 100
