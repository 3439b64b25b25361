"""Rounding of ratios, whole numbers in texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole(value: Column) -> Column:
    """Number as bigint; null where it is unreadable, out of range or not whole."""
    exact = value.try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast("bigint"))


def round_ratio(value: Column, digits: int) -> Column:
    """Floating value to `digits` decimals, halves to even on the scaled value as array libraries do."""
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale
