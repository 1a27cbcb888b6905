"""Rounding, fixed-point and clamping expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MICRO = 1e6


def to_micro(value: Column) -> Column:
    """Counter reading as whole millionths.

    Sums and differences of longs do not depend on the order in which shuffled
    partial results arrive, and stay in fixed-width aggregation buffers.
    """
    return F.rint(value * F.lit(_MICRO)).cast("long")


def from_micro(value: Column) -> Column:
    return value.cast("double") / F.lit(_MICRO)


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal value, published as double."""
    return F.round(value.cast("decimal(28,10)"), digits).cast("double")


def round_to_int(value: Column) -> Column:
    return F.round(value.cast("decimal(28,10)"), 0).cast("int")


def floor_zero(value: Column) -> Column:
    """max(value, 0) where a missing value counts as 0 (``greatest`` skips nulls)."""
    return F.greatest(value, F.lit(0))


def clamp(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), value))


def wrap_delta(current: Column, previous: Column, modulus: int = 100) -> Column:
    """Step of a counter that restarts at ``modulus``; null when either side is missing."""
    return F.when(current >= previous, current - previous).otherwise(current + F.lit(modulus) - previous)


def recycling_rate(renvoi: Column, adoucie: Column) -> Column:
    """(renvoi - adoucie) / renvoi within 0..1; 0 when it cannot be computed."""
    ratio = (renvoi - adoucie).cast("double") / F.nullif(renvoi, F.lit(0)).cast("double")
    return F.when(ratio.isNull(), F.lit(0.0)).otherwise(clamp(ratio, 0.0, 1.0))
