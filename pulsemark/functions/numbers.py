"""Arithmetic with explicit NULL behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_at(value: Column, low: float) -> Column:
    """Raise values under ``low`` to it and keep NULL (``greatest`` would turn NULL into ``low``)."""
    return F.when(value < F.lit(low), F.lit(low)).otherwise(value)


def cap_at(value: Column, high: Column) -> Column:
    """Lower values over ``high`` to it and keep NULL."""
    return F.when(value > high, high).otherwise(value)


def rate(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, 0.0 unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def truth(condition: Column) -> Column:
    """1 when the condition holds, 0 when it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def finite(value: Column) -> Column:
    """NaN and infinities as NULL."""
    bad = F.isnan(value) | value.isin(float("inf"), float("-inf"))
    return F.when(~bad, value)
