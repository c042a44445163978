"""Small numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, high=None, low=None) -> Column:
    if high is not None:
        value = F.least(value, F.lit(high))
    if low is not None:
        value = F.greatest(value, F.lit(low))
    return value


def rate(amount: Column, duration: Column) -> Column:
    """amount / duration, 0 when nothing elapsed."""
    return F.coalesce(F.try_divide(amount.cast("double"), duration.cast("double")), F.lit(0.0))


def ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def minutes_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(60_000_000.0)


def resolution(width: Column, height: Column) -> Column:
    return F.concat(width.cast("string"), F.lit("x"), height.cast("string"))


def pixels(width: Column, height: Column) -> Column:
    return width.cast("bigint") * height.cast("bigint")


def frame_rate(text: Column) -> Column:
    """'30000/1001' or '25' as frames per second; null when unreadable."""
    parts = F.split(text, "/")
    top = parts[0].try_cast("double")
    bottom = F.coalesce(F.get(parts, F.lit(1)), F.lit("1")).try_cast("double")
    return F.try_divide(top, bottom)
