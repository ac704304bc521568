"""Cyclic encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.functions import dates

# Names and order of the calendar features.
TIME_FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "is_weekend",
]


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    angle = 2 * F.pi() * value / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def calendar_columns(time: Column) -> dict[str, Column]:
    """The seven calendar features of a local time."""
    hour_sin, hour_cos = cyclic(F.hour(time), 24)
    dow_sin, dow_cos = cyclic(F.weekday(time), 7)
    month_sin, month_cos = cyclic(F.month(time), 12)
    made = [hour_sin, hour_cos, dow_sin, dow_cos, month_sin, month_cos, dates.is_weekend(time)]
    return dict(zip(TIME_FEATURES, made))


def bearing(degrees: Column) -> tuple[Column, Column]:
    """Sine and cosine of a compass direction in degrees; missing stays missing."""
    angle = F.radians(F.pmod(degrees.cast("double"), F.lit(360.0)))
    return F.sin(angle), F.cos(angle)
