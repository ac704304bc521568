"""Value transforms for learning, and their inverses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE_EPSILON = 1e-8


def clip_zero(value: Column) -> Column:
    """max(value, 0); missing stays missing."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def clipped_log(value: Column) -> Column:
    return F.log1p(clip_zero(value.cast("double")))


def standardize(value: Column, mean: Column, std: Column, epsilon: float = SCALE_EPSILON) -> Column:
    return (value - mean) / (std + F.lit(epsilon))


def transform_target(value: Column, mean: Column, std: Column) -> Column:
    return (clipped_log(value) - mean) / std


def inverse_target(value: Column, mean: Column | None, std: Column | None, transform: str = "log1p") -> Column:
    """Undo ``transform_target``; any transform without a log is the identity."""
    if "log1p" not in transform.lower():
        return value
    if mean is None or std is None:
        raise ValueError("a log-scaled target needs its mean and std")
    return F.expm1(value * std + mean)


def round_half_even(value: Column) -> Column:
    return F.rint(value).cast("int")
