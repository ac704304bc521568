"""Unions, distinct values and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def stack(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames; columns are matched by name, absent ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*columns).distinct()


def without(df: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key does not occur in the other frame."""
    return df.join(other.select(*on), on, "left_anti")
