"""Reshaping of window arrays (steps x features)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flat(x: Column) -> Column:
    """Steps x features as one time-major array."""
    return F.flatten(x)


def first_step(x: Column) -> Column:
    return F.element_at(x, 1)


def pick_features(x: Column, have: list[str], want: list[str]) -> Column:
    """Keep the named features of each step, in the wanted order.

    Unknown names are skipped; nothing known means nothing is dropped.
    """
    indexes = [have.index(name) for name in want if name in have]
    if not indexes or indexes == list(range(len(have))):
        return x
    return F.transform(x, lambda step: F.array(*[step[i] for i in indexes]))


def drop_feature(x: Column, have: list[str], name: str) -> Column:
    return pick_features(x, have, [c for c in have if c != name])
