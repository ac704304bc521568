"""JSON objects as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def encode(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols))


def decode(text: Column, schema: str) -> Column:
    return F.from_json(text, schema)
