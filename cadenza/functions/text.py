"""Text and number-parsing column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def text_to_number(text: Column) -> Column:
    """Double, or null when the text is not a plain number.

    A bare ``try_cast`` would also take Java suffixes ("7d") and "NaN", and
    pays an exception for each failure.
    """
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def numeric(df: DataFrame, name: str) -> Column:
    """A column as double whatever its type; unusable values and NaN are null."""
    kind = df.schema[name].dataType
    column = F.col(name)
    if isinstance(kind, T.StringType):
        return text_to_number(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(column), column.cast("double"))
    return column.cast("double")


def zero_pad(col: Column, width: int = 2) -> Column:
    """Left-pad with zeros; longer text is kept whole."""
    text = col.cast("string")
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def tag_number(col: Column, letter: str = "w") -> Column:
    """First ``<letter><digits>`` in a tag as an int, else null."""
    return F.nullif(F.regexp_extract(col, f"{letter}([0-9]+)", 1), F.lit("")).try_cast("int")


def safe_name(col: Column) -> Column:
    """Strip everything outside letters, digits, underscore and hyphen."""
    return F.regexp_replace(col, r"[^A-Za-z0-9_\-]", "")


def clean_text(col: Column) -> Column:
    return F.trim(col)


def join_text(*cols: Column) -> Column:
    return F.concat(*[c.cast("string") for c in cols])


def round_places(col: Column, places: int = 3) -> Column:
    return F.round(col, places)
