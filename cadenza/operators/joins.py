"""Left equi-joins of a large table with a lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import parse_compact_hour
from cadenza.functions.text import join_text, numeric, zero_pad
from cadenza.spec import HOURLY, PanelSpec


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left") -> DataFrame:
    """Join each left row with its row of a lookup table.

    No hint and no size limit: adaptive execution broadcasts a lookup that turns out small at run time, and splits a
    hot key on the left otherwise, since a lookup has one row per key.
    """
    return left.join(right, on, how)


def with_spot_attributes(history: DataFrame, spots: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    """History with the attributes of its spot; a time is made from day and hour if both exist.

    Duplicate spots multiply rows, as in any join. Column names match in any case.
    """
    joined = lookup_join(history, spots, [spec.key])
    names = {c.lower(): c for c in joined.columns}
    if "ymd" in names and "hh" in names:
        day, hour = F.col(names["ymd"]).cast("string"), numeric(joined, names["hh"]).try_cast("int")
        joined = joined.withColumn(spec.time, parse_compact_hour(join_text(day, zero_pad(hour))))
    return joined


def with_weather(panel: DataFrame, weather: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    """Panel with the weather of its hour. No hour can be hot: it has one row per series."""
    return lookup_join(panel, weather, [spec.time])


def join_forecasts(first: DataFrame, second: DataFrame, names: tuple[str, str], on: list[str], value: str = "pred_vol") -> DataFrame:
    """Two forecasts side by side; every row of the first is kept."""
    a = first.select(*on, F.col(value).alias(names[0]))
    b = second.select(*on, F.col(value).alias(names[1]))
    return a.join(b, on, "left")


def spots_with_forecast(spots: DataFrame, forecast: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    """All spots, with their forecast where there is one. Both sides have one row per spot."""
    return spots.join(forecast, [spec.key], "left")
