"""Raw readings and weather to a gap-free panel."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cadenza.operators.fill import clean_weather, fill_panel_weather
from cadenza.operators.grid import densify, hourly_sum
from cadenza.operators.joins import with_weather
from cadenza.session import materialize
from cadenza.spec import HOURLY, PanelSpec


def build_panel(
    readings: DataFrame,
    weather: DataFrame | None = None,
    spec: PanelSpec = HOURLY,
    strict: bool = False,
    borrow_from_next: bool = False,
    weather_latest_by: str | None = None,
    store: bool = True,
) -> DataFrame:
    """Hourly sums on a full grid, with cleaned weather if given.

    Filling a grid or a gap reads its input twice, and these steps build on one
    another, so each stage's result is written once to the shared folder: raw
    rows are read once, whatever follows. ``store=False`` keeps one lazy plan.
    """
    def stage(df: DataFrame, label: str) -> DataFrame:
        return materialize(df, label) if store else df

    hourly = stage(hourly_sum(readings, spec, strict), "hourly")
    panel = densify(hourly, spec, aligned=True)
    if weather is None:
        return panel
    cleaned = stage(clean_weather(stage(weather, "weather"), spec, weather_latest_by), "weather")
    joined = stage(with_weather(panel, cleaned, spec), "joined")
    ordered = joined.select(spec.key, spec.time, spec.value, *[c for c in joined.columns if c not in panel.columns])
    return fill_panel_weather(ordered, spec, borrow_from_next)
