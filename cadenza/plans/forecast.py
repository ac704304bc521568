"""Recursive forecasts of all series at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import tick_of, time_of
from cadenza.functions.encode import calendar_columns
from cadenza.functions.scaling import clip_zero
from cadenza.operators.grid import last_steps
from cadenza.operators.joins import spots_with_forecast
from cadenza.operators.rank import top_rows
from cadenza.operators.split import long_enough
from cadenza.operators.windows import collect_windows
from cadenza.session import cut_lineage
from cadenza.spec import HOURLY, PanelSpec

CHECKPOINT_EVERY = 2


def last_windows(
    frame: DataFrame, features: list[str], window: int, spec: PanelSpec = HOURLY, carry: list[str] | None = None,
) -> DataFrame:
    """The latest window of each series that has at least ``window`` rows."""
    recent = last_steps(long_enough(frame, window, spec), window, spec)
    windows = collect_windows(recent, features, spec)
    if carry:
        attributes = recent.groupBy(*spec.series).agg(*[F.max(c).alias(c) for c in carry])
        windows = windows.join(attributes, spec.series)
    return windows


def _next_row(features: list[str], time: Column, value: Column, x: Column, spec: PanelSpec) -> Column:
    """Feature row of a forecast step: forecast value, its calendar, known id, no weather."""
    calendar = calendar_columns(time)
    cells = []
    for i, c in enumerate(features):
        if c == spec.value:
            cells.append(value)
        elif c in calendar:
            cells.append(calendar[c].cast("double"))
        elif c == "spot_id":
            cells.append(F.element_at(x, -1)[i])
        else:
            cells.append(F.lit(0.0))
    return F.array(*cells)


def recursive_forecast(
    model, windows: DataFrame, features: list[str], k: int = 24, spec: PanelSpec = HOURLY, carry: list[str] | None = None,
) -> DataFrame:
    """Forecast the next k steps of every series, feeding forecasts back as values.

    ``model`` has ``predict(df, name)`` on a window column ``x``. One row per
    series holds its window; each round scores all series at once and shifts
    the windows by one step. Negative forecasts become 0. The plan is cut every
    few rounds by a reliable checkpoint.
    """
    keep = [*spec.series, *(carry or [])]
    state = windows.select(
        *keep, tick_of(F.col("end_time"), spec.step_seconds).alias("_tick"), "x",
        F.array().cast("array<double>").alias("_made"))
    for step in range(1, k + 1):
        scored = model.predict(state, "_guess")
        value = clip_zero(F.coalesce(F.col("_guess"), F.lit(0.0)))
        advanced = scored.withColumns({"_value": value, "_tick": F.col("_tick") + 1})
        time = time_of(F.col("_tick"), spec.step_seconds)
        row = _next_row(features, time, F.col("_value"), F.col("x"), spec)
        state = advanced.select(
            *keep, "_tick",
            F.concat(F.slice("x", 2, F.size("x") - 1), F.array(row)).alias("x"),
            F.concat("_made", F.array("_value")).alias("_made"))
        if step % CHECKPOINT_EVERY == 0 and step < k:
            state = cut_lineage(state)
    made = state.select(*spec.series, "_tick", F.posexplode("_made").alias("_i", "pred_vol"))
    return made.select(
        *spec.series, (F.col("_i") + 1).alias("step"),
        time_of(F.col("_tick") - (k - 1) + F.col("_i"), spec.step_seconds).alias(spec.time), "pred_vol")


def forecast_at_step(forecast: DataFrame, step: int) -> DataFrame:
    return forecast.where(F.col("step") == step).drop("step")


def busiest_spots(spots: DataFrame, forecast: DataFrame, step: int, n: int = 50, spec: PanelSpec = HOURLY) -> DataFrame:
    """All spots with their forecast at one step, the n greatest."""
    joined = spots_with_forecast(spots, forecast_at_step(forecast, step).select(spec.key, "pred_vol"), spec)
    return top_rows(joined, "pred_vol", n, [spec.key])
