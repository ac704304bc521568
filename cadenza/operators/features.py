"""Calendar, weather, change and lag features, series ids and labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.encode import TIME_FEATURES, bearing, calendar_columns
from cadenza.functions.text import numeric
from cadenza.operators.clean import ZERO_WHEN_MISSING
from cadenza.operators.fill import fill_along
from cadenza.operators.joins import lookup_join
from cadenza.operators.segments import ordered_index, over_segments
from cadenza.spec import HOURLY, PanelSpec

# The weather columns used as features, in order.
WEATHER_FEATURES = [
    "temp_c", "rain_mm", "wind_ms", "wind_dir_sin", "wind_dir_cos",
    "humidity_pct", "pressure_hpa", "snow_cm", "cloud_total_10",
]
# Features without a change column.
NO_CHANGE = ["wind_dir_sin", "wind_dir_cos"]

DIFF = "_diff1"
LAG = "_lag1"


def time_features(df: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    return df.withColumns(calendar_columns(F.col(spec.time)))


def wind_features(df: DataFrame) -> DataFrame:
    """Sine and cosine of the wind direction unless both exist; missing counts as 0 degrees."""
    if "wind_dir_deg" not in df.columns or {"wind_dir_sin", "wind_dir_cos"} <= set(df.columns):
        return df
    sine, cosine = bearing(F.coalesce(numeric(df, "wind_dir_deg"), F.lit(0.0)))
    return df.withColumns({"wind_dir_sin": sine, "wind_dir_cos": cosine})


def weather_features(df: DataFrame) -> list[str]:
    return [c for c in WEATHER_FEATURES if c in df.columns]


def difference_columns(columns: list[str]) -> list[str]:
    return [f"{c}{DIFF}" for c in columns if c not in NO_CHANGE]


def add_differences(df: DataFrame, columns: list[str], spec: PanelSpec = HOURLY) -> DataFrame:
    """Change since the previous row of the series; 0 at its start."""
    changing = [c for c in columns if c not in NO_CHANGE]
    if not changing:
        return df
    return over_segments(df, spec, lambda w: {
        f"{c}{DIFF}": F.coalesce(F.col(c) - F.lag(c).over(w), F.lit(0.0)) for c in changing}, before=1)


def add_lags(df: DataFrame, columns: list[str], spec: PanelSpec = HOURLY) -> DataFrame:
    """Previous value of the series; 0 at its start and where it is missing."""
    if not columns:
        return df
    return over_segments(df, spec, lambda w: {
        f"{c}{LAG}": F.coalesce(F.lag(c).over(w), F.lit(0.0)) for c in columns}, before=1)


def series_ids(df: DataFrame, spec: PanelSpec = HOURLY, name: str = "spot_id") -> DataFrame:
    """0-based id of each key in sorted order, one row per key."""
    keys = df.select(spec.key).distinct()
    return ordered_index(keys, [spec.key], name).withColumn(name, F.col(name).cast("int"))


def add_series_id(df: DataFrame, ids: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    return lookup_join(df, ids, [spec.key])


def id_cardinality(df: DataFrame, name: str = "spot_id") -> DataFrame:
    return df.agg((F.max(name) + 1).alias("n_ids"))


def feature_names(
    columns: list[str],
    time: bool = True,
    weather: bool = True,
    spot_id: bool = False,
    change: str = "diff",
) -> list[str]:
    """The feature list for a panel with these columns, in model order.

    ``change`` is "diff" (change of each weather feature except wind direction)
    or "lag" (previous value of every weather feature). The wind direction in
    degrees is never a feature.
    """
    names = ["vol"] + (TIME_FEATURES if time else [])
    if weather:
        present = [c for c in WEATHER_FEATURES if c in columns]
        names = names + present
        names += difference_columns(present) if change == "diff" else [f"{c}{LAG}" for c in present]
    return names + (["spot_id"] if spot_id else [])


def feature_frame(
    panel: DataFrame,
    spec: PanelSpec = HOURLY,
    time: bool = True,
    weather: bool = True,
    ids: DataFrame | None = None,
    change: str = "diff",
    gaps: str = "along",
) -> tuple[DataFrame, list[str]]:
    """Panel with every feature column, and their names in model order.

    ``gaps`` says how missing weather is filled: "along" the series, or "zero".
    Ids come from one table made on the full panel, so they agree across splits.
    """
    df = panel.fillna(0.0, subset=[spec.value])
    if time:
        df = time_features(df, spec)
    df = wind_features(df)
    columns = weather_features(df) if weather else []
    df = df.withColumns({c: numeric(df, c) for c in columns})
    if gaps == "along":
        df = df.fillna(0.0, subset=[c for c in columns if c in ZERO_WHEN_MISSING])
        df = fill_along(df, [c for c in columns if c not in ZERO_WHEN_MISSING], spec)
        df = df.fillna(0.0, subset=columns) if columns else df
    if columns:
        df = add_differences(df, columns, spec) if change == "diff" else add_lags(df, columns, spec)
    if gaps == "zero" and columns:
        df = df.fillna(0.0, subset=columns)
    if ids is not None:
        df = add_series_id(df, ids, spec)
    names = feature_names(columns, time, weather, ids is not None, change)
    return df, names


def previous_value(df: DataFrame, steps: int, spec: PanelSpec = HOURLY, name: str = "y_pred") -> DataFrame:
    """The value ``steps`` rows earlier in the series; rows without one are dropped."""
    return over_segments(
        df, spec, lambda w: {name: F.lag(spec.value, steps).over(w)}, before=steps,
        keep=F.col(name).isNotNull())


def label_ahead(df: DataFrame, horizon: int, spec: PanelSpec = HOURLY, name: str = "y_true") -> DataFrame:
    """The value exactly ``horizon`` steps later; rows without one are dropped."""
    return over_segments(
        df, spec, lambda w: {name: F.lead(spec.value, horizon).over(w)}, after=horizon,
        keep=F.col(name).isNotNull())


