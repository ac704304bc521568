"""Sliding windows of feature rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.clean import align_features
from cadenza.operators.features import time_features, wind_features
from cadenza.operators.grid import steps_until
from cadenza.operators.joins import lookup_join
from cadenza.operators.segments import ORDINAL, SEGMENT, over_segments, segment_of, with_ordinal
from cadenza.spec import HOURLY, PanelSpec


def sliding_windows(
    df: DataFrame,
    features: list[str],
    window: int,
    horizon: int = 1,
    stride: int = 1,
    spec: PanelSpec = HOURLY,
    carry: list[str] | None = None,
) -> DataFrame:
    """Every run of ``window`` rows of a series with its next ``horizon`` values.

    One row per window: ``origin_time`` (its last row), ``target_time`` (the last
    target), ``x`` (steps x features), ``y`` (the targets). Windows start at
    rows 0, stride, 2*stride... of the series, by position. Features must not be
    null. ``carry`` keeps columns of the origin row.
    """
    placed = with_ordinal(df, spec).withColumn("_row", F.array(*[F.col(c).cast("double") for c in features]))
    if stride > 1:
        return _strided(placed, window, horizon, stride, spec, carry or [])

    def made(w):
        past, future = w.rowsBetween(-(window - 1), 0), w.rowsBetween(1, horizon)
        return {
            "_in": F.count(F.lit(1)).over(past),
            "_out": F.count(F.lit(1)).over(future),
            "x": F.collect_list("_row").over(past),
            "y": F.collect_list(spec.value).over(future),
            "target_time": F.lead(spec.time, horizon).over(w),
        }

    windows = over_segments(
        placed, spec, made, before=window - 1, after=horizon, keep=(F.col("_in") == window) & (F.col("_out") == horizon))
    return windows.select(
        *spec.series, F.col(spec.time).alias("origin_time"), "target_time", "x", "y", *(carry or []))


def _strided(placed: DataFrame, window: int, horizon: int, stride: int, spec: PanelSpec, carry: list[str]) -> DataFrame:
    """Windows that start every ``stride`` rows: each row goes to the starts whose window holds it, and nothing else.

    Rows are dealt once by (series, segment of the start), a row near a border to both segments; the grouping by start
    needs no further exchange. A row is copied (window + horizon) / stride times inside its task, never if the windows
    leave it out.
    """
    length = window + horizon
    firsts = placed.groupBy(*spec.series).agg(F.min(ORDINAL).alias("_first"))
    place = F.col(ORDINAL) - F.col("_first")
    newest = place - F.pmod(place, F.lit(stride))
    size = max(spec.segment // stride, 1) * stride  # starts of one segment lie evenly
    oldest = F.greatest(place - (length - 1), F.lit(0))
    dealt = lookup_join(placed, firsts, spec.series).withColumns({"_place": place, "_newest": newest, "_oldest": oldest})
    dealt = dealt.withColumn("_oldest", F.col("_oldest") + F.pmod(-F.col("_oldest"), F.lit(stride))).where("_oldest <= _newest")
    dealt = dealt.withColumn(SEGMENT, F.explode(F.sequence(
        segment_of(F.col("_oldest"), size), segment_of(F.col("_newest"), size)))).repartition(*spec.series, SEGMENT)
    low, high = F.greatest("_oldest", F.col(SEGMENT) * size), F.least("_newest", F.col(SEGMENT) * size + (size - stride))
    started = dealt.withColumn("_start", F.explode(F.sequence(low, high, F.lit(stride).cast("bigint"))))
    step = F.struct("_place", spec.time, spec.value, "_row", *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    grouped = started.groupBy(*spec.series, SEGMENT, "_start").agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    steps, origin = F.col("_steps"), F.element_at("_steps", window)
    return grouped.where(F.size(steps) == length).select(
        *spec.series, origin[spec.time].alias("origin_time"), F.element_at(steps, length)[spec.time].alias("target_time"),
        F.transform(F.slice(steps, 1, window), lambda s: s["_row"]).alias("x"),
        F.transform(F.slice(steps, window + 1, horizon), lambda s: s[spec.value]).alias("y"),
        *[origin[f"_c{i}"].alias(c) for i, c in enumerate(carry)])


def windows_with_time(
    df: DataFrame,
    features: list[str],
    window: int,
    horizon: int = 1,
    stride: int = 1,
    spec: PanelSpec = HOURLY,
    carry: list[str] | None = None,
) -> DataFrame:
    """Sliding windows with a single target: the value at ``target_time``."""
    windows = sliding_windows(df, features, window, horizon, stride, spec, carry)
    return windows.withColumn("y", F.element_at("y", horizon))


def target_counts(
    df: DataFrame, window: int, horizon: int = 1, stride: int = 1, spec: PanelSpec = HOURLY,
) -> DataFrame:
    """How many windows have their last target at each time: what fold bounds and sizes need, at one row per step."""
    windows = sliding_windows(df, [], window, horizon, stride, spec)
    return windows.groupBy("target_time").agg(F.count(F.lit(1)).alias("n_windows"))


def windows_long(windows: DataFrame, features: list[str], keys: list[str]) -> DataFrame:
    """One row per window step, with the features as columns and ``step`` from 0."""
    return windows.select(*keys, F.posexplode("x").alias("step", "_row")).select(
        *keys, "step", *[F.col("_row")[i].alias(c) for i, c in enumerate(features)])


def window_ending_at(
    series: DataFrame, instants: DataFrame, features: list[str], window: int, spec: PanelSpec = HOURLY,
) -> DataFrame:
    """The last ``window`` steps up to ``end_time`` of each series, one row per step.

    Missing volumes and features are 0; calendar and wind features are made
    from the step itself.
    """
    stored = [c for c in series.columns if c not in [*spec.series, spec.time]]
    steps = steps_until(series, instants, window, stored, spec)
    steps = wind_features(time_features(steps, spec))
    aligned = align_features(steps, features)
    return steps.select(*spec.series, "end_time", spec.time, *[c.alias(n) for n, c in aligned.items()])


def collect_windows(steps: DataFrame, features: list[str], spec: PanelSpec = HOURLY) -> DataFrame:
    """Window rows as one array per series; each series has ``window`` rows here."""
    row = F.struct(spec.time, F.array(*[F.col(c).cast("double") for c in features]).alias("row"))
    ordered = F.array_sort(F.collect_list(row))
    return steps.groupBy(*spec.series, "end_time").agg(
        F.transform(ordered, lambda r: r["row"]).alias("x"))
