"""A panel to split, scaled, windowed training data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.features import feature_frame, series_ids
from cadenza.operators.scale import (
    LOG_FEATURES, fit_feature_scaler, fit_target_scaler, scale_features, with_window_counts)
from cadenza.operators.split import chronological_split
from cadenza.operators.windows import sliding_windows
from cadenza.functions.scaling import transform_target
from cadenza.session import materialize
from cadenza.sources.windows import WindowSet
from cadenza.spec import HOURLY, PanelSpec


def split_features(
    panel: DataFrame,
    spec: PanelSpec = HOURLY,
    time: bool = True,
    weather: bool = True,
    spot_id: bool = True,
    look_back: bool = False,
) -> tuple[DataFrame, list[str], PanelSpec]:
    """Panel split by time, then features made inside each split.

    Changes and lags restart in each split, so nothing leaks across a cut;
    ``look_back`` makes them on the whole panel instead.
    """
    ids = series_ids(panel, spec) if spot_id else None
    inside = spec.but(group=(*spec.group, "split"))
    if look_back:
        frame, names = feature_frame(panel, spec, time, weather, ids)
        return chronological_split(frame, spec), names, inside
    frame, names = feature_frame(chronological_split(panel, spec), inside, time, weather, ids)
    return frame, names, inside


def make_windows(
    panel: DataFrame,
    window: int = 24,
    horizon: int = 1,
    stride: int = 1,
    spec: PanelSpec = HOURLY,
    time: bool = True,
    weather: bool = True,
    spot_id: bool = True,
) -> WindowSet:
    """Raw and scaled windows of all splits, with scalers fitted on the training split.

    Scaling is applied to rows before the windows are built. The feature frame
    is written once, since scalers and both window variants read it.
    """
    frame, names, inside = split_features(panel, spec, time, weather, spot_id)
    carry = ["spot_id"] if spot_id else []
    frame = materialize(frame, "features")
    counted = with_window_counts(frame.where(F.col("split") == "train"), window, horizon, stride, inside)
    scaler = fit_feature_scaler(counted, names)
    target = fit_target_scaler(counted, spec)
    mean, std = target.select("mean").scalar(), target.select("std").scalar()
    raw = sliding_windows(frame, names, window, horizon, stride, inside, carry)
    goal = spec.but(value="_goal", group=inside.group)
    labelled = frame.withColumn("_goal", transform_target(F.col(spec.value), mean, std))
    scaled = sliding_windows(
        scale_features(labelled, scaler, names, LOG_FEATURES), names, window, horizon, stride, goal, carry)
    return WindowSet(names, raw, scaled, scaler, target, window, horizon)
