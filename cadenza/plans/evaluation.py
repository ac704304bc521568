"""Rolling-origin evaluation and per-spot backtests."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import date_text, moment, shift_time, tick_of
from cadenza.operators.features import feature_frame, series_ids
from cadenza.operators.joins import lookup_join
from cadenza.operators.metrics import mean_by_model, metrics_by_spot, regression_metrics, stack_models
from cadenza.operators.scale import (
    fit_feature_scaler, fit_target_scaler, fold_log_features, with_window_counts)
from cadenza.operators.sets import stack
from cadenza.operators.split import assign_folds, fold_sizes, fold_table, origin_bounds
from cadenza.operators.windows import target_counts, windows_with_time
from cadenza.plans.learners import FOLD_TREES, fit_boosted, fit_linear
from cadenza.session import materialize
from cadenza.spec import HOURLY, PanelSpec


@dataclass
class Fold:
    """What a learner gets to see of one fold."""

    train: DataFrame
    frame: DataFrame
    features: list[str]
    window: int
    horizon: int
    stride: int
    start: datetime
    end: datetime
    spec: PanelSpec


def boosted_learner(trees: int = FOLD_TREES, depth: int = 6) -> Callable[[Fold], object]:
    return lambda fold: fit_boosted(fold.train, fold.features, trees=trees, depth=depth)


def linear_learner(fold: Fold) -> object:
    """Scaled linear model; its scalers see the windows of the training range only."""
    logs = fold_log_features(fold.features)
    counted = with_window_counts(
        fold.frame, fold.window, fold.horizon, fold.stride, fold.spec, moment(fold.start), moment(fold.end))
    return fit_linear(
        fold.train, fold.features, fit_feature_scaler(counted, fold.features, logs, folds=True),
        fit_target_scaler(counted, fold.spec, folds=True), log_features=logs, epsilon=0.0)


def rolling_evaluation(
    panel: DataFrame,
    learners: dict[str, Callable[[Fold], object]] | None = None,
    window: int = 168,
    horizon: int = 1,
    stride: int = 1,
    n_folds: int = 4,
    test_days: int = 14,
    min_train_days: int = 90,
    min_train: int = 1000,
    min_test: int = 200,
    expanding: bool = False,
    spec: PanelSpec = HOURLY,
) -> DataFrame:
    """Errors of each learner per fold: one row per fold and model, with the fold's dates.

    The feature table is written once and windows are made where a fit or a
    scoring reads them; of a dense panel only the rows that a fold's windows
    hold. The driver loops over the few folds, and each fit and each scoring
    runs on the cluster. Folds which are too small are skipped.
    """
    chosen = learners or {"Boosted": boosted_learner(), "Linear": linear_learner}
    ids = series_ids(panel, spec)
    frame, names = feature_frame(panel, spec, ids=ids, change="lag", gaps="zero")
    frame = materialize(frame, "features")
    targets = materialize(target_counts(frame, window, horizon, stride, spec), "targets")
    if targets.isEmpty():
        raise ValueError("no windows: check window, horizon, stride and the length of the series")
    folds = fold_table(targets, "target_time", n_folds, test_days, min_train_days, expanding)
    sizes = fold_sizes(
        assign_folds(targets, "target_time", n_folds, test_days, min_train_days, expanding), min_train, min_test,
        "n_windows")
    reach = spec.step_seconds * (window + horizon)

    def windows_between(start: datetime, end: datetime) -> DataFrame:
        """Windows with their target in [start, end)."""
        rows, t, target = frame, F.col(spec.time), F.col("target_time")
        if spec.dense and stride == 1:  # positions are times, and each row starts a window
            rows = frame.where((t >= shift_time(moment(start), seconds=-reach)) & (t < moment(end)))
        made = windows_with_time(rows, names, window, horizon, stride, spec, ["spot_id"])
        return made.where((target >= moment(start)) & (target < moment(end)))

    reports = []
    for bounds in folds.join(sizes.where("used"), "fold").orderBy("fold").collect():
        train = windows_between(bounds.train_start, bounds.train_end)
        scored = windows_between(bounds.test_start, bounds.test_end)
        fold = Fold(train, frame, names, window, horizon, stride, bounds.train_start, bounds.train_end, spec)
        for name, learner in chosen.items():
            scored = learner(fold).predict(scored, f"_{name}")
        stacked = stack_models(scored, {name: f"_{name}" for name in chosen}, ["y"])
        errors = regression_metrics(stacked, ["model"], "y")
        day = "%Y-%m-%d"
        reports.append(errors.select(
            F.lit(bounds.fold).alias("fold"), "model",
            F.lit(bounds.train_start.strftime(day)).alias("train_start"),
            F.lit(bounds.train_end.strftime(day)).alias("train_end"),
            F.lit(bounds.test_start.strftime(day)).alias("test_start"),
            F.lit(test_days).alias("test_days"), "MAE", "RMSE", "MAPE"))
    if not reports:
        raise ValueError("no fold is large enough")
    return stack(reports)


def rolling_summary(report: DataFrame) -> DataFrame:
    return mean_by_model(report)


def backtest_predictions(
    panel: DataFrame,
    features: list[str],
    models: dict,
    window: int = 168,
    horizon: int = 1,
    eval_days: int = 30,
    stride: int = 1,
    spec: PanelSpec = HOURLY,
) -> DataFrame:
    """Forecasts of fixed models at each origin of each spot: ``spot, t, y_true`` and one column per model.

    ``panel`` is a feature frame. Only rows that some origin's window needs are
    windowed; of a dense panel, whose windows start where positions and times
    agree, only windows that end at an origin are built.
    """
    step = spec.step_seconds
    bounds = origin_bounds(panel, window, horizon, eval_days, spec)
    needed = lookup_join(panel, bounds, spec.series, "inner").where(
        F.col(spec.time) > shift_time(F.col("first_origin"), seconds=-window * step))
    carry = ["first_origin", "last_origin", *(["spot_id"] if "spot_id" in panel.columns else [])]
    windows = windows_with_time(needed, features, window, horizon, stride if spec.dense else 1, spec, carry)
    gap = tick_of(F.col("origin_time"), step) - tick_of(F.col("first_origin"), step)
    origins = windows.where(
        (gap >= 0) & (F.pmod(gap, F.lit(stride)) == 0) & (F.col("origin_time") <= F.col("last_origin")))
    scored = origins
    for name, model in models.items():
        scored = model.predict(scored, name)
    return scored.select(*spec.series, F.col("origin_time").alias("t"), F.col("y").alias("y_true"), *models)


def backtest_summary(predictions: DataFrame, models: list[str], min_rows: int = 10, spec: PanelSpec = HOURLY) -> DataFrame:
    """Errors per spot and model."""
    stacked = stack_models(predictions, {m: m for m in models}, [*spec.series, "y_true"])
    return metrics_by_spot(stacked, [*spec.series, "model"], min_rows=min_rows)


def fold_dates(folds: DataFrame) -> DataFrame:
    """Fold bounds as dates, as reports show them."""
    return folds.select("fold", *[date_text(F.col(c)).alias(c) for c in (
        "train_start", "train_end", "test_start", "test_end")])
