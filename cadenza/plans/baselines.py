"""Naive forecasts and the model comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.features import previous_value
from cadenza.operators.segments import over_segments
from cadenza.operators.metrics import regression_metrics, stack_models
from cadenza.operators.rank import ranked
from cadenza.operators.split import chronological_split
from cadenza.spec import HOURLY, PanelSpec

# Names and lags of the two baselines on an hourly panel.
NAIVE = {"Naive_LastValue": 1, "Naive_LastWeek": 168}


def test_part(panel: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    """The test rows of a panel. The panel is read several times: store it first."""
    return chronological_split(panel, spec).where(F.col("split") == "test").drop("split")


def naive_forecast(test: DataFrame, steps: int, spec: PanelSpec = HOURLY) -> DataFrame:
    """The value ``steps`` rows back, inside the given rows only."""
    return previous_value(test, steps, spec).select(
        *spec.series, spec.time, F.col(spec.value).alias("y_true"), "y_pred")


def naive_forecasts(test: DataFrame, spec: PanelSpec = HOURLY, lags: dict[str, int] = NAIVE) -> DataFrame:
    """All baselines as rows ``model, series, time, y_true, y_pred``, in one pass."""
    columns = {name: f"_lag{k}" for name, k in lags.items()}
    lagged = over_segments(
        test, spec, lambda w: {f"_lag{k}": F.lag(spec.value, k).over(w) for k in lags.values()},
        before=max(lags.values()))
    rows = stack_models(
        lagged.withColumnRenamed(spec.value, "y_true"), columns, [*spec.series, spec.time, "y_true"])
    return rows.where(F.col("y_pred").isNotNull())


def compare_models(predictions: DataFrame) -> DataFrame:
    """Error row per model, best first."""
    return ranked(regression_metrics(predictions, ["model"]))
