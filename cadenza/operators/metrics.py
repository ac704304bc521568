"""Forecast errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: smallest denominator of a percentage error.
MAPE_FLOOR = 1e-6


def error_columns(truth: str = "y_true", guess: str = "y_pred", absolute: bool = True, percent_name: str = "MAPE") -> list[Column]:
    """MAE, RMSE and MAPE aggregates.

    The percentage error divides by max(|y|, floor), or by max(y, floor) if not
    ``absolute``.
    """
    y, e = F.col(truth).cast("double"), F.col(truth) - F.col(guess)
    base = F.greatest(F.abs(y) if absolute else y, F.lit(MAPE_FLOOR))
    return [
        F.avg(F.abs(e)).alias("MAE"),
        F.sqrt(F.avg(e * e)).alias("RMSE"),
        (F.avg(F.abs(e / base)) * 100).alias(percent_name),
    ]


def regression_metrics(predictions: DataFrame, by: list[str] | None = None, truth: str = "y_true", guess: str = "y_pred") -> DataFrame:
    """Errors over all rows, or per group."""
    grouped = predictions.groupBy(*(by or []))
    return grouped.agg(*error_columns(truth, guess))


def metrics_by_spot(
    predictions: DataFrame, by: list[str], truth: str = "y_true", guess: str = "y_pred", min_rows: int = 10,
) -> DataFrame:
    """Errors and row count per group with at least ``min_rows`` rows."""
    return predictions.groupBy(*by).agg(
        *error_columns(truth, guess, absolute=False, percent_name="MAPE(%)"),
        F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows)


def mean_by_model(metrics: DataFrame, columns: list[str] | None = None, by: str = "model") -> DataFrame:
    """Unweighted mean of metric rows, over folds or spots."""
    names = columns or [c for c in ("MAE", "RMSE", "MAPE", "MAPE(%)") if c in metrics.columns]
    return metrics.groupBy(by).agg(*[F.avg(F.col(f"`{c}`")).alias(c) for c in names])


def stack_models(predictions: DataFrame, models: dict[str, str], keep: list[str]) -> DataFrame:
    """One prediction column per model to one row per model."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("y_pred"))
                     for m, c in models.items()])
    return predictions.select(*keep, F.inline(rows))
