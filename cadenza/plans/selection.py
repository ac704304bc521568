"""Choice of the final model from metrics files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import tag_number
from cadenza.operators.rank import best_model


def selection_record(metrics: DataFrame, metric: str = "RMSE", horizon: int = 1, registry: DataFrame | None = None) -> DataFrame:
    """One nested record of the best model.

    The artifact path comes from a run registry (``model, artifact_path``), by
    exact name.
    """
    best = best_model(metrics, metric)
    if registry is not None:
        best = best.join(registry.select("model", "artifact_path"), "model", "left")
    path = F.col("artifact_path") if registry is not None else F.lit(None).cast("string")
    source = F.col("metrics_file") if "metrics_file" in metrics.columns else F.lit(None).cast("string")
    return best.select(
        F.col("model").alias("final_model_name"), path.alias("artifact_path"), F.lit(metric).alias("selected_by"),
        tag_number(F.col("model")).alias("window"), F.lit(horizon).alias("horizon"),
        F.struct("MAE", "RMSE", "MAPE").alias("metrics"), source.alias("source_metrics_file"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("selected_at"))
