"""Stored window sets: raw and scaled windows, features and scaler state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass
class WindowSet:
    """Windows of one experiment, with what is needed to use a model made from them."""

    features: list[str]
    raw: DataFrame
    scaled: DataFrame
    scaler: DataFrame
    target: DataFrame
    window: int
    horizon: int


def save_windows(ws: WindowSet, path: str) -> None:
    """Windows by variant and split; scaler state and feature order beside them."""
    both = ws.raw.withColumn("variant", F.lit("raw")).unionByName(
        ws.scaled.withColumn("variant", F.lit("scaled")))
    both.write.mode("overwrite").partitionBy("variant", "split").parquet(f"{path}/windows")
    order = F.array(*[F.lit(c) for c in ws.features])
    state = ws.scaler.withColumn("place", F.array_position(order, F.col("feature")))
    state.withColumns({"window": F.lit(ws.window), "horizon": F.lit(ws.horizon)}).write.mode("overwrite").parquet(
        f"{path}/scaler")
    ws.target.withColumn("transform", F.lit("log1p+standardize(all_features)")).write.mode("overwrite").parquet(
        f"{path}/target")


def load_windows(spark: SparkSession, path: str) -> WindowSet:
    state = spark.read.parquet(f"{path}/scaler")
    rows = state.select("feature", "place", "window", "horizon").orderBy("place").collect()
    windows = spark.read.parquet(f"{path}/windows")
    return WindowSet(
        features=[r.feature for r in rows],
        raw=windows.where(F.col("variant") == "raw").drop("variant"),
        scaled=windows.where(F.col("variant") == "scaled").drop("variant"),
        scaler=state.select("feature", "mean", "std", "log1p"),
        target=spark.read.parquet(f"{path}/target").select("mean", "std"),
        window=rows[0].window, horizon=rows[0].horizon)
