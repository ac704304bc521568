"""Ranking and top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.text import numeric
from cadenza.operators.clean import require_columns


def ranked(metrics: DataFrame, metric: str = "RMSE") -> DataFrame:
    return metrics.orderBy(F.asc_nulls_last(metric), *(["model"] if "model" in metrics.columns else []))


def best_model(metrics: DataFrame, metric: str = "RMSE") -> DataFrame:
    """The row with the smallest metric; ties by MAPE, MAE, then name, missing last."""
    order = [metric, "MAPE", "MAE"]
    require_columns(metrics, order)
    typed = metrics.withColumns({c: numeric(metrics, c) for c in dict.fromkeys(order)}).dropna(subset=[metric])
    names = ["model"] if "model" in metrics.columns else []
    return typed.orderBy(*[F.asc_nulls_last(c) for c in [*order, *names]]).limit(1)


def top_rows(df: DataFrame, column: str, n: int = 50, ties: list[str] | None = None) -> DataFrame:
    """The n rows with the greatest value, missing last."""
    return df.orderBy(F.desc_nulls_last(column), *(ties or [])).limit(n)


def head(df: DataFrame, order: list[str], n: int = 50) -> DataFrame:
    return df.orderBy(*order).limit(n)


def sorted_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def importance_by_feature(importances: DataFrame, features: list[str]) -> DataFrame:
    """Importances of flattened window cells summed per feature, with percentages.

    Input rows are ``pos, importance``; cells are time-major, so the feature is
    the position modulo the number of features.
    """
    names = F.array(*[F.lit(c) for c in features])
    feature = F.element_at(names, (F.pmod("pos", F.lit(len(features))) + 1).cast("int"))
    sums = importances.groupBy(feature.alias("feature")).agg(F.sum("importance").alias("importance"))
    total = sums.agg(F.sum("importance")).scalar()
    share = F.when(total > 0, F.col("importance") / total * 100).otherwise(F.lit(0.0))
    return sums.withColumn("importance_pct", share).orderBy(F.desc("importance"), "feature")


def top_features(
    importance: DataFrame, k: int, always: tuple[str, ...] = (), drop: tuple[str, ...] = ("wind_dir_deg",),
) -> DataFrame:
    """The k most important features in order, with pinned ones moved to the front.

    One row per feature: ``position, feature``. Pinned features are kept in
    their order even if unranked; dropped ones never appear. One row per
    feature is all this ever sorts.
    """
    spark = importance.sparkSession
    if k <= 0:
        return spark.createDataFrame([], "position int, feature string")
    rank = F.row_number().over(Window.orderBy(F.desc("importance"), "feature"))
    wanted = importance.where(~F.col("feature").isin(list(drop))) if drop else importance
    picked = wanted.select("feature", rank.alias("_rank")).where(F.col("_rank") <= k)
    pins = [(f, i - len(always)) for i, f in enumerate(always) if f not in drop]
    if pins:
        entries = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(r).alias("_rank")) for f, r in pins])
        picked = picked.unionByName(spark.range(1).select(F.inline(entries)))
    firsts = picked.groupBy("feature").agg(F.min("_rank").alias("_rank"))
    return firsts.select(F.row_number().over(Window.orderBy("_rank")).alias("position"), "feature")
