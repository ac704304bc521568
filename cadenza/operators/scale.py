"""Scalers fitted on windows, without building the windows.

A row is counted once per window that contains it. That number follows from the
row's position, so means and variances are weighted sums over plain rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.scaling import SCALE_EPSILON, clipped_log, standardize
from cadenza.operators.joins import lookup_join
from cadenza.operators.segments import ORDINAL, with_ordinal
from cadenza.spec import HOURLY, PanelSpec

# Features scaled after a log.
LOG_FEATURES = ["vol", "rain_mm", "snow_cm"]
# Further features scaled after a log in rolling evaluation.
FOLD_LOG_FEATURES = [
    "vol", "temp_c", "rain_mm", "wind_ms", "humidity_pct", "pressure_hpa", "snow_cm", "cloud_total_10",
]
VARIANCE_FLOOR = 1e-8
STD_FLOOR = 1e-6
IDENTITY_FEATURE = "spot_id"


def fold_log_features(features: list[str]) -> list[str]:
    return [c for c in features if c in FOLD_LOG_FEATURES or c.endswith(("_lag1", "_diff1"))]


def _starts_between(low: Column, high: Column, stride: int) -> Column:
    """How many window starts 0, stride, 2*stride... lie in [low, high]."""
    last = F.floor(high / stride)
    first = F.ceil(F.greatest(low, F.lit(0)) / stride)
    return F.greatest(last - first + 1, F.lit(0))


def with_window_counts(
    df: DataFrame,
    window: int,
    horizon: int = 1,
    stride: int = 1,
    spec: PanelSpec = HOURLY,
    target_from: Column | None = None,
    target_until: Column | None = None,
) -> DataFrame:
    """Add ``n_inputs`` and ``n_targets``: windows that use a row as input and as target.

    With target bounds only windows whose last target time lies in
    [target_from, target_until) count.
    """
    placed = with_ordinal(df, spec)
    bounds = [F.min(ORDINAL).alias("_lo"), F.count(F.lit(1)).alias("_n")]
    if target_from is not None:
        t = F.col(spec.time)
        inside = (t >= target_from) & (t < target_until)
        bounds += [F.min(F.when(inside, F.col(ORDINAL))).alias("_t0"),
                   F.max(F.when(inside, F.col(ORDINAL))).alias("_t1")]
    edges = placed.groupBy(*spec.series).agg(*bounds)
    joined = lookup_join(placed, edges, spec.series)
    row = F.col(ORDINAL) - F.col("_lo")
    last_start = F.col("_n") - window - horizon
    reach = window + horizon - 1
    lowest, highest = F.lit(0), last_start
    if target_from is not None:
        lowest = F.col("_t0") - F.col("_lo") - reach
        highest = F.least(last_start, F.col("_t1") - F.col("_lo") - reach)

    def count(low, high):
        made = _starts_between(F.greatest(low, lowest), F.least(high, highest), stride)
        return F.coalesce(F.when(highest >= 0, made), F.lit(0)).cast("bigint")

    return joined.withColumns({
        "n_inputs": count(row - (window - 1), row),
        "n_targets": count(row - reach, row - window),
    }).drop(ORDINAL, "_lo", "_n", "_t0", "_t1")


def fit_feature_scaler(
    counted: DataFrame, features: list[str], log_features: list[str] = LOG_FEATURES, folds: bool = False,
) -> DataFrame:
    """Mean and population deviation per feature over all window cells.

    One row per feature: ``feature, mean, std, log1p``. The spot id is left as
    it is. Default: variance floored at 1e-8. ``folds``: a deviation below 1e-6
    becomes 1.
    """
    m = F.col("n_inputs").cast("double")
    logged = {c: int(c in log_features and c != IDENTITY_FEATURE) for c in features}
    value = {c: clipped_log(F.col(c)) if logged[c] else F.col(c).cast("double") for c in features}
    sums = counted.agg(
        F.sum(m).alias("_m"),
        *[F.sum(m * value[c]).alias(f"_s_{c}") for c in features],
        *[F.sum(m * value[c] * value[c]).alias(f"_q_{c}") for c in features],
    )
    entries = []
    for c in features:
        mean = F.try_divide(F.col(f"_s_{c}"), F.col("_m"))
        variance = F.try_divide(F.col(f"_q_{c}"), F.col("_m")) - mean * mean
        if folds:
            deviation = F.sqrt(F.greatest(variance, F.lit(0.0)))
            std = F.when(deviation < STD_FLOOR, F.lit(1.0)).otherwise(deviation)
        else:
            std = F.sqrt(F.greatest(variance, F.lit(VARIANCE_FLOOR)))
        if c == IDENTITY_FEATURE:
            mean, std = F.lit(0.0), F.lit(1.0)
        entries.append(F.struct(F.lit(c).alias("feature"), mean.alias("mean"), std.alias("std"),
                                F.lit(logged[c]).alias("log1p")))
    return sums.select(F.inline(F.array(*entries)))


def fit_target_scaler(counted: DataFrame, spec: PanelSpec = HOURLY, folds: bool = False) -> DataFrame:
    """Mean and population deviation of the logged targets, one row."""
    m = F.col("n_targets").cast("double")
    y = clipped_log(F.col(spec.value))
    sums = counted.agg(F.sum(m).alias("_m"), F.sum(m * y).alias("_s"), F.sum(m * y * y).alias("_q"))
    mean = F.try_divide(F.col("_s"), F.col("_m"))
    deviation = F.sqrt(F.greatest(F.try_divide(F.col("_q"), F.col("_m")) - mean * mean, F.lit(0.0)))
    std = (F.when(deviation > STD_FLOOR, deviation).otherwise(F.lit(1.0)) if folds
           else deviation + F.lit(SCALE_EPSILON))
    return sums.select(mean.alias("mean"), std.alias("std"))


def scaler_state(scaler: DataFrame) -> Column:
    """A fitted scaler (one row per feature) as a scalar map, feature to state."""
    entry = F.struct("feature", F.struct("mean", "std", "log1p").alias("state"))
    return scaler.agg(F.map_from_entries(F.collect_list(entry))).scalar()


def scale_features(
    df: DataFrame, scaler: DataFrame, features: list[str], log_features: list[str] = LOG_FEATURES, epsilon: float = SCALE_EPSILON,
) -> DataFrame:
    """Replace features by their scaled values, before any windows are built."""
    named = df.withColumn("_state", scaler_state(scaler))

    def scaled(c):
        state = F.col("_state")[c]
        value = clipped_log(F.col(c)) if c in log_features and c != IDENTITY_FEATURE else F.col(c).cast("double")
        return standardize(value, state["mean"], state["std"], epsilon)

    return named.withColumns({c: scaled(c) for c in features}).drop("_state")
