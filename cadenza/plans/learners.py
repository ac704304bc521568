"""Learners on flattened windows, all fitted and applied by MLlib.

Fits read windows as they are made from the rows of a feature table: no learner writes a table of windows, which would be
as many times the panel as a window has steps. MLlib keeps its own compact copy of what it iterates over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.arrays import flat, pick_features
from cadenza.functions.scaling import clipped_log, inverse_target, standardize, transform_target
from cadenza.operators.clean import require_same_features
from cadenza.operators.rank import importance_by_feature, top_features
from cadenza.operators.scale import IDENTITY_FEATURE, LOG_FEATURES
from cadenza.session import shared_dir

# Settings of the boosted learner, and of its use in rolling folds.
TREES = 800
FOLD_TREES = 600
LEARNING_RATE = 0.05
DEPTH = 6
ROW_SHARE = 0.9
COLUMN_SHARE = "0.9"
SEED = 42
VARIED = 1e-9
# One solver at any number of inputs; "auto" would change the method above 4096 of them.
LINEAR_ROUNDS = 200
LINEAR_TOLERANCE = 1e-9
# Features the second learner always keeps, in order.
ALWAYS_KEEP = ("vol", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend")


@dataclass
class BoostedTrees:
    """Boosted trees on raw windows. ``have`` names the features inside ``x``."""

    model: GBTRegressionModel
    features: list[str]
    have: list[str]

    def predict(self, windows: DataFrame, name: str = "y_pred") -> DataFrame:
        vector = array_to_vector(flat(pick_features(F.col("x"), self.have, self.features)))
        scored = self.model.transform(windows.withColumn("_vector", vector))
        return scored.withColumnRenamed("_prediction", name).drop("_vector")


@dataclass
class Persistence:
    """The baseline as a model on windows: the value ``steps`` rows before the target of step 1."""

    features: list[str]
    steps: int = 1
    value: str = "vol"

    def predict(self, windows: DataFrame, name: str = "y_pred") -> DataFrame:
        row = F.element_at("x", -self.steps)
        return windows.withColumn(name, row[self.features.index(self.value)])


def fit_boosted(
    windows: DataFrame,
    features: list[str],
    keep: list[str] | None = None,
    trees: int = TREES,
    depth: int = DEPTH,
    row_share: float = ROW_SHARE,
) -> BoostedTrees:
    """Fit on raw windows (``x``, scalar ``y``), optionally on a subset of the features."""
    shared_dir(windows.sparkSession)
    used = [c for c in (keep or features) if c in features] or features
    vector = array_to_vector(flat(pick_features(F.col("x"), features, used)))
    learner = GBTRegressor(
        featuresCol="_vector", labelCol="y", predictionCol="_prediction", maxIter=trees, stepSize=LEARNING_RATE,
        maxDepth=depth, subsamplingRate=row_share, featureSubsetStrategy=COLUMN_SHARE, seed=SEED,
        checkpointInterval=10)
    return BoostedTrees(learner.fit(windows.select(vector.alias("_vector"), "y")), used, features)


def cell_importances(fitted: BoostedTrees, like: DataFrame) -> DataFrame:
    """Importance of each flattened window cell, one row per cell (a model-sized table)."""
    values = fitted.model.featureImportances.toArray()
    rows = [(i, float(v)) for i, v in enumerate(values)]
    return like.sparkSession.createDataFrame(rows, "pos int, importance double")


def choose_features(fitted: BoostedTrees, like: DataFrame, k: int) -> list[str]:
    """Names of the k most important features after the pinned ones."""
    table = importance_by_feature(cell_importances(fitted, like), fitted.features)
    picked = top_features(table, k, ALWAYS_KEEP, (IDENTITY_FEATURE,))
    return [row.feature for row in picked.orderBy("position").collect()]


def scaled_windows(x: Column, features: list[str], state: Column, log_features: list[str], epsilon: float) -> Column:
    """Raw window cells to scaled ones."""
    def scaled(step):
        cells = []
        for i, c in enumerate(features):
            value = clipped_log(step[i]) if c in log_features and c != IDENTITY_FEATURE else step[i]
            cells.append(standardize(value, state[c]["mean"], state[c]["std"], epsilon))
        return F.array(*cells)

    return F.transform(x, scaled)


@dataclass
class ScaledLinear:
    """Linear model on scaled windows and the one-hot spot, predicting the scaled target."""

    model: PipelineModel
    features: list[str]
    have: list[str]
    state: dict
    target: tuple[float, float]
    log_features: list[str]
    epsilon: float

    def predict(self, windows: DataFrame, name: str = "y_pred") -> DataFrame:
        """Forecasts on the original scale from raw windows with ``spot_id``."""
        prepared = windows.withColumn("_vector", self._vector())
        scored = self.model.transform(prepared)
        mean, std = (F.lit(v) for v in self.target)
        return scored.withColumn(name, inverse_target(F.col("_prediction"), mean, std)).drop(
            "_vector", "_spot", "_all", "_varied", "_prediction")

    def _vector(self) -> Column:
        x = pick_features(F.col("x"), self.have, self.features)
        entries = []
        for c in self.features:
            mean, std, _ = self.state[c]
            entries += [F.lit(c), F.struct(F.lit(mean).alias("mean"), F.lit(std).alias("std"))]
        state = F.create_map(*entries)
        return array_to_vector(flat(scaled_windows(x, self.features, state, self.log_features, self.epsilon)))


def fit_linear(
    windows: DataFrame,
    features: list[str],
    scaler: DataFrame,
    target: DataFrame,
    keep: list[str] | None = None,
    log_features: list[str] = LOG_FEATURES,
    epsilon: float = 1e-8,
    regularization: float = 1e-3,
) -> ScaledLinear:
    """Second learner: scaled inputs without the spot id, which enters one-hot.

    ``scaler`` (one row per feature) and ``target`` (one row) come from the
    training windows; they are the model's own state.
    """
    used = [c for c in (keep or features) if c in features and c != IDENTITY_FEATURE]
    state = {r.feature: (r["mean"], r["std"], r["log1p"]) for r in scaler.collect()}
    require_same_features(sorted(state), sorted(features))
    goal = target.first()
    fitted = ScaledLinear(None, used, features, state, (goal["mean"], goal["std"]), log_features, epsilon)
    train = windows.select(
        "spot_id", fitted._vector().alias("_vector"),
        transform_target(F.col("y"), F.lit(goal["mean"]), F.lit(goal["std"])).alias("_goal"))
    stages = [
        OneHotEncoder(inputCol="spot_id", outputCol="_spot", handleInvalid="keep"),
        VectorAssembler(inputCols=["_vector", "_spot"], outputCol="_all"),
        # Cells that never change in training carry only rounding noise.
        VarianceThresholdSelector(featuresCol="_all", outputCol="_varied", varianceThreshold=VARIED),
        LinearRegression(featuresCol="_varied", labelCol="_goal", predictionCol="_prediction",
                         regParam=regularization, standardization=False,
                         solver="l-bfgs", maxIter=LINEAR_ROUNDS, tol=LINEAR_TOLERANCE),
    ]
    fitted.model = Pipeline(stages=stages).fit(train)
    return fitted


def one_target(windows: DataFrame, horizon: int = 1) -> DataFrame:
    """Windows with the target vector reduced to its last value."""
    return windows.withColumn("y", F.element_at("y", horizon))


#: One row of state beside the files that MLlib writes: kind, names, scaler and target of a fitted learner.
STORED_STATE = (
    "kind string, features array<string>, have array<string>, scaler array<struct<feature:string,mean:double,std:double,"
    "log1p:int>>, target struct<mean:double,std:double>, log_features array<string>, epsilon double")


def save_model(fitted: BoostedTrees | ScaledLinear, spark: SparkSession, path: str) -> None:
    """Write a fitted learner with its feature names and scaler states below ``path``, which must not exist yet."""
    if isinstance(fitted, ScaledLinear):
        scaler = [(c, *fitted.state[c]) for c in sorted(fitted.state)]
        row = ("linear", fitted.features, fitted.have, scaler, fitted.target, fitted.log_features, fitted.epsilon)
    else:
        row = ("boosted", fitted.features, fitted.have, None, None, None, None)
    fitted.model.save(f"{path}/model")
    spark.createDataFrame([row], STORED_STATE).coalesce(1).write.mode("errorifexists").parquet(f"{path}/state")


def load_model(spark: SparkSession, path: str) -> BoostedTrees | ScaledLinear:
    """A learner as ``save_model`` wrote it, in any session that reaches the path."""
    row = spark.read.schema(STORED_STATE).parquet(f"{path}/state").first()
    if row.kind == "boosted":
        return BoostedTrees(GBTRegressionModel.load(f"{path}/model"), row.features, row.have)
    return ScaledLinear(
        PipelineModel.load(f"{path}/model"), row.features, row.have, {e[0]: (e[1], e[2], e[3]) for e in row.scaler},
        (row.target["mean"], row.target["std"]), row.log_features, row.epsilon)
