"""Learners read windows as they are made, and come back from their files as they were."""

from math import sin

import pytest
from panel_helpers import at
from pyspark.sql import functions as F

from cadenza.operators import features, scale, split, windows
from cadenza.plans import evaluation, learners
from cadenza.session import materialize, scratch_path
from cadenza.spec import GRID, HOURLY

W = 4


@pytest.fixture(scope="module")
def frame(spark):
    rows = [(s, at(h), round(base + 9 * sin(h / 3) + h % 5, 3)) for s, base in (("a", 30.0), ("b", 70.0)) for h in range(24 * 8)]
    panel = spark.createDataFrame(rows, "spot_num string, datetime timestamp_ntz, vol double")
    made, names = features.feature_frame(panel, weather=False, ids=features.series_ids(panel))
    return materialize(made, "frame"), names


def both(frame, names):
    made = windows.windows_with_time(frame, names, W, spec=GRID, carry=["spot_id"])
    counted = scale.with_window_counts(frame, W, spec=GRID)
    return made, [
        learners.fit_boosted(made, names, keep=["vol", "hour_sin"], trees=3, depth=3),
        learners.fit_linear(made, names, scale.fit_feature_scaler(counted, names), scale.fit_target_scaler(counted), epsilon=0.5),
    ]


def test_stored_learners_forecast_alike(spark, frame):
    made, fitted = both(*frame)
    for model in fitted:
        path = scratch_path(spark, "model")
        learners.save_model(model, spark, path)
        back = learners.load_model(spark, path)
        assert (type(back), back.features, back.have) == (type(model), model.features, model.have)
        both_ways = back.predict(model.predict(made, "before"), "after")
        assert both_ways.where("NOT (before <=> after)").isEmpty() and not both_ways.isEmpty()


def test_a_path_is_never_overwritten(spark, frame):
    _, (boosted, linear) = both(*frame)
    path = scratch_path(spark, "model")
    learners.save_model(boosted, spark, path)
    with pytest.raises(Exception, match="(?i)exist"):
        learners.save_model(linear, spark, path)
    assert isinstance(learners.load_model(spark, path), learners.BoostedTrees)


def test_fits_store_no_windows(frame, monkeypatch):
    stored = []
    monkeypatch.setattr(evaluation, "materialize", lambda df, label, **kw: (stored.append(df.columns), materialize(df, label, **kw))[1])
    chosen = {"Linear": evaluation.linear_learner, "Last": lambda fold: learners.Persistence(fold.features)}
    made, names = frame
    evaluation.rolling_evaluation(made.select("spot_num", "datetime", "vol"), chosen, W, n_folds=2, test_days=2,
                                  min_train_days=3, min_train=10, min_test=10, spec=GRID).collect()
    assert stored and not any("x" in columns for columns in stored)


def test_folds_of_dense_panels_equal_counted_ones(frame):
    panel = frame[0].select("spot_num", "datetime", "vol")
    chosen = {"Last": lambda fold: learners.Persistence(fold.features)}
    settings = {"n_folds": 2, "test_days": 2, "min_train_days": 3, "min_train": 10, "min_test": 10}
    reports = [evaluation.rolling_evaluation(panel, chosen, W, **settings, spec=s).orderBy("fold").collect() for s in (GRID, HOURLY)]
    assert reports[0] == reports[1] and len(reports[0]) == 2


@pytest.mark.parametrize("stride", [1, 3])
def test_target_counts_are_those_of_windows(frame, stride):
    made, names = frame
    counts = windows.target_counts(made, W, 2, stride, GRID)
    plain = windows.sliding_windows(made, names, W, 2, stride, GRID).groupBy("target_time").agg(F.count(F.lit(1)).alias("n_windows"))
    assert counts.exceptAll(plain).isEmpty() and plain.exceptAll(counts).isEmpty()
    sizes = split.fold_sizes(split.assign_folds(counts, "target_time", 2, 2, 3), 1, 1, "n_windows")
    rows = windows.sliding_windows(made, names, W, 2, stride, GRID).select("target_time")
    want = split.fold_sizes(split.assign_folds(rows, "target_time", 2, 2, 3), 1, 1)
    assert sizes.exceptAll(want).isEmpty() and want.exceptAll(sizes).isEmpty()
