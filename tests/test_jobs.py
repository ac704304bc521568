from math import pi, sin

import pytest
from panel_helpers import at
from pyspark.sql import functions as F

from cadenza.operators import features, scale, windows
from cadenza.operators.metrics import regression_metrics
from cadenza.plans import baselines, evaluation, forecast, learners, training
from cadenza.session import materialize
from cadenza.spec import GRID

W = 6


@pytest.fixture(scope="module")
def data(spark):
    """Two daily waves of different height over 12 days, with weather."""
    rows = [(s, at(h), round(base + 20 * sin(2 * pi * h / 24), 3), float(h % 7))
            for s, base in (("a", 40.0), ("b", 90.0)) for h in range(24 * 12)]
    panel = spark.createDataFrame(rows, "spot_num string, datetime timestamp_ntz, vol double, temp_c double")
    frame, names = features.feature_frame(panel, ids=features.series_ids(panel))
    frame = materialize(frame, "frame")
    made = materialize(windows.windows_with_time(frame, names, W, carry=["spot_id"]), "made")
    return panel, frame, names, made


@pytest.fixture(scope="module")
def models(data):
    _, frame, names, made = data
    train = made.where(F.col("target_time") < at(24 * 9))
    counted = scale.with_window_counts(frame.where(F.col("datetime") < at(24 * 9)), W)
    return (learners.fit_boosted(train, names, trees=5, depth=4),
            learners.fit_linear(train, names, scale.fit_feature_scaler(counted, names), scale.fit_target_scaler(counted)))


def test_learners_beat_the_last_value(data, models):
    panel, _, _, made = data
    test = made.where(F.col("target_time") >= at(24 * 9))
    scored = models[1].predict(models[0].predict(test, "boosted"), "linear")
    naive = baselines.naive_forecast(panel.where(F.col("datetime") >= at(24 * 9)), 1)
    floor = regression_metrics(naive).first().RMSE
    for column in ("boosted", "linear"):
        assert regression_metrics(scored, None, "y", column).first().RMSE < floor
    assert scored.count() == test.count()


def test_train_and_compare_ranks_all_models(data):
    panel, _, _, _ = data
    got = training.train_and_compare(panel, W, trees=3, depth=4, top_k=3, lags={"Last": 1, "Day": 24}, tag="_w6").collect()
    assert {r.model for r in got} == {"Last", "Day", "Boosted_w6", "Linear_w6"}
    assert [r.RMSE for r in got] == sorted(r.RMSE for r in got)
    assert got[0].model == "Day" and got[0].RMSE == 0.0


def test_importances_lead_to_a_subset(data, models):
    _, _, names, made = data
    cells = learners.cell_importances(models[0], made)
    assert cells.count() == W * len(names)
    keep = learners.choose_features(models[0], made, 4)
    assert keep[:6] == list(learners.ALWAYS_KEEP) and "spot_id" not in keep
    small = learners.fit_boosted(made, names, keep, trees=2, depth=3)
    assert small.model.numFeatures == W * len(keep)
    assert small.predict(made.limit(3)).where("y_pred IS NULL").count() == 0


def test_recursive_forecast_equals_a_plain_loop(data):
    """A model on two window cells, followed step by step in Python."""
    _, frame, names, _ = data

    class Mixed:
        def predict(self, df, name):
            vol, hour = names.index("vol"), names.index("hour_sin")
            last, first = F.element_at("x", -1), F.element_at("x", 1)
            return df.withColumn(name, last[vol] * 0.7 - first[vol] * 0.3 + last[hour] * 9 - 20)

    k = 7
    got = forecast.recursive_forecast(Mixed(), forecast.last_windows(frame, names, W), names, k)
    seen = {(r.spot_num, r.step): (r.datetime, r.pred_vol) for r in got.collect()}
    assert len(seen) == 2 * k
    for spot, base in (("a", 40.0), ("b", 90.0)):
        n = 24 * 12
        hist = [(h, round(base + 20 * sin(2 * pi * h / 24), 3)) for h in range(n - W, n)]
        for step in range(1, k + 1):
            y = max(hist[-1][1] * 0.7 - hist[0][1] * 0.3 + sin(2 * pi * (hist[-1][0] % 24) / 24) * 9 - 20, 0.0)
            assert seen[spot, step][0] == at(n - 1 + step)
            assert seen[spot, step][1] == pytest.approx(y)
            hist = hist[1:] + [(hist[-1][0] + 1, y)]


def test_forecasts_are_never_negative_and_short_series_are_left_out(spark, data, models):
    _, frame, names, _ = data
    short = frame.where((F.col("spot_num") == "a") | (F.col("datetime") > at(24 * 12 - 4)))
    made = forecast.last_windows(short, names, W, carry=["spot_id"])
    out = forecast.recursive_forecast(models[1], made, names, 3, carry=["spot_id"])
    assert {r.spot_num for r in out.collect()} == {"a"}
    assert out.where("pred_vol < 0 OR pred_vol IS NULL").count() == 0
    spots = spark.createDataFrame([("a",), ("q",)], "spot_num string")
    top = forecast.busiest_spots(spots, out, 2).collect()
    assert [r.spot_num for r in top] == ["a", "q"] and top[1].pred_vol is None


def test_rolling_evaluation_recovers_the_baseline_error(data):
    panel, _, _, _ = data
    chosen = {"Last": lambda fold: learners.Persistence(fold.features, 1)}
    report = evaluation.rolling_evaluation(
        panel, chosen, W, n_folds=2, test_days=2, min_train_days=4, min_train=100, min_test=50).orderBy("fold").collect()
    assert [(r.fold, r.train_start, r.train_end, r.test_start) for r in report] == [
        (1, "2024-01-04", "2024-01-08", "2024-01-08"), (2, "2024-01-06", "2024-01-10", "2024-01-10")]
    vol = [round(40 + 20 * sin(2 * pi * h / 24), 3) for h in range(24 * 12)]
    want = [abs(vol[h] - vol[h - 1]) for h in range(24 * 7, 24 * 9)]
    assert report[0].MAE == pytest.approx(sum(want) / len(want), abs=1e-3)
    with pytest.raises(ValueError, match="no fold"):
        evaluation.rolling_evaluation(panel, chosen, W, n_folds=1, test_days=2, min_train_days=1)
    with pytest.raises(ValueError, match="no windows"):
        evaluation.rolling_evaluation(panel, chosen, 24 * 20)


def test_rolling_evaluation_with_both_learners(data):
    panel, _, _, _ = data
    chosen = {"Boosted": evaluation.boosted_learner(2, 3), "Linear": evaluation.linear_learner}
    report = evaluation.rolling_evaluation(
        panel, chosen, W, n_folds=1, test_days=2, min_train_days=5, min_train=100, min_test=50)
    assert {r.model for r in report.collect()} == {"Boosted", "Linear"}
    assert evaluation.rolling_summary(report).count() == 2


def test_backtest(data):
    panel, _, _, _ = data
    out = evaluation.backtest_predictions(
        panel, ["vol"], {"last": learners.Persistence(["vol"], 1), "day": learners.Persistence(["vol"], 3)},
        W, horizon=2, eval_days=1, stride=4)
    got = out.where("spot_num = 'a'").orderBy("t").collect()
    vol = [round(40 + 20 * sin(2 * pi * h / 24), 3) for h in range(24 * 12)]
    first = 24 * 12 - 1 - 24
    assert [(r.t, r.y_true, r.last, r.day) for r in got] == [
        (at(h), vol[h + 2], vol[h], vol[h - 2]) for h in range(first, 24 * 12 - 2, 4)]
    dense = evaluation.backtest_predictions(
        panel, ["vol"], {"last": learners.Persistence(["vol"], 1), "day": learners.Persistence(["vol"], 3)},
        W, horizon=2, eval_days=1, stride=4, spec=GRID)
    assert sorted(map(str, dense.collect())) == sorted(map(str, out.collect()))
    assert evaluation.backtest_summary(out, ["last", "day"], min_rows=6).count() == 4
    assert evaluation.backtest_summary(out, ["last", "day"]).count() == 0
