from math import sqrt

import pytest
from panel_helpers import at
from pyspark.sql import functions as F

from cadenza.operators import clean, explore, metrics, rank
from cadenza.plans import baselines, evaluation, selection


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.fixture
def guesses(spark):
    return frame(spark, [("m", 10.0, 8.0), ("m", 0.0, 1.0), ("m", -4.0, -4.0)], "model string, y_true double, y_pred double")


def test_regression_metrics(guesses):
    got = metrics.regression_metrics(guesses).first()
    assert got.MAE == pytest.approx(1.0)
    assert got.RMSE == pytest.approx(sqrt(5 / 3))
    assert got.MAPE == pytest.approx((0.2 + 1 / 1e-6) / 3 * 100)


def test_metrics_by_spot_use_the_signed_denominator(guesses):
    assert metrics.metrics_by_spot(guesses, ["model"]).count() == 0
    got = metrics.metrics_by_spot(guesses, ["model"], min_rows=3).first()
    assert got.n == 3 and got["MAPE(%)"] == pytest.approx((0.2 + 1e6 + 0) / 3 * 100)


@pytest.mark.parametrize("rows, kept", [(9, 0), (10, 1)])
def test_ten_rows_are_enough(spark, rows, kept):
    df = frame(spark, [("a", 1.0, 1.0)] * rows, "model string, y_true double, y_pred double")
    assert metrics.metrics_by_spot(df, ["model"]).count() == kept


# Published fold errors and their published means.
FOLDS = [
    (1, "XGB", 129.097, 213.929), (1, "GRU", 486.699, 791.985), (2, "XGB", 169.534, 365.242),
    (2, "GRU", 438.679, 748.368), (3, "XGB", 200.090, 381.644), (3, "GRU", 389.830, 660.971),
]
MEANS = {"XGB": (166.240, 320.272), "GRU": (438.403, 733.775)}


def test_published_summary_is_the_mean_of_its_folds(spark):
    report = frame(spark, FOLDS, "fold int, model string, MAE double, RMSE double")
    got = {r.model: (r.MAE, r.RMSE) for r in evaluation.rolling_summary(report).collect()}
    for model, want in MEANS.items():
        assert got[model] == pytest.approx(want, abs=1e-3)


REPORT = "model string, MAE double, RMSE double, MAPE double, metrics_file string"


def test_best_model_rules(spark):
    df = frame(spark, [
        ("a_w24", 3.0, 2.0, None, "f1"), ("b_w168", 9.0, 2.0, 5.0, "f2"), ("c", 1.0, 2.0, 5.0, "f3"),
        ("d", 0.0, None, 0.0, "f4"), ("e", 0.0, 7.0, 0.0, "f5")], REPORT)
    assert rank.best_model(df).first().model == "c"
    assert rank.best_model(df, "MAE").first().model == "d"
    assert rank.best_model(df.where("RMSE IS NULL")).count() == 0
    with pytest.raises(ValueError):
        rank.best_model(df.drop("MAPE"))
    assert [r.model for r in rank.ranked(df).collect()][-1] == "d"


def test_selection_record(spark):
    # Published hold-out errors.
    df = frame(spark, [("XGB_w24", 157.089, 326.307, 1.523e9, "run_a.csv"),
                       ("XGB_w168", 143.084, 266.377, 5.433e8, "run_b.csv"),
                       ("GRU_w24", 205.359, 377.941, 8.777e7, "run_a.csv")], REPORT)
    registry = frame(spark, [("XGB_w168", "models/x"), ("XGB_w168_sid", "models/y")], "model string, artifact_path string")
    got = selection.selection_record(df, registry=registry).first()
    assert (got.final_model_name, got.window, got.artifact_path) == ("XGB_w168", 168, "models/x")
    assert got.metrics.RMSE == 266.377 and got.source_metrics_file == "run_b.csv"


def test_importance_and_top_features(spark):
    cells = frame(spark, [(i, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 0.0, 6.0])], "pos int, importance double")
    table = rank.importance_by_feature(cells, ["a", "b", "c"])
    got = {r.feature: (r.importance, r.importance_pct) for r in table.collect()}
    assert got == {"a": (5.0, 31.25), "b": (2.0, 12.5), "c": (9.0, 56.25)}
    zero = rank.importance_by_feature(cells.withColumn("importance", F.lit(0.0)), ["a", "b"])
    assert {r.importance_pct for r in zero.collect()} == {0.0}

    def top(*args):
        return [r.feature for r in rank.top_features(table, *args).orderBy("position").collect()]

    assert top(2) == ["c", "a"]
    assert top(2, ("b", "zz", "a")) == ["b", "zz", "a", "c"]
    assert top(2, ("c",), ("c",)) == ["a", "b"]
    assert top(0, ("a",)) == []


def test_top_rows_and_keys(spark):
    df = frame(spark, [("a", 1.0), ("b", None), ("c", 5.0), ("a", 1.0)], "spot_num string, pred_vol double")
    assert [r.spot_num for r in rank.top_rows(df, "pred_vol", 4, ["spot_num"]).collect()] == ["c", "a", "a", "b"]
    assert [r.spot_num for r in rank.sorted_keys(df, "spot_num").collect()] == ["a", "b", "c"]
    assert rank.head(df, ["spot_num"], 2).count() == 2


def test_overview_and_quality(spark):
    df = frame(spark, [("a", at(0), 1.0), ("a", at(0), 1.0), ("b", at(5), None), ("a", at(0), 1.0)],
               "spot_num string, datetime timestamp_ntz, vol double")
    assert tuple(explore.overview(df).first()) == (4, at(0), at(5), 2)
    assert tuple(explore.quality_summary(df).first()) == (4, 1, 8.333, 2, 50.0)
    assert explore.quality_summary(df.where("false")).first().n_rows == 0


def test_histogram_edges(spark):
    df = frame(spark, [(0.0,), (1.0,), (9.99,), (10.0,), (None,), (5.0,)], "x double")
    got = {r.bin: (r.left_edge, r.n) for r in explore.histogram(df, "x", 10).collect()}
    assert {b: n for b, (_, n) in got.items() if n} == {0: 1, 1: 1, 5: 1, 9: 2}
    assert got[9][0] == pytest.approx(9.0) and len(got) == 10
    flat = explore.histogram(frame(spark, [(3.0,), (3.0,)], "x double"), "x", 4).collect()
    assert {r.bin: r.n for r in flat} == {0: 0, 1: 0, 2: 2, 3: 0}


def test_correlation(spark):
    df = frame(spark, [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (4.0, 8.5, 5.0)], "a double, b double, c double")
    got = {(r.column_a, r.column_b): r.correlation for r in explore.correlation_matrix(df, ["a", "b", "c", "zz"]).collect()}
    assert len(got) == 9 and got["a", "a"] == pytest.approx(1.0)
    assert got["a", "b"] == got["b", "a"] == pytest.approx(0.99960, abs=1e-4)
    assert got["a", "c"] is None and got["c", "c"] is None


def test_most_frequent_takes_the_smallest_of_a_tie(spark):
    df = frame(spark, [("b",), ("a",), ("b",), ("a",), ("c",)], "k string")
    assert tuple(explore.most_frequent(df, "k").first()) == ("a", 2)


def test_filters(spark):
    df = frame(spark, [("XGB_w24",), ("xgb",), ("GRU",)], "model string")
    assert clean.matching(df, "model", "XGB|xgb").count() == 2
    assert clean.where_equal(df, "model", "GRU").count() == 1
    assert clean.where_in(df, "model", ["GRU", "xgb", "q"]).count() == 2


def test_naive_baselines_do_not_depend_on_other_lags(series):
    df = series({"a": [float(i % 5) for i in range(30)], "b": [3.0] * 4})
    both = baselines.naive_forecasts(df, lags={"last": 1, "week": 5})
    assert both.where("model = 'last'").count() == 29 + 3
    assert both.where("model = 'week'").count() == 25
    ranked = baselines.compare_models(both).collect()
    assert ranked[0].model == "week" and ranked[0].RMSE == 0.0
    alone = baselines.naive_forecast(df, 5)
    assert alone.count() == 25
