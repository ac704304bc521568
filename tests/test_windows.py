import random
from math import log1p, sqrt

import pytest
from panel_helpers import at
from pyspark.sql import functions as F

from cadenza.operators import features, scale, split, windows
from cadenza.plans import windowing
from cadenza.sources.windows import load_windows, save_windows
from cadenza.spec import GRID, HOURLY


def values(n, seed=0):
    rnd = random.Random(seed)
    return [round(rnd.uniform(-2, 30), 2) for _ in range(n)]


def brute_windows(vs, w, h, s):
    return [(i, vs[i:i + w], vs[i + w:i + w + h]) for i in range(0, len(vs) - w - h + 1, s)]


@pytest.mark.parametrize("w, h, s, segment", [(4, 1, 1, 5), (4, 2, 3, 4), (3, 1, 4, 4096), (5, 3, 2, 3)])
def test_sliding_windows(series, w, h, s, segment):
    data = {"a": values(23), "b": values(w + h - 1), "c": values(w + h), "d": [1.0]}
    df = series(data, start={"c": 7})
    got = windows.sliding_windows(df, ["vol"], w, h, s, HOURLY.but(segment=segment))
    seen = sorted((r.spot_num, r.origin_time, r.target_time, [x[0] for x in r.x], r.y) for r in got.collect())
    want = []
    for spot, vs in data.items():
        first = 7 if spot == "c" else 0
        for i, x, y in brute_windows(vs, w, h, s):
            want.append((spot, at(first + i + w - 1), at(first + i + w + h - 1), x, y))
    assert seen == sorted(want)


def test_windows_by_position_on_a_gappy_series(spark):
    hours = [0, 1, 5, 6, 9, 20]
    df = spark.createDataFrame([("a", at(h), float(h)) for h in hours], "spot_num string, datetime timestamp_ntz, vol double")
    got = windows.windows_with_time(df, ["vol"], 3, 1, 1, HOURLY.but(segment=4, dense=False)).orderBy("origin_time").collect()
    assert [([x[0] for x in r.x], r.y, r.target_time) for r in got] == [
        ([0, 1, 5], 6, at(6)), ([1, 5, 6], 9, at(9)), ([5, 6, 9], 20, at(20))]


def test_window_ending_at(series, spark):
    df = series({"a": values(6)}).withColumn("temp_c", F.lit(4.0))
    ends = spark.createDataFrame([("a", at(7))], "spot_num string, end_time timestamp_ntz")
    steps = windows.window_ending_at(df, ends, ["temp_c", "vol", "spot_id", "is_weekend"], 4)
    made = windows.collect_windows(steps, ["temp_c", "vol", "spot_id", "is_weekend"]).first()
    v = values(6)
    assert made.x == [[4, v[4], 0, 0], [4, v[5], 0, 0], [0, 0, 0, 0], [0, 0, 0, 0]]


@pytest.mark.parametrize("w, h, s", [(4, 1, 1), (3, 2, 3), (5, 1, 4)])
@pytest.mark.parametrize("segment", [4, 4096])
def test_scalers_equal_explicit_windows(series, w, h, s, segment):
    data = {"a": values(30), "b": values(w + h - 1, 2), "c": values(w + h + 3, 3)}
    df = series(data).withColumn("spot_id", F.lit(3)).withColumn("flat", F.lit(2.0))
    counted = scale.with_window_counts(df, w, h, s, HOURLY.but(segment=segment))
    got = {r.feature: r for r in scale.fit_feature_scaler(counted, ["vol", "flat", "spot_id"]).collect()}
    made = [b for vs in data.values() for b in brute_windows(vs, w, h, s)]
    cells = [log1p(max(v, 0)) for _, x, _ in made for v in x]
    mean = sum(cells) / len(cells)
    assert got["vol"]["mean"] == pytest.approx(mean)
    assert got["vol"]["std"] == pytest.approx(sqrt(sum((c - mean) ** 2 for c in cells) / len(cells)))
    assert got["vol"].log1p == 1 and got["flat"].log1p == 0
    assert got["flat"]["std"] == pytest.approx(1e-4)
    assert (got["spot_id"]["mean"], got["spot_id"]["std"]) == (0.0, 1.0)
    goals = [log1p(max(v, 0)) for _, _, y in made for v in y]
    target = scale.fit_target_scaler(counted).first()
    assert target["mean"] == pytest.approx(sum(goals) / len(goals))


def test_fold_scaler_counts_windows_by_target_time(series):
    data = {"a": values(40), "b": values(12, 5)}
    w, h, s = 4, 2, 3
    counted = scale.with_window_counts(
        series(data), w, h, s, HOURLY, F.lit(at(9)), F.lit(at(25)))
    made = [b for vs in data.values() for b in brute_windows(vs, w, h, s) if 9 <= b[0] + w + h - 1 < 25]
    cells = [log1p(max(v, 0)) for _, x, _ in made for v in x]
    assert counted.agg(F.sum("n_inputs")).first()[0] == len(cells)
    assert counted.agg(F.sum("n_targets")).first()[0] == len(made) * h
    got = scale.fit_feature_scaler(counted, ["vol"], folds=True).first()
    assert got["mean"] == pytest.approx(sum(cells) / len(cells))
    flat = scale.fit_feature_scaler(counted.withColumn("flat", F.lit(1.0)), ["flat"], folds=True).first()
    assert flat["std"] == 1.0


def test_scaler_without_windows_is_missing(series):
    counted = scale.with_window_counts(series({"a": [1.0, 2.0]}), 4)
    assert counted.agg(F.sum("n_inputs")).first()[0] == 0
    assert scale.fit_feature_scaler(counted, ["vol"]).first()["mean"] is None


def test_scale_features(series):
    df = series({"a": values(20)})
    scaler = scale.fit_feature_scaler(scale.with_window_counts(df, 4), ["vol"])
    state = scaler.first()
    got = [r.vol for r in scale.scale_features(df, scaler, ["vol"]).orderBy("datetime").collect()]
    want = [(log1p(max(v, 0)) - state["mean"]) / (state["std"] + 1e-8) for v in values(20)]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("segment", [3, 4096])
def test_chronological_split_is_exact(series, segment):
    data = {f"s{i}": values(n, i) for i, n in enumerate((13, 7, 40, 1, 22, 22))}
    df = series(data, start={"s1": 5, "s4": 18})
    got = split.chronological_split(df, HOURLY.but(segment=segment)).collect()
    order = sorted((r.datetime, r.spot_num) for r in got)
    n = len(order)
    place = {k: i for i, k in enumerate(order)}
    for r in got:
        i = place[(r.datetime, r.spot_num)]
        want = "train" if i < int(n * 0.7) else "val" if i < int(n * (0.7 + 0.15)) else "test"
        assert r.split == want


def test_split_without_a_test_part(series):
    got = split.chronological_split(series({"a": [1, 2, 3, 4]}), train=0.5, val=0.5).orderBy("datetime").collect()
    assert [r.split for r in got] == ["train", "train", "val", "val"]


def test_folds(spark):
    targets = spark.createDataFrame([(at(h),) for h in range(0, 24 * 30, 6)], "t timestamp_ntz")
    folds = split.fold_table(targets, "t", 3, 5, 10).orderBy("fold").collect()
    assert [(r.train_start, r.test_start, r.test_end) for r in folds] == [
        (at(24 * (d - 10)), at(24 * d), at(24 * (d + 5))) for d in (14, 19, 24)]
    placed = split.assign_folds(targets, "t", 3, 5, 10)
    sizes = {r.fold: (r.n_train, r.n_test, r.used) for r in split.fold_sizes(placed, 40, 20).collect()}
    assert sizes == {1: (40, 20, True), 2: (40, 20, True), 3: (40, 20, True)}
    assert not any(r.used for r in split.fold_sizes(placed, 41, 20).collect())
    wide = split.fold_sizes(split.assign_folds(targets, "t", 3, 5, 10, expanding=True), 0, 0)
    assert sorted(r.n_train for r in wide.collect()) == [56, 76, 96]


def test_origins(series):
    df = series({"a": values(60), "short": values(27)})
    got = split.backtest_origins(df, 4, 1, eval_days=1, stride=5).orderBy("origin_time").collect()
    assert [r.origin_time for r in got] == [at(h) for h in range(35, 59, 5)]
    early = split.backtest_origins(df, 4, 2, eval_days=30, stride=20).orderBy("origin_time").collect()
    assert [r.origin_time for r in early] == [at(5), at(25), at(45)]


def test_labels_and_previous_values(series):
    df = series({"a": [1, 2, 3, 4]})
    spec = HOURLY.but(segment=2)
    assert [(r.vol, r.y_true) for r in features.label_ahead(df, 2, spec).orderBy("datetime").collect()] == [(1, 3), (2, 4)]
    assert [(r.vol, r.y_pred) for r in features.previous_value(df, 3, spec).collect()] == [(4, 1)]


def test_window_set_roundtrip(series, spark, folder):
    df = series({"a": values(60), "b": values(60, 9)}).withColumn("temp_c", F.col("vol") / 2)
    made = windowing.make_windows(df, 5)
    save_windows(made, folder)
    back = load_windows(spark, folder)
    assert back.features == made.features and (back.window, back.horizon) == (5, 1)
    sizes = {r.split: r["count"] for r in back.raw.groupBy("split").count().collect()}
    # 84 / 18 / 18 rows over two spots; each spot loses 5 rows per split
    assert sizes == {"train": 74, "val": 8, "test": 8}
    assert back.scaled.count() == back.raw.count()
    state = {r.feature: r for r in back.scaler.collect()}
    goal = back.target.first()
    key = ["split", "spot_num", "origin_time"]
    both = back.raw.select(*key, "x", "y").join(back.scaled.select(*key, F.col("x").alias("sx"), F.col("y").alias("sy")), key)
    row = both.where("split = 'test'").first()
    i = made.features.index("temp_c")
    want = (row.x[2][i] - state["temp_c"]["mean"]) / (state["temp_c"]["std"] + 1e-8)
    assert row.sx[2][i] == pytest.approx(want)
    assert row.sy[0] == pytest.approx((log1p(max(row.y[0], 0)) - goal["mean"]) / goal["std"])


def test_look_back_keeps_changes_across_a_cut(series):
    df = series({"a": [float(i) for i in range(20)]}).withColumn("temp_c", F.col("vol"))
    restart, _, _ = windowing.split_features(df, spot_id=False)
    through, _, _ = windowing.split_features(df, spot_id=False, look_back=True)
    assert [r.temp_c_diff1 for r in restart.orderBy("datetime").collect()].count(0.0) == 3
    assert [r.temp_c_diff1 for r in through.orderBy("datetime").collect()].count(0.0) == 1


@pytest.mark.parametrize("stride,horizon,segment", [(2, 1, 7), (3, 2, 4), (5, 1, 5), (9, 3, 4), (24, 1, 4096), (3, 1, 2)])
def test_strided_windows_are_the_starts_of_all_windows(series, stride, horizon, segment):
    df = series({"a": list(range(40)), "b": [5, 6, 7, 8, 9, 1, 2], "c": [1, 2]}, {"a": 3})
    spec = HOURLY.but(segment=segment)
    got = windows.sliding_windows(df, ["vol"], 4, horizon, stride, spec, carry=["vol"])
    for dense in (spec, spec.but(dense=True)):
        again = windows.sliding_windows(df, ["vol"], 4, horizon, stride, dense, carry=["vol"])
        assert sorted(map(str, again.collect())) == sorted(map(str, got.collect()))
    every = windows.sliding_windows(df, ["vol"], 4, horizon, 1, spec, carry=["vol"]).collect()
    starts = {"a": at(3), "b": at(0), "c": at(0)}
    want = [r for r in every if (r.origin_time - starts[r.spot_num]).total_seconds() / 3600 % stride == 3 % stride]
    assert sorted(map(str, got.collect())) == sorted(map(str, want)) and want


def test_strided_windows_cost_what_they_hold(spark, series):
    """A stride of s handles 1/s of the rows of windows, behind one exchange of the rows themselves."""
    df = series({"a": list(range(480))})
    made = windows.sliding_windows(df, ["vol"], 24, 1, 24, GRID)
    assert made.count() == 19
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert not [line for line in plan.splitlines() if "Exchange" in line and "_start" in line]
    assert not [line for line in plan.splitlines() if "Exchange" in line and "_steps" in line]
