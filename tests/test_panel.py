import random

import pytest
from panel_helpers import at
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.operators import clean, features, fill, grid, joins, segments, sets
from cadenza.plans.dataset import build_panel
from cadenza.spec import HOURLY

READINGS = "spot_num string, ymd string, hh string, lane_num string, io_type string, vol string"


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


@pytest.fixture
def readings(spark):
    return spark.createDataFrame([
        ("a", "20240101", "7", "1", "1", "10"), ("a", "20240101", "07", "2", "1", "5"),
        ("a", "20240101", "x", "1", "1", "3"), ("a", "20240101", "", "1", "1", "4"),
        ("a", "20240101", "24", "1", "1", "9"), ("a", "20240101", "-1", "1", "1", "9"),
        ("a", "20240230", "3", "1", "1", "9"), ("a", "20240101", "9", "1", "1", "x"),
        ("b", "20240101", "9", "1", "1", ""), ("b", "20240101", "9", "2", "1", "2"),
        ("b", "20240101", "1e30", "2", "1", "2"),
    ], READINGS)


def test_hourly_sum_keeps_bad_hours_at_midnight(readings):
    assert rows(grid.hourly_sum(readings), "spot_num", "datetime") == [
        ("a", at(0), 7.0), ("a", at(7), 15.0), ("a", at(9), 0.0), ("b", at(9), 2.0)]


def test_hourly_sum_strict(readings):
    assert rows(grid.hourly_sum(readings, strict=True), "spot_num", "datetime") == [
        ("a", at(7), 15.0), ("a", at(9), 0.0), ("b", at(9), 2.0)]


@pytest.mark.parametrize("segment", [2, 3, 4096])
def test_densify(spark, segment):
    df = spark.createDataFrame(
        [("a", at(0), 1.0), ("a", at(11), 2.0), ("b", at(3), 5.0), ("a", at(1.5), 9.0), ("c", at(4), None)],
        "spot_num string, datetime timestamp_ntz, vol double")
    got = rows(grid.densify(df, HOURLY.but(segment=segment)), "spot_num", "datetime")
    want = [("a", at(h), {0: 1.0, 11: 2.0}.get(h, 0.0)) for h in range(12)] + [("b", at(3), 5.0), ("c", at(4), 0.0)]
    assert got == want


def test_densify_refuses_or_resolves_duplicates(spark):
    df = spark.createDataFrame(
        [("a", at(0), 1.0, 1), ("a", at(0), 2.0, 2), ("a", at(2), 3.0, 1)],
        "spot_num string, datetime timestamp_ntz, vol double, line int")
    with pytest.raises(PySparkException):
        grid.densify(df).collect()
    got = grid.densify(df, columns=["vol"], latest_by="line")
    assert rows(got, "datetime") == [("a", at(0), 2.0), ("a", at(1), 0.0), ("a", at(2), 3.0)]


def test_densified_count_is_the_sum_of_extents(spark):
    rnd = random.Random(1)
    hours = {(s, rnd.randrange(500)) for s in "abc" for _ in range(40)}
    df = spark.createDataFrame([(s, at(h), 1.0) for s, h in hours], "spot_num string, datetime timestamp_ntz, vol double")
    want = sum(max(h for t, h in hours if t == s) - min(h for t, h in hours if t == s) + 1 for s in "abc")
    assert grid.densify(df, HOURLY.but(segment=37)).count() == want


@pytest.mark.parametrize("segment", [2, 5, 4096])
def test_fill_along(series, segment):
    df = series({"a": [None, 1, None, None, None, None, 4, None], "b": [None, None, None], "c": [None, 7, None]}, name="t")
    got = rows(fill.fill_along(df, ["t"], HOURLY.but(segment=segment)), "spot_num", "datetime")
    assert [r[2] for r in got] == [1, 1, 1, 1, 1, 1, 4, 4, None, None, None, 7, 7, 7]


def test_fill_borrows_from_the_next_spot(series):
    df = series({"a": [None], "b": [2, None], "c": [None, None], "d": [None], "e": [5], "f": [None]}, name="t")
    got = rows(fill.fill_along(df, ["t"], borrow_from_next=True), "spot_num", "datetime")
    assert [(r[0], r[2]) for r in got] == [
        ("a", 2), ("b", 2), ("b", 2), ("c", 5), ("c", 5), ("d", 5), ("e", 5), ("f", None)]


def test_fill_is_idempotent(series):
    df = series({"a": [None, 1, None, 3], "b": [2, None]}, name="t")
    once = fill.fill_along(df, ["t"])
    assert rows(fill.fill_along(once, ["t"]), "spot_num", "datetime") == rows(once, "spot_num", "datetime")


def test_clean_weather(spark):
    raw = spark.createDataFrame([
        ("2024-01-01 00:00", "", "1", "", "1"), ("2024-01-01 02:00", "5", "", "360", "2"), ("bad", "9", "9", "9", "3"),
        ("2024-01-01 03:00", "x", "", "90", "4"), ("2024-01-01 02:30", "7", "7", "7", "5"),
        ("2024-01-01 03:00", "6", "", "", "6"),
    ], ["일시", " 기온(°C)", "강수량(mm) ", "풍향(16방위)", "no"])
    typed = raw.withColumn("no", F.col("no").cast("int"))
    got = rows(fill.clean_weather(typed, latest_by="no"), "datetime")
    assert [(r[0], r[1], r[2], r[3]) for r in got] == [
        (at(0), 5.0, 1.0, 360.0), (at(1), 5.0, 0.0, 360.0), (at(2), 5.0, 0.0, 360.0), (at(3), 6.0, 0.0, 360.0)]
    assert got[2][4] == pytest.approx(0.0, abs=1e-12) and got[2][5] == pytest.approx(1.0)
    with pytest.raises(ValueError):
        fill.clean_weather(spark.range(1))


def test_build_panel(spark, readings):
    weather = spark.createDataFrame([("2024-01-01 08:00", "3"), ("2024-01-01 09:00", "")], ["일시", "기온(°C)"])
    for store in (True, False):
        panel = build_panel(readings, weather, store=store)
        assert panel.columns == ["spot_num", "datetime", "vol", "temp_c"]
        assert panel.count() == 11
        assert {r.temp_c for r in panel.collect()} == {3.0}


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("segment", [2, 3, 7])
def test_segments_match_whole_series_windows(series, dense, segment):
    rnd = random.Random(segment)
    df = series({s: [rnd.random() for _ in range(n)] for s, n in (("hot", 60), ("b", 1), ("c", 9))})
    spec = HOURLY.but(segment=segment, dense=dense)
    made = segments.over_segments(df, spec, lambda w: {
        "back": F.lag("vol", 3).over(w), "ahead": F.lead("vol", 2).over(w),
        "near": F.sum("vol").over(w.rowsBetween(-4, 1))}, before=4, after=2)
    w = Window.partitionBy("spot_num").orderBy("datetime")
    want = df.withColumns({
        "back": F.lag("vol", 3).over(w), "ahead": F.lead("vol", 2).over(w), "near": F.sum("vol").over(w.rowsBetween(-4, 1))})
    for a, b in zip(rows(made, "spot_num", "datetime"), rows(want, "spot_num", "datetime"), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5])


def test_positions_of_a_gappy_series(spark):
    df = spark.createDataFrame([("a", at(h), 1.0) for h in (0, 1, 5, 40, 41, 90)], "spot_num string, datetime timestamp_ntz, vol double")
    got = segments.with_ordinal(df, HOURLY.but(segment=4, dense=False))
    assert [r[segments.ORDINAL] for r in got.orderBy("datetime").collect()] == list(range(6))


def test_ordered_index(spark):
    names = [f"k{i:04d}" for i in random.Random(3).sample(range(5000), 700)]
    keys = spark.createDataFrame([(n,) for n in names], ["spot_num"])
    got = segments.ordered_index(keys.repartition(7), ["spot_num"], "i")
    assert [tuple(r) for r in got.orderBy("spot_num").collect()] == [(n, i) for i, n in enumerate(sorted(names))]


@pytest.mark.parametrize("segment", [2, 3, 4096])
def test_gaps_do_not_change_who_is_next(spark, segment):
    hours = [0, 4, 14, 15, 4095, 4105]
    df = spark.createDataFrame([("a", at(h), float(h)) for h in hours], "spot_num string, datetime timestamp_ntz, vol double")
    made = segments.over_segments(df, HOURLY.but(segment=segment), lambda w: {"back": F.lag("vol").over(w)}, before=1)
    assert [r.back for r in made.orderBy("datetime").collect()] == [None, *map(float, hours[:-1])]


def test_lookup_join(spark):
    left = spark.createDataFrame([("hot", i) for i in range(90)] + [("b", 1), ("none", 2)], "spot_num string, v int")
    right = spark.createDataFrame([("hot", "x"), ("b", "y"), ("zz", "z")], "spot_num string, nm string")
    for how in ("left", "inner", "left_semi"):
        got = joins.lookup_join(left, right, ["spot_num"], how)
        assert "UnresolvedHint" not in got._jdf.queryExecution().logical().toString()
        assert got.count() == (92 if how == "left" else 91)
    tagged = left.withColumn("extra", F.create_map(F.lit("a"), "v"))
    assert joins.lookup_join(tagged, right, ["spot_num"]).where("nm = 'x'").count() == 90


def test_history_with_spots_makes_a_time(spark):
    history = spark.createDataFrame([("a", 20240101, 7.0), ("q", 20240101, None)], "spot_num string, YMD int, HH double")
    spots = spark.createDataFrame([("a", "first"), ("a", "again")], "spot_num string, spot_nm string")
    got = joins.with_spot_attributes(history, spots)
    assert {(r.spot_num, r.spot_nm, r.datetime) for r in got.collect()} == {
        ("a", "first", at(7)), ("a", "again", at(7)), ("q", None, None)}


def test_cleaning(spark):
    df = spark.createDataFrame([("1", "x", 2.0), (None, "3", None)], "SPOT_NUM string, b string, c double")
    named = clean.rename_first(df, ["spot_num", "SPOT_NUM"], "spot_num")
    assert named.columns[0] == "spot_num"
    with pytest.raises(ValueError):
        clean.rename_first(df, ["nope"], "spot_num")
    assert clean.rename_first(df, ["nope"], "x", required=False).columns == df.columns
    assert [r.b for r in clean.to_numbers(df, ["b", "zz"]).collect()] == [None, 3.0]
    assert clean.keep_existing(df, ["c", "zz", "b"]).columns == ["c", "b"]
    assert clean.drop_missing(named, ["spot_num"]).count() == 1
    assert [r.c for r in clean.fill_constant(df, ["c", "zz"]).collect()] == [2.0, 0.0]
    aligned = clean.align_features(df, ["zz", "b"])
    assert [tuple(r) for r in df.select(*[c.alias(n) for n, c in aligned.items()]).collect()] == [(0.0, 0.0), (0.0, 3.0)]
    with pytest.raises(ValueError):
        clean.require_same_features(["a", "b"], ["b", "a"])


def test_standard_history(spark):
    df = spark.createDataFrame([("a", "20240101", "1", "2")], ["spotNo", "date", "hour", "traffic"])
    assert clean.standard_history(df).columns == ["spot_num", "ymd", "hh", "vol"]


def test_differences_and_lags(series):
    df = series({"a": [1, 4, None, 9], "b": [5]}, name="temp_c").withColumn("wind_dir_sin", F.lit(1.0))
    diffs = features.add_differences(df, ["temp_c", "wind_dir_sin"], HOURLY.but(segment=2))
    assert diffs.columns[-1] == "temp_c_diff1"
    assert [r.temp_c_diff1 for r in diffs.orderBy("spot_num", "datetime").collect()] == [0, 3, 0, 0, 0]
    lags = features.add_lags(df, ["temp_c"], HOURLY.but(segment=2))
    assert [r.temp_c_lag1 for r in lags.orderBy("spot_num", "datetime").collect()] == [0, 1, 4, 0, 0]


def test_feature_names():
    have = ["spot_num", "datetime", "vol", "temp_c", "wind_dir_deg", "wind_dir_sin", "wind_dir_cos"]
    assert features.feature_names(have, time=False) == ["vol", "temp_c", "wind_dir_sin", "wind_dir_cos", "temp_c_diff1"]
    assert features.feature_names(have, False, True, True, "lag") == [
        "vol", "temp_c", "wind_dir_sin", "wind_dir_cos", "temp_c_lag1", "wind_dir_sin_lag1", "wind_dir_cos_lag1", "spot_id"]
    assert len(features.feature_names(have, weather=False)) == 8


def test_feature_frame_gap_rules(series):
    df = series({"a": [1.0, 2.0, 3.0]}).withColumn("temp_c", F.when(F.hour("datetime") == 1, F.lit(5.0)))
    along, names = features.feature_frame(df, time=False)
    assert names == ["vol", "temp_c", "temp_c_diff1"]
    assert [r.temp_c for r in along.orderBy("datetime").collect()] == [5, 5, 5]
    zero, _ = features.feature_frame(df, time=False, change="lag", gaps="zero")
    assert [(r.temp_c, r.temp_c_lag1) for r in zero.orderBy("datetime").collect()] == [(0, 0), (5, 0), (0, 5)]


def test_series_ids(series):
    ids = features.series_ids(series({"b": [1], "a": [1], "c10": [1]}))
    assert rows(ids, "spot_num") == [("a", 0), ("b", 1), ("c10", 2)]
    assert features.id_cardinality(ids).first().n_ids == 3


def test_sets(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x")], "k int, s string")
    b = spark.createDataFrame([(2,)], "k int")
    assert sets.stack([a, b]).count() == 3
    assert sets.distinct_values(a, ["k"]).count() == 1
    assert sets.without(sets.stack([a, b]), a, ["k"]).count() == 1
