from datetime import datetime
from math import cos, expm1, log1p, radians, sin

import pytest
from pyspark.sql import functions as F

from cadenza.functions import arrays, dates, encode, geo, records, scaling, text


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


@pytest.mark.parametrize("raw, want", [
    ("7", 7.0), (" 7.5 ", 7.5), ("-1", -1.0), ("1e3", 1000.0), ("x", None), ("", None), ("7d", None), ("NaN", None),
    (None, None)])
def test_text_to_number(spark, raw, want):
    assert one(spark, text.text_to_number(F.lit(raw).cast("string"))) == want


def test_numeric_drops_nan(spark):
    df = spark.createDataFrame([(float("nan"), 3), (2.0, 4)], "a double, b int")
    assert [tuple(r) for r in df.select(text.numeric(df, "a"), text.numeric(df, "b")).collect()] == [(None, 3.0), (2.0, 4.0)]


def test_zero_pad_never_truncates(spark):
    assert [one(spark, text.zero_pad(F.lit(v))) for v in ("7", "12", "123")] == ["07", "12", "123"]


@pytest.mark.parametrize("tag, want", [("XGB_w168_wx", 168), ("GRU_w24", 24), ("Naive", None)])
def test_tag_number(spark, tag, want):
    assert one(spark, text.tag_number(F.lit(tag))) == want


def test_safe_name(spark):
    assert one(spark, text.safe_name(F.lit("A b/c_d-9(x)"))) == "Abc_d-9x"


@pytest.mark.parametrize("raw, want", [
    ("2024010107", datetime(2024, 1, 1, 7)), ("2024010124", None), ("2024023007", None), ("202401-107", None),
    ("2024031002", datetime(2024, 3, 10, 2)), ("20240101 7", None)])
def test_parse_compact_hour(spark, raw, want):
    assert one(spark, dates.parse_compact_hour(F.lit(raw))) == want


def test_times_ignore_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = F.lit("2024-03-10 02:30:00").cast("timestamp_ntz")
        assert one(spark, dates.time_of(dates.tick_of(gap, 3600), 3600)) == datetime(2024, 3, 10, 2)
        assert one(spark, dates.start_of_day(gap)) == datetime(2024, 3, 10)
        assert one(spark, dates.parse_compact_hour(F.lit("2024031002"))) == datetime(2024, 3, 10, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_tick_before_1970(spark):
    early = F.lit("1969-12-31 23:30:00").cast("timestamp_ntz")
    assert one(spark, dates.tick_of(early, 3600)) == -1
    assert one(spark, dates.time_of(F.lit(-1), 3600)) == datetime(1969, 12, 31, 23)


@pytest.mark.parametrize("raw", ["2024-05-06 07:00", "2024/05/06 07:00:00", "2024.05.06 07:00", "2024050607"])
def test_parse_time(spark, raw):
    assert one(spark, dates.parse_time(F.lit(raw))) == datetime(2024, 5, 6, 7)


def test_parse_time_bad(spark):
    assert one(spark, dates.parse_time(F.lit("tomorrow"))) is None


def test_calendar(spark):
    made = encode.calendar_columns(F.lit("2024-01-06 06:00:00").cast("timestamp_ntz"))  # a Saturday
    row = spark.range(1).select(*[c.alias(n) for n, c in made.items()]).first()
    assert row.is_weekend == 1
    assert row.hour_sin == pytest.approx(1.0)
    assert row.dow_cos == pytest.approx(cos(2 * 3.141592653589793 * 5 / 7))
    assert row.month_sin == pytest.approx(sin(2 * 3.141592653589793 / 12))


@pytest.mark.parametrize("degrees", [0, 360, 400, -30])
def test_bearing(spark, degrees):
    sine, cosine = encode.bearing(F.lit(degrees))
    assert one(spark, sine) == pytest.approx(sin(radians(degrees)), abs=1e-12)
    assert one(spark, cosine) == pytest.approx(cos(radians(degrees)), abs=1e-12)


def test_scaling_roundtrip(spark):
    mean, std = F.lit(1.2), F.lit(0.7)
    scaled = scaling.transform_target(F.lit(12.0), mean, std)
    assert one(spark, scaled) == pytest.approx((log1p(12) - 1.2) / 0.7)
    assert one(spark, scaling.inverse_target(scaled, mean, std)) == pytest.approx(12.0)
    assert one(spark, scaling.inverse_target(F.lit(0.5), mean, std)) == pytest.approx(expm1(0.5 * 0.7 + 1.2))
    assert one(spark, scaling.inverse_target(F.lit(0.5), None, None, "none")) == 0.5
    with pytest.raises(ValueError):
        scaling.inverse_target(F.lit(0.5), None, None)


def test_clip_and_round(spark):
    assert one(spark, scaling.clip_zero(F.lit(-3.0))) == 0.0
    assert one(spark, scaling.clip_zero(F.lit(None).cast("double"))) is None
    assert one(spark, scaling.clipped_log(F.lit(-3.0))) == 0.0
    assert [one(spark, scaling.round_half_even(F.lit(v))) for v in (0.5, 1.5, 2.5)] == [0, 2, 2]


def test_arrays(spark):
    x = F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(4)))
    assert one(spark, arrays.flat(x)) == [1, 2, 3, 4]
    assert one(spark, arrays.first_step(x)) == [1, 2]
    assert one(spark, arrays.pick_features(x, ["a", "b"], ["b", "zz", "a"])) == [[2, 1], [4, 3]]
    assert one(spark, arrays.pick_features(x, ["a", "b"], [])) == [[1, 2], [3, 4]]
    assert one(spark, arrays.drop_feature(x, ["a", "b"], "a")) == [[2], [4]]


def test_json(spark):
    packed = records.encode(F.lit(5).alias("k"), F.lit("강").alias("t"))
    assert one(spark, packed) == '{"k":5,"t":"강"}'
    assert one(spark, records.decode(packed, "k INT, t STRING")).k == 5


def test_lonlat_of_known_points(spark):
    df = spark.createDataFrame([(195489.0, 452136.0), (200000.0, 500000.0)], "grs80tm_x double, grs80tm_y double")
    a, b = geo.add_lonlat(df).collect()
    assert a.lat == pytest.approx(37.569, abs=1e-3) and a.lon == pytest.approx(126.949, abs=1e-3)
    assert b.lat == pytest.approx(38.0, abs=1e-9) and b.lon == pytest.approx(127.0, abs=1e-9)
    shifted = geo.add_lonlat(df, 600000.0).first()
    assert shifted.lat == pytest.approx(36.668, abs=1e-3)


def test_lonlat_without_or_with_bad_coordinates(spark):
    assert geo.add_lonlat(spark.range(1)).columns == ["id"]
    bad = spark.createDataFrame([("x", "500000")], "tm_x string, tm_y string")
    assert geo.add_lonlat(bad).first().lon < 127
