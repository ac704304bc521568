"""Every operator as a query on the given tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza import adapters
from cadenza.functions import arrays, dates, encode, geo, records, scaling, text
from cadenza.operators import clean, explore, features, fill, grid, joins, metrics, rank, scale, sets, split, windows
from cadenza.plans import baselines, dataset, evaluation, forecast, learners, selection, training, windowing
from cadenza.session import materialize, scratch_path
from cadenza.sources import payloads, tables
from cadenza.sources.windows import load_windows, save_windows
from cadenza.spec import DAILY, GRID, HOURLY
from cadenza.streaming import ingest

WINDOW = 24
# The sample covers 30 days, so folds and backtests are short here.
FOLDS = {"n_folds": 3, "test_days": 5, "min_train_days": 10}
LAGS = {"Naive_w1": 1, "Naive_w2": 2, "Naive (w24)": 24}
# The columns whose correlations are reported.
CORRELATED = [
    "vol", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "temp_c", "rain_mm", "humidity_pct",
]
SHORT_FEATURES = ["vol", "hour_sin", "hour_cos", "temp_c"]
INSIDE = GRID.but(group=("split",))
DAILY_GRID = DAILY.but(dense=True)


def rounded(df: DataFrame, places: int = 6, only: list[str] | None = None) -> DataFrame:
    """Doubles rounded, so that results compare across engines."""
    names = only if only is not None else [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]
    return df.withColumns({c: F.round(F.col(f"`{c}`"), places) for c in names})


def _hourly(spark, d):
    return grid.hourly_sum(adapters.readings(spark, d))


def _volumes(spark, d):
    """Gap-free panel without weather."""
    return grid.densify(_hourly(spark, d), aligned=True)


def _weather(spark, d):
    return fill.clean_weather(adapters.weather_raw(spark, d))


def _panel(spark, d):
    return dataset.build_panel(adapters.readings(spark, d), adapters.weather_raw(spark, d))


def _daily(spark, d):
    return grid.densify(adapters.daily(spark, d), DAILY, aligned=True)


def rounded_errors(df: DataFrame) -> DataFrame:
    """MAE and RMSE to 6 places; MAPE to 1, as zeros in the truth make it huge."""
    percents = [c for c in df.columns if c.startswith("MAPE")]
    return rounded(rounded(df, 6, [c for c in df.columns if c in ("MAE", "RMSE")]), 1, percents)


# -- readings to panel ------------------------------------------------------

def hourly_sum(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_hourly(spark, d))


def hourly_sum_strict(spark, d):
    return rounded(grid.hourly_sum(adapters.readings(spark, d), strict=True))


def densify_hourly(spark, d):
    return rounded(_volumes(spark, d))


def densify_daily(spark, d):
    return rounded(_daily(spark, d))


def extent_by_spot(spark, d):
    return grid.extents(_hourly(spark, d))


def history_with_spots(spark, d):
    history = adapters.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("unit"), F.col("l_suppkey").cast("string").alias("spot_num"),
        dates.date_text(F.col("l_shipdate"), "yyyyMMdd").alias("YMD"),
        F.col("l_linenumber").alias("HH"), F.col("l_quantity").alias("vol"))
    return joins.with_spot_attributes(history, adapters.spots(spark, d))


def weather_clean(spark, d):
    return rounded(_weather(spark, d))


def panel_with_weather(spark, d):
    return rounded(_panel(spark, d))


def panel_borrowed_weather(spark, d):
    """Backward fill across series: spots without any view borrow from the next spot."""
    e = adapters.table(spark, d, "events")
    volumes = _volumes(spark, d)
    own = e.where("event_type = 'purchase'").groupBy(
        dates.time_of(dates.tick_of(F.col("ts"), 3600), 3600).alias("datetime"),
        F.concat(F.lit("purchase-"), F.col("user_id") % 10).alias("spot_num"),
    ).agg(F.max("value").alias("temp_c"))
    joined = volumes.join(own, ["spot_num", "datetime"], "left")
    return rounded(fill.fill_panel_weather(joined, borrow_from_next=True))


# -- features ---------------------------------------------------------------

def time_features(spark, d):
    return rounded(features.time_features(_volumes(spark, d)))


def wind_features(spark, d):
    raw = clean.rename_known(adapters.weather_raw(spark, d), clean.WEATHER_NAMES)
    return rounded(features.wind_features(clean.keep_existing(
        raw.withColumn("humidity_pct", text.numeric(raw, "humidity_pct")), ["일시", "wind_dir_deg", "humidity_pct"]
    ).withColumnRenamed("일시", "hour_text")))


def delta_features(spark, d):
    panel = _panel(spark, d)
    names = features.weather_features(panel)
    made = features.add_differences(panel, names, GRID)
    return rounded(made.select("spot_num", "datetime", *features.difference_columns(names)))


def lag_features(spark, d):
    panel = _panel(spark, d)
    names = features.weather_features(panel)
    return rounded(features.add_lags(panel, names, GRID).select("spot_num", "datetime", *[f"{c}_lag1" for c in names]))


def spot_ids(spark, d):
    volumes = _volumes(spark, d)
    return features.add_series_id(volumes, features.series_ids(volumes)).groupBy("spot_num", "spot_id").agg(
        F.count(F.lit(1)).alias("n"))


def id_cardinality(spark, d):
    return features.id_cardinality(features.series_ids(_volumes(spark, d)))


# -- splits -----------------------------------------------------------------

def chrono_split(spark, d):
    return split.chronological_split(materialize(_volumes(spark, d), "panel")).select("spot_num", "datetime", "split")


def rolling_folds(spark, d):
    targets = materialize(windows.target_counts(_volumes(spark, d), WINDOW, spec=GRID), "targets")
    bounds = split.fold_table(targets, "target_time", **FOLDS)
    sizes = split.fold_sizes(split.assign_folds(targets, "target_time", **FOLDS), weight="n_windows")
    return bounds.join(sizes, "fold")


def backtest_origins(spark, d):
    return split.backtest_origins(_volumes(spark, d), WINDOW)


# -- windows and scalers ----------------------------------------------------

def _short_frame(spark, d):
    """Stored panel with calendar features, for queries that read it more than once."""
    return features.time_features(materialize(_panel(spark, d), "panel"))


def windows_long(spark, d):
    made = windows.sliding_windows(_short_frame(spark, d), SHORT_FEATURES, WINDOW)
    return rounded(windows.windows_long(made, SHORT_FEATURES, ["spot_num", "origin_time"]))


def window_targets(spark, d):
    made = windows.windows_with_time(_volumes(spark, d), ["vol"], WINDOW, horizon=2, stride=3)
    first = arrays.first_step(F.col("x"))
    return rounded(made.select("spot_num", "origin_time", "target_time", first[0].alias("first_vol"), "y"))


def window_flat(spark, d):
    """Flattened windows after a choice of features by name, one row per cell."""
    made = windows.sliding_windows(_short_frame(spark, d), SHORT_FEATURES, WINDOW)
    x = arrays.pick_features(F.col("x"), SHORT_FEATURES, ["temp_c", "vol", "unknown"])
    return rounded(made.select("spot_num", "origin_time", F.posexplode(arrays.flat(x)).alias("pos", "cell")))


def instant_window(spark, d):
    panel = materialize(_panel(spark, d), "panel")
    last = panel.agg(F.max("datetime")).scalar()
    instants = panel.select("spot_num").distinct().withColumn("end_time", last)
    names = ["vol", "hour_sin", "is_weekend", "temp_c", "wind_dir_sin", "spot_id"]
    return rounded(windows.window_ending_at(panel, instants, names, WINDOW))


def _train_counts(spark, d, **kw):
    parts = split.chronological_split(_short_frame(spark, d))
    return scale.with_window_counts(parts.where("split = 'train'"), WINDOW, spec=INSIDE, **kw)


def feature_scaler(spark, d):
    return rounded(scale.fit_feature_scaler(_train_counts(spark, d), [*SHORT_FEATURES, "rain_mm"]))


def feature_scaler_fold(spark, d):
    frame = _short_frame(spark, d)
    end = frame.agg(dates.start_of_day(F.max("datetime"))).scalar()
    counted = scale.with_window_counts(
        frame, WINDOW, target_from=dates.shift_time(end, days=-15), target_until=dates.shift_time(end, days=-5))
    names = [*SHORT_FEATURES, "rain_mm", "humidity_pct"]
    return rounded(scale.fit_feature_scaler(counted, names, scale.fold_log_features(names), folds=True))


def target_scaler(spark, d):
    return rounded(scale.fit_target_scaler(_train_counts(spark, d)))


def scaled_panel(spark, d):
    frame = _short_frame(spark, d)
    names = [*SHORT_FEATURES, "rain_mm"]
    scaler = scale.fit_feature_scaler(scale.with_window_counts(frame, WINDOW), names)
    return rounded(scale.scale_features(frame, scaler, names).select("spot_num", "datetime", *names))


def target_roundtrip(spark, d):
    volumes = materialize(_volumes(spark, d), "panel")
    state = scale.fit_target_scaler(scale.with_window_counts(volumes, WINDOW))
    mean, std = state.select("mean").scalar(), state.select("std").scalar()
    scaled = volumes.withColumn("scaled", scaling.transform_target(F.col("vol"), mean, std))
    back = scaled.withColumn("restored", scaling.inverse_target(F.col("scaled"), mean, std, "log1p+standardize"))
    return rounded(back)


def window_store(spark, d):
    """Window set written, read back and summarised."""
    panel = materialize(_panel(spark, d), "panel")
    path = scratch_path(spark, "windows")
    save_windows(windowing.make_windows(panel, WINDOW, spot_id=True), path)
    stored = load_windows(spark, path)
    clean.require_same_features(stored.features, features.feature_names(panel.columns, spot_id=True))
    parts = [df.withColumn("variant", F.lit(v)) for v, df in (("raw", stored.raw), ("scaled", stored.scaled))]
    cells = sets.stack(parts).groupBy("variant", "split").agg(
        F.count(F.lit(1)).alias("n_windows"), F.avg(F.element_at("y", 1)).alias("mean_y"),
        F.avg(F.element_at(F.element_at("x", -1), 1)).alias("mean_last_vol"))
    return rounded(cells)


# -- baselines, metrics, ranking --------------------------------------------

def _test(spark, d):
    return baselines.test_part(materialize(_volumes(spark, d), "panel"))


def naive_last(spark, d):
    return rounded(baselines.naive_forecast(_test(spark, d), 1, GRID))


def naive_season(spark, d):
    return rounded(baselines.naive_forecast(baselines.test_part(materialize(_daily(spark, d), "panel"), DAILY), 7, DAILY_GRID))


def _candidates(spark, d):
    return baselines.naive_forecasts(_test(spark, d), GRID, LAGS)


def _model_metrics(spark, d):
    return metrics.regression_metrics(_candidates(spark, d), ["model"])


def metrics_overall(spark, d):
    return rounded_errors(metrics.regression_metrics(baselines.naive_forecast(_test(spark, d), 1, GRID)))


def metrics_by_spot(spark, d):
    return rounded_errors(metrics.metrics_by_spot(_candidates(spark, d), ["spot_num", "model"]))


def metrics_mean(spark, d):
    return rounded_errors(metrics.mean_by_model(metrics.metrics_by_spot(_candidates(spark, d), ["spot_num", "model"])))


def model_comparison(spark, d):
    return rounded_errors(baselines.compare_models(_candidates(spark, d)))


def best_model(spark, d):
    return rounded_errors(rank.best_model(_model_metrics(spark, d)))


def selection_record(spark, d):
    record = selection.selection_record(_model_metrics(spark, d))
    return rounded_errors(record.select("final_model_name", "selected_by", "window", "horizon", "metrics.*"))


def model_tags(spark, d):
    return rounded_errors(_model_metrics(spark, d).select(
        "model", text.tag_number(F.col("model")).alias("window"), text.safe_name(F.col("model")).alias("safe"), "MAE"))


def model_filter(spark, d):
    return rounded_errors(clean.matching(_model_metrics(spark, d), "model", "w24|W24|w2$").select("model", "RMSE"))


def _importances(spark, d):
    """Importance of each window cell: absolute covariance with the target."""
    made = windows.windows_with_time(_short_frame(spark, d), SHORT_FEATURES, WINDOW)
    cells = made.select("y", F.posexplode(arrays.flat(F.col("x"))).alias("pos", "cell"))
    return cells.groupBy("pos").agg(F.abs(F.covar_pop("cell", "y")).alias("importance"))


def importance_by_feature(spark, d):
    return rounded(rank.importance_by_feature(_importances(spark, d), SHORT_FEATURES), 4)


def topk_features(spark, d):
    table = rank.importance_by_feature(_importances(spark, d), SHORT_FEATURES)
    return rank.top_features(table, 2, always=("vol", "is_weekend"), drop=("hour_cos",))


# -- exploration ------------------------------------------------------------

def overview(spark, d):
    return explore.overview(_volumes(spark, d))


def quality_summary(spark, d):
    return explore.quality_summary(clean.to_numbers(adapters.readings(spark, d), ["hh", "vol"]))


def histogram_50(spark, d):
    volumes = materialize(_volumes(spark, d).select("vol"), "volumes")  # the bounds and the counts both read it
    return rounded(explore.histogram(volumes, "vol", 50))


def corr_matrix(spark, d):
    return rounded(explore.correlation_matrix(_short_frame(spark, d), CORRELATED))


def mode_spot(spark, d):
    return explore.most_frequent(adapters.readings(spark, d), "spot_num")


def top50(spark, d):
    return rounded(rank.top_rows(_volumes(spark, d), "vol", 50, ["spot_num", "datetime"]))


def head50(spark, d):
    return rounded(rank.head(_volumes(spark, d), ["spot_num", "datetime"], 50))


def sorted_spots(spark, d):
    return rank.sorted_keys(adapters.readings(spark, d), "spot_num")


# -- forecasts and joins ----------------------------------------------------

def label_at_horizon(spark, d):
    return rounded(features.label_ahead(_volumes(spark, d), 3, GRID))


def forecast_join(spark, d):
    test = _test(spark, d)
    pair = [baselines.naive_forecast(test, k, GRID).withColumnRenamed("y_pred", "pred_vol") for k in (1, 24)]
    return rounded(joins.join_forecasts(*pair, ("last_value", "last_day"), ["spot_num", "datetime"]))


def spots_with_forecast(spark, d):
    last = grid.last_steps(_daily(spark, d), 1, DAILY).select("spot_num", F.col("vol").alias("pred_vol"))
    return rounded(joins.spots_with_forecast(adapters.spots(spark, d), last).select("spot_num", "spot_nm", "pred_vol"))


def idle_spots(spark, d):
    """Spots without a shipment in the last two days: a difference of key sets."""
    daily = adapters.daily(spark, d)
    newest = daily.agg(F.max("datetime")).scalar()
    active = daily.where(F.col("datetime") > dates.shift_time(newest, days=-2))
    return sets.without(adapters.spots(spark, d).select("spot_num"), active, ["spot_num"])


def union_readings(spark, d):
    """Hourly and daily rows stacked by name, counted per source."""
    hourly = _hourly(spark, d).withColumn("source", F.lit("hourly"))
    daily = adapters.daily(spark, d).withColumn("source", F.lit("daily"))
    return rounded(sets.stack([hourly, daily]).groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("vol").alias("vol")), 2)


def tm_to_lonlat(spark, d):
    return rounded(geo.add_lonlat(adapters.spots(spark, d)), 9, ["lon", "lat"])


# -- scalar functions -------------------------------------------------------

def date_functions(spark, d):
    e = adapters.table(spark, d, "events")
    day = dates.date_text(F.col("ts"), "yyyyMMdd")
    hour = text.zero_pad(F.col("event_id") % 27)
    return e.select(
        "event_id",
        dates.parse_compact_hour(text.join_text(day, hour)).alias("compact"),
        dates.parse_time(dates.date_text(F.col("ts"), "yyyy/MM/dd HH:mm")).alias("slashed"),
        dates.start_of_day(F.col("ts")).alias("day"),
        dates.shift_time(dates.start_of_day(F.col("ts")), hours=-5, days=2).alias("shifted"),
        dates.date_text(F.col("ts")).alias("day_text"),
        dates.tick_of(F.col("ts"), 3600).alias("tick"),
        dates.is_weekend(F.col("ts")).alias("weekend"),
        F.size(dates.day_series(F.col("ts"), F.to_date(F.lit("2024-02-15")))).alias("days_left"))


def value_functions(spark, d):
    e = adapters.table(spark, d, "events")
    centred = F.col("value") - 20
    sine, cosine = encode.bearing(F.col("event_id") * 7 - 900)
    padded = F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))
    return rounded(e.select(
        "event_id", scaling.clip_zero(centred).alias("clipped"), scaling.clipped_log(centred).alias("logged"),
        scaling.round_half_even(F.col("event_id") / 2).alias("half_even"),
        text.zero_pad(F.col("event_id") % 1000).alias("padded"), text.clean_text(padded).alias("trimmed"),
        sine.alias("bearing_sin"), cosine.alias("bearing_cos")))


def json_records(spark, d):
    e = adapters.table(spark, d, "events")
    seen = records.decode(F.col("props"), "k BIGINT")
    encoded = records.encode(seen["k"].alias("k"), F.col("event_type"))
    return e.select("event_id", records.decode(encoded, "k BIGINT, event_type STRING").alias("r")).select(
        "event_id", "r.k", "r.event_type")


# -- sources and sinks ------------------------------------------------------

def csv_encodings(spark, d):
    """Readings written in two encodings, read back by one scan that detects them."""
    raw = adapters.readings(spark, d).withColumn("spot_nm", F.concat(F.lit("성산로-"), "spot_num"))
    folder = scratch_path(spark, "csv")
    tables.allow_korean(spark)
    old = F.col("spot_num").startswith("error") | F.col("spot_num").startswith("view")
    raw.where(~old).write.option("header", True).option("encoding", "UTF-8").csv(f"{folder}/new")
    raw.where(old).write.option("header", True).option("encoding", "MS949").csv(f"{folder}/old")
    back = tables.read_history(spark, f"{folder}/*/*.csv")
    hourly = grid.hourly_sum(back.drop("source_file"))
    names = back.groupBy("spot_num").agg(
        F.max("spot_nm").alias("spot_nm"), F.min(F.col("source_file").endswith(".csv")).alias("has_source"))
    return rounded(hourly.groupBy("spot_num").agg(F.count(F.lit(1)).alias("n"), F.sum("vol").alias("vol")).join(
        names, "spot_num"), 4)


def csv_drift(spark, d):
    """Readings written under three headers in two encodings, read back by name."""
    raw = adapters.readings(spark, d).withColumn("spot_nm", F.concat(F.lit("성산로-"), "spot_num"))
    folder = scratch_path(spark, "csv")
    tables.allow_korean(spark)
    kind = F.substring_index("spot_num", "-", 1)
    for name, mine, columns, charset in (
        ("error", kind == "error", ["ymd", "spot_num", "spot_nm", "vol", "hh"], tables.KOREAN),
        ("view", kind == "view", ["vol", "hh", "ymd", "lane_num", "spot_num"], tables.UNICODE),
        ("rest", ~kind.isin("error", "view"), ["spot_num", "ymd", "hh", "lane_num", "io_type", "vol"], tables.UNICODE),
    ):
        raw.where(mine).select(*columns).write.option("header", True).option("encoding", charset).csv(f"{folder}/{name}")
    back = tables.read_history(spark, f"{folder}/*/*.csv")
    hourly = grid.hourly_sum(back.select("spot_num", "ymd", "hh", "vol"))
    seen = back.groupBy("spot_num").agg(
        F.count("lane_num").alias("n_lane"), F.count("io_type").alias("n_io"), F.max("spot_nm").alias("spot_nm"))
    return rounded(hourly.groupBy("spot_num").agg(F.count(F.lit(1)).alias("n"), F.sum("vol").alias("vol")).join(
        seen, "spot_num"), 4)


def panel_store(spark, d):
    path = scratch_path(spark, "panel")
    tables.write_panel(_volumes(spark, d), path)
    return rounded(clean.where_in(tables.read_panel(spark, path), "spot_num", ["click-1", "view-2", "none"]))


def metrics_files(spark, d):
    """Reports written as CSV and JSON, read back, and the best row chosen."""
    folder = scratch_path(spark, "reports")
    report = _model_metrics(spark, d)
    tables.write_report(report, f"{folder}/metrics_a")
    tables.write_records(rank.best_model(tables.read_metrics(spark, f"{folder}/*/*.csv")).drop("metrics_file"), f"{folder}/best")
    kept = tables.read_records(spark, f"{folder}/best", "model STRING, MAE DOUBLE, RMSE DOUBLE, MAPE DOUBLE")
    return rounded_errors(kept)


def _requests(spark, d):
    """Readings as stored responses: XML payloads per spot, day and hour.

    As at the service, no response has more than 1000 rows, however many a unit
    has: rows of one unit are parted by ranges of their (unique) event id.
    """
    raw = adapters.readings(spark, d, with_id=True).withColumn("page", F.floor(F.col("event_id") / 1000))
    cell = F.concat(
        F.lit("<row><lane_num> "), "lane_num", F.lit(" </lane_num><io_type>"), "io_type",
        F.lit("</io_type><vol>"), "vol", F.lit("</vol><unit>pcu</unit></row>"))
    responses = raw.groupBy("spot_num", "ymd", "hh", "page").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.sort_array(F.collect_list(cell)), "").alias("cells"))
    payload = F.concat(
        F.lit("<Readings><list_total_count>"), F.col("n").cast("string"),
        F.lit("</list_total_count><RESULT><CODE>INFO-000</CODE><MESSAGE>ok</MESSAGE></RESULT>"), "cells",
        F.lit("</Readings>"))
    return responses.select(
        "spot_num", "ymd", "hh", (F.col("page") * 1000 + 1).alias("start"), payload.alias("payload"))


def xml_rows(spark, d):
    rows = payloads.volume_rows(payloads.parse_payloads(_requests(spark, d)))
    return rows.select(
        "spot_num", "ymd", "hh", "lane_num", "io_type", "vol", F.element_at("extra", "unit").alias("unit"))


def pending_work(spark, d):
    raw = adapters.readings(spark, d)
    done = raw.select("spot_num", "ymd", text.zero_pad(F.col("hh")).alias("hh"))
    return ingest.pending_work(raw.select("spot_num"), "20240101", "20240130", "0-23", done)


def ingest_resume(spark, d):
    """Ingest in two runs, with a day delivered again as it was, one delivered wrong first, and broken responses.

    The corrected delivery counts, whatever came before it, and units of broken responses stay pending.
    """
    requests = _requests(spark, d)
    source, sink, state = (scratch_path(spark, name) for name in ("requests", "history", "progress"))
    first_half = F.col("ymd") <= "20240115"
    wrong = F.when(F.col("ymd") == "20240110", F.replace("payload", F.lit("<vol>"), F.lit("<vol>9"))).otherwise(F.col("payload"))
    requests.where(first_half).withColumn("payload", wrong).write.parquet(f"{source}/run=1")
    broken = requests.where("ymd = '20240120'").withColumn("payload", F.lit("<html>busy"))
    broken.write.parquet(f"{source}/run=2")
    ingest.ingest(spark, f"{source}/*", sink, state)
    requests.where(~first_half & (F.col("ymd") != "20240120")).write.parquet(f"{source}/run=3")
    requests.where(F.col("ymd").isin("20240110", "20240115")).write.parquet(f"{source}/run=4")
    ingest.ingest(spark, f"{source}/*", sink, state)
    rows, done = ingest.ingested_rows(spark, sink), ingest.completed_units(spark, sink)
    calls = requests.select(*ingest.UNIT).distinct().join(done.select(*ingest.UNIT).distinct(), ingest.UNIT, "left_anti")
    pending = calls.groupBy("spot_num").agg(F.count(F.lit(1)).alias("pending"))
    counts = rows.groupBy("spot_num").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("ymd", "hh").alias("hours_with_rows"),
        F.round(F.sum("vol"), 4).alias("total_vol"))
    return counts.join(pending, "spot_num", "left").fillna(0, ["pending"])


def ingest_progress(spark, d):
    """Calls and rows of one ingest."""
    source, sink, state = (scratch_path(spark, name) for name in ("requests", "history", "progress"))
    _requests(spark, d).write.parquet(source)
    ingest.ingest(spark, source, sink, state)
    return ingest.progress(ingest.completed_units(spark, sink))


def lag_gappy(spark, d):
    """Previous value by position on hourly sums as they are, with their gaps."""
    return rounded(features.add_lags(_hourly(spark, d), ["vol"])).select("spot_num", "datetime", "vol_lag1")


# -- learners ---------------------------------------------------------------

def _learning_data(spark, d):
    panel = materialize(_panel(spark, d), "panel")
    frame, names, inside = windowing.split_features(panel, GRID)
    frame = materialize(frame, "features")
    return frame, names, inside, windows.windows_with_time(frame, names, WINDOW, spec=inside, carry=["spot_id"])


def _scored_summary(predictions, name):
    return rounded(predictions.groupBy("spot_num").agg(
        F.count(F.lit(1)).alias("n"), *metrics.error_columns("y", name)), 4)


def gbt_score(spark, d):
    _, names, _, made = _learning_data(spark, d)
    fitted = learners.fit_boosted(made.where("split = 'train'"), names, trees=4, depth=4)
    return _scored_summary(fitted.predict(made.where("split = 'test'")), "y_pred")


def second_learner(spark, d):
    frame, names, inside, made = _learning_data(spark, d)
    counted = scale.with_window_counts(frame.where("split = 'train'"), WINDOW, spec=inside)
    fitted = learners.fit_linear(
        made.where("split = 'train'"), names, scale.fit_feature_scaler(counted, names), scale.fit_target_scaler(counted))
    return _scored_summary(fitted.predict(made.where("split = 'test'")), "y_pred")


def _stored(spark, fitted):
    """The learner as another session would read it."""
    path = scratch_path(spark, "model")
    learners.save_model(fitted, spark, path)
    return learners.load_model(spark, path)


def tree_probe(spark, d):
    """One tree with one split on one yes-or-no feature, saved and loaded: its forecasts are the means of both groups."""
    frame = materialize(features.time_features(_volumes(spark, d)), "features")
    made = windows.windows_with_time(frame, ["is_weekend"], 1, spec=GRID)
    model = _stored(spark, learners.fit_boosted(made, ["is_weekend"], trees=1, depth=1, row_share=1.0))
    weekend = F.element_at("x", 1)[0].cast("int").alias("is_weekend")
    return rounded(model.predict(made).groupBy(weekend).agg(
        F.count(F.lit(1)).alias("n"), F.min("y_pred").alias("lowest"), F.max("y_pred").alias("highest")))


def slope_probe(spark, d):
    """The linear learner without penalty on one lag, saved and loaded: least squares with one slope and a level per spot.

    The error on the scale of the fit is least there, so solvers agree on it to many digits.
    """
    volumes = _volumes(spark, d)
    frame = materialize(features.add_series_id(volumes, features.series_ids(volumes, GRID), GRID), "features")
    made = windows.windows_with_time(frame, ["vol"], 1, spec=GRID, carry=["spot_id"])
    counted = scale.with_window_counts(frame, 1, spec=GRID)
    fitted = learners.fit_linear(
        made, ["vol"], scale.fit_feature_scaler(counted, ["vol"]), scale.fit_target_scaler(counted), regularization=0.0)
    miss = scaling.clipped_log(F.col("y")) - scaling.clipped_log(F.col("y_pred"))
    return rounded(_stored(spark, fitted).predict(made).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(miss * miss)).alias("log_rmse")), 5)


def importance_subset(spark, d):
    """Boosted fit, its most important features, and a second fit on these alone."""
    frame, names, inside, made = _learning_data(spark, d)
    train, test = made.where("split = 'train'"), made.where("split = 'test'")
    keep = learners.choose_features(learners.fit_boosted(train, names, trees=3, depth=4), train, 8)
    counted = scale.with_window_counts(frame.where("split = 'train'"), WINDOW, spec=inside)
    fitted = learners.fit_linear(
        train, names, scale.fit_feature_scaler(counted, names), scale.fit_target_scaler(counted), keep=keep)
    return _scored_summary(fitted.predict(test), "y_pred")


def train_compare(spark, d):
    """Baselines, boosted trees and the second learner on one test part, best first."""
    panel = materialize(_panel(spark, d), "panel")
    return rounded(training.train_and_compare(panel, WINDOW, trees=3, depth=4, top_k=8, lags=LAGS, tag="_w24", spec=GRID), 4)


def _forecast(spark, d, k):
    panel = materialize(_panel(spark, d), "panel")
    frame, names = features.feature_frame(panel, ids=features.series_ids(panel))
    frame = materialize(frame, "features")
    made = windows.windows_with_time(frame, names, WINDOW, carry=["spot_id"])
    fitted = learners.fit_boosted(made, names, trees=3, depth=4)
    return forecast.recursive_forecast(fitted, forecast.last_windows(frame, names, WINDOW), names, k)


def recursive_forecast(spark, d):
    return rounded(_forecast(spark, d, 6), 4)


def busiest_spots(spark, d):
    stations = adapters.readings(spark, d).select("spot_num").distinct()
    return rounded(forecast.busiest_spots(stations, _forecast(spark, d, 3), 3), 4)


def rolling_eval(spark, d):
    chosen = {"Boosted": evaluation.boosted_learner(3, 4), "Linear": evaluation.linear_learner}
    return rounded(evaluation.rolling_evaluation(
        materialize(_panel(spark, d), "panel"), chosen, WINDOW, **FOLDS, spec=GRID), 4)


def rolling_naive(spark, d):
    """Rolling-origin errors of the two baselines, averaged over folds."""
    chosen = {f"Persist_{k}": lambda fold, k=k: learners.Persistence(fold.features, k) for k in (1, 24)}
    report = evaluation.rolling_evaluation(materialize(_volumes(spark, d), "panel"), chosen, WINDOW, **FOLDS, spec=GRID)
    means = evaluation.rolling_summary(report).withColumns({
        "fold": F.lit(0), **{c: F.lit("all") for c in ("train_start", "train_end", "test_start")}, "test_days": F.lit(15)})
    return rounded_errors(sets.stack([report, means]))


def backtest_naive(spark, d):
    panel = materialize(_volumes(spark, d), "panel")
    models = {f"y_{k}": learners.Persistence(["vol"], k) for k in (1, 24)}
    predictions = evaluation.backtest_predictions(panel, ["vol"], models, WINDOW, spec=GRID)
    return rounded_errors(evaluation.backtest_summary(predictions, list(models)))


def forecast_naive(spark, d):
    """Recursive forecast of every spot with the value one day earlier as the model."""
    frame, names = features.feature_frame(materialize(_volumes(spark, d), "panel"), weather=False)
    model = learners.Persistence(names, 24)
    return rounded(forecast.recursive_forecast(model, forecast.last_windows(frame, names, WINDOW), names, 6))


def busiest_naive(spark, d):
    stations = adapters.readings(spark, d).select("spot_num").distinct()
    return forecast.busiest_spots(stations, forecast_naive(spark, d), 5)


def backtest(spark, d):
    panel = materialize(_panel(spark, d), "panel")
    frame, names = features.feature_frame(panel, ids=features.series_ids(panel))
    frame = materialize(frame, "features")
    end = frame.agg(F.max("datetime")).scalar()
    early = F.col("target_time") < dates.shift_time(end, days=-6)
    train = windows.windows_with_time(frame, names, WINDOW, carry=["spot_id"]).where(early)
    counted = scale.with_window_counts(frame.where(F.col("datetime") < dates.shift_time(end, days=-6)), WINDOW)
    models = {
        "y_boosted": learners.fit_boosted(train, names, trees=3, depth=4),
        "y_linear": learners.fit_linear(
            train, names, scale.fit_feature_scaler(counted, names), scale.fit_target_scaler(counted)),
    }
    predictions = evaluation.backtest_predictions(frame, names, models, WINDOW, eval_days=5, stride=6)
    return rounded(evaluation.backtest_summary(predictions, list(models)), 4)


QUERIES = {f.__name__: f for f in (
    hourly_sum, hourly_sum_strict, densify_hourly, densify_daily, extent_by_spot, history_with_spots, weather_clean,
    panel_with_weather, panel_borrowed_weather, time_features, wind_features, delta_features, lag_features, spot_ids,
    id_cardinality, chrono_split, rolling_folds, backtest_origins, windows_long, window_targets, window_flat,
    instant_window, feature_scaler, feature_scaler_fold, target_scaler, scaled_panel, target_roundtrip, window_store,
    naive_last, naive_season, metrics_overall, metrics_by_spot, metrics_mean, model_comparison, best_model,
    selection_record, model_tags, model_filter, importance_by_feature, topk_features, overview, quality_summary,
    histogram_50, corr_matrix, mode_spot, top50, head50, sorted_spots, label_at_horizon, forecast_join,
    spots_with_forecast, idle_spots, union_readings, tm_to_lonlat, date_functions, value_functions, json_records,
    csv_encodings, csv_drift, panel_store, metrics_files, xml_rows, pending_work, ingest_resume, ingest_progress, lag_gappy, gbt_score, second_learner,
    tree_probe, slope_probe,
    importance_subset, train_compare, recursive_forecast, busiest_spots, rolling_eval, backtest,
    rolling_naive, backtest_naive, forecast_naive, busiest_naive,
)}
