"""Splits by time: one chronological cut, rolling folds, backtest origins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.dates import moment, shift_time, start_of_day, tick_of
from cadenza.operators.joins import lookup_join
from cadenza.operators.segments import ordered_index, segment_of
from cadenza.spec import HOURLY, PanelSpec


def _rows_before(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Per time: its rows, the rows before it, and the rows of all times."""
    counts = df.groupBy(spec.time).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "_block", segment_of(tick_of(F.col(spec.time), spec.step_seconds), spec.segment))
    blocks = counts.groupBy("_block").agg(F.sum("rows").alias("_block_rows"))
    before = (Window.unboundedPreceding, -1)
    whole = (Window.unboundedPreceding, Window.unboundedFollowing)
    along = Window.orderBy("_block")  # one row per block of times
    shifts = blocks.select(
        "_block", F.coalesce(F.sum("_block_rows").over(along.rowsBetween(*before)), F.lit(0)).alias("_shift"),
        F.sum("_block_rows").over(along.rowsBetween(*whole)).alias("total"))
    running = F.sum("rows").over(Window.partitionBy("_block").orderBy(spec.time).rowsBetween(*before))
    return counts.join(shifts, "_block").select(
        spec.time, "rows", (F.coalesce(running, F.lit(0)) + F.col("_shift")).alias("before"), "total")


def _key_at(df: DataFrame, time: datetime, skip: int, spec: PanelSpec):
    """The key with ``skip`` smaller keys among the rows of one time."""
    keys = df.where(F.col(spec.time) == moment(time)).select(spec.key)
    return ordered_index(keys, [spec.key], "_rank").where(F.col("_rank") == skip).first()[spec.key]


def chronological_split(
    df: DataFrame, spec: PanelSpec = HOURLY, train: float = 0.7, val: float = 0.15, name: str = "split",
) -> DataFrame:
    """Label rows "train", "val" or "test" by their place in (time, key) order.

    The first ``int(n * train)`` rows train, those up to ``int(n * (train + val))``
    validate. No global sort: rows are counted per time (running counts per
    block of times, plus one row per block), and only the keys of the two times
    that hold a cut are ranked. These two (time, key) pairs are all the driver
    learns; the label itself is a comparison with constants.
    """
    ratios = [train, train + val]
    places = _rows_before(df, spec)
    hit = [(F.col("before") <= F.floor(F.col("total") * F.lit(q)))
           & (F.floor(F.col("total") * F.lit(q)) < F.col("before") + F.col("rows")) for q in ratios]
    found = places.where(hit[0] | hit[1]).collect()  # at most two rows

    def comes_before(ratio: float) -> Column:
        for row in found:
            skip = int(row["total"] * ratio) - row["before"]
            if 0 <= skip < row["rows"]:
                time = moment(row[spec.time])
                key = F.lit(_key_at(df, row[spec.time], skip, spec))
                return (F.col(spec.time) < time) | ((F.col(spec.time) == time) & (F.col(spec.key) < key))
        return F.lit(True)

    return df.withColumn(name, F.when(comes_before(ratios[0]), "train")
                         .when(comes_before(ratios[1]), "val").otherwise("test"))


def fold_table(
    targets: DataFrame, time: str, n_folds: int, test_days: int, min_train_days: int, expanding: bool = False,
) -> DataFrame:
    """Bounds of rolling-origin folds, counted back from the last target's midnight.

    Training covers the ``min_train_days`` before each test block, or everything
    before it if ``expanding``. All ranges are half open.
    """
    last = targets.agg(start_of_day(F.max(time)).alias("_end"), F.min(time).alias("_begin"))
    fold = F.explode(F.sequence(F.lit(1), F.lit(n_folds))).alias("fold")
    back = (F.col("fold") - (n_folds + 1)) * test_days
    zero = F.lit(0)
    start = F.col("_end") + F.make_dt_interval(back)
    train_start = (F.least(F.col("_begin"), start) if expanding
                   else start - F.make_dt_interval(F.lit(min_train_days), zero, zero, zero))
    return last.select("_end", "_begin", fold).select(
        "fold", train_start.alias("train_start"), start.alias("train_end"),
        start.alias("test_start"), shift_time(start, days=test_days).alias("test_end"))


def assign_folds(
    targets: DataFrame, time: str, n_folds: int, test_days: int, min_train_days: int, expanding: bool = False,
) -> DataFrame:
    """Each row once per fold it belongs to, with ``fold`` and its ``role`` in it.

    The bounds follow from one scalar, the last target time, so membership is an
    expression on each row and needs no join.
    """
    dated = targets.withColumn("_end", targets.agg(start_of_day(F.max(time))).scalar())
    end, t = F.col("_end"), F.col(time)
    placed = []
    for fold in range(1, n_folds + 1):
        start = shift_time(end, days=(fold - n_folds - 1) * test_days)
        trains = t < start
        if not expanding:
            trains = trains & (t >= shift_time(start, days=-min_train_days))
        tests = (t >= start) & (t < shift_time(start, days=test_days))
        role = F.when(trains, "train").when(tests, "test")
        placed.append(F.struct(F.lit(fold).alias("fold"), role.alias("role")))
    used = F.filter(F.array(*placed), lambda p: p["role"].isNotNull())
    return dated.withColumn("_place", F.explode(used)).select(
        *targets.columns, F.col("_place.fold").alias("fold"), F.col("_place.role").alias("role"))


def fold_sizes(assigned: DataFrame, min_train: int = 1000, min_test: int = 200, weight: str | None = None) -> DataFrame:
    """Rows per fold and role, and whether the fold is large enough to be used.

    ``weight`` names a column of counts where rows stand for several, such as targets counted by time.
    """
    each = F.col(weight) if weight else F.lit(1)
    rows = {role: F.sum(F.when(F.col("role") == role, each).otherwise(0)).alias(f"n_{role}") for role in ("train", "test")}
    sizes = assigned.groupBy("fold").agg(rows["train"], rows["test"])
    return sizes.withColumn("used", (F.col("n_train") >= min_train) & (F.col("n_test") >= min_test))


def long_enough(df: DataFrame, rows: int, spec: PanelSpec = HOURLY) -> DataFrame:
    """Rows of the series which have at least ``rows`` rows."""
    sizes = df.groupBy(*spec.series).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= rows)
    return lookup_join(df, sizes.select(*spec.series), spec.series, "left_semi")


def origin_bounds(
    df: DataFrame, window: int, horizon: int, eval_days: int, spec: PanelSpec = HOURLY,
) -> DataFrame:
    """First and last forecast origin of each series with at least ``window + 24`` rows."""
    step = spec.step_seconds
    bounds = df.groupBy(*spec.series).agg(
        F.min(spec.time).alias("_lo"), F.max(spec.time).alias("_hi"), F.count(F.lit(1)).alias("_rows"))
    return bounds.where(F.col("_rows") >= window + 24).select(
        *spec.series,
        F.greatest(shift_time(F.col("_hi"), days=-eval_days),
                   shift_time(F.col("_lo"), seconds=(window + 1) * step)).alias("first_origin"),
        shift_time(F.col("_hi"), seconds=-horizon * step).alias("last_origin"))


def backtest_origins(
    df: DataFrame, window: int, horizon: int = 1, eval_days: int = 30, stride: int = 1, spec: PanelSpec = HOURLY,
) -> DataFrame:
    """Forecast origins of each series, every ``stride`` steps over its last ``eval_days``."""
    bounds = origin_bounds(df, window, horizon, eval_days, spec).where(F.col("first_origin") <= F.col("last_origin"))
    zero = F.lit(0)
    step = F.make_dt_interval(zero, zero, zero, F.lit(stride * spec.step_seconds))
    return bounds.select(
        *spec.series, F.explode(F.sequence("first_origin", "last_origin", step)).alias("origin_time"))
