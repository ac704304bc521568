"""Readings to one row per series and step, on a gap-free grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.dates import day_hour, on_grid, tick_of, time_of
from cadenza.functions.text import numeric
from cadenza.operators.joins import lookup_join
from cadenza.operators.segments import segment_of
from cadenza.spec import HOURLY, PanelSpec


def hourly_sum(readings: DataFrame, spec: PanelSpec = HOURLY, strict: bool = False) -> DataFrame:
    """Sum all lanes and directions of a spot to one value per hour.

    Default: an unreadable hour counts as hour 0 and an unreadable volume as 0.
    Strict: such hours are dropped and such volumes skipped. Rows without a
    valid time go before the shuffle; the sum is combined on the map side.
    """
    hour, amount = numeric(readings, "hh"), numeric(readings, spec.value)
    if not strict:
        hour, amount = F.coalesce(hour, F.lit(0.0)), F.coalesce(amount, F.lit(0.0))
    timed = readings.select(
        F.col(spec.key).cast("string").alias(spec.key),
        day_hour(F.col("ymd").cast("string"), hour.try_cast("int")).alias(spec.time),
        amount.alias(spec.value),
    ).where(F.col(spec.time).isNotNull())
    return timed.groupBy(spec.key, spec.time).agg(
        F.coalesce(F.sum(spec.value), F.lit(0.0)).alias(spec.value))


def extents(df: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    """First and last time of each series."""
    return df.groupBy(*spec.series).agg(
        F.min(spec.time).alias("first_time"), F.max(spec.time).alias("last_time"))


def densify(
    df: DataFrame,
    spec: PanelSpec = HOURLY,
    fill: float | None = 0.0,
    columns: list[str] | None = None,
    latest_by: str | None = None,
    aligned: bool = False,
) -> DataFrame:
    """One row per step between the first and last time of each series.

    Absent steps get ``fill`` in the value column and nulls elsewhere; rows off
    the grid vanish (``aligned`` says there are none). Two rows at one step are an error, unless ``latest_by``
    names a column: then the row with the greatest value there wins.

    Only observed rows are shuffled. Each one, and a marker at the start of
    each segment, is expanded up to its successor, so the grid itself never
    moves and no join with it is needed. The input is read twice (its ends,
    then its rows): store it first if it is costly to make.
    """
    values = columns or [c for c in df.columns if c not in [*spec.series, spec.time]]
    passed = [*values, latest_by] if latest_by and latest_by not in values else values
    rows = df if aligned else df.where(on_grid(F.col(spec.time), spec.step_seconds))
    observed = rows.select(
        *spec.series, tick_of(F.col(spec.time), spec.step_seconds).alias("_tick"), *passed)
    bounds = observed.groupBy(*spec.series).agg(F.min("_tick").alias("_lo"), F.max("_tick").alias("_hi"))
    size = spec.segment
    segments = F.sequence(segment_of(F.col("_lo"), size), segment_of(F.col("_hi"), size))
    first_of_segment = F.greatest(F.col("_lo"), F.col("_segment") * size)
    end_of_segment = F.least(F.col("_hi") + 1, (F.col("_segment") + 1) * size)
    markers = (
        bounds.select(*spec.series, "_lo", "_hi", F.explode(segments).alias("_segment"))
        .select(*spec.series, "_segment", first_of_segment.alias("_tick"),
                end_of_segment.alias("_until"), F.lit(False).alias("_seen"))
    )
    rows = observed.select(
        *spec.series, segment_of(F.col("_tick"), size).alias("_segment"), "_tick",
        F.lit(None).cast("bigint").alias("_until"), F.lit(True).alias("_seen"), *passed)
    order = ["_tick", "_seen"] + ([latest_by] if latest_by else [])
    window = Window.partitionBy(*spec.series, "_segment").orderBy(*order)
    following = F.lead("_tick").over(window)
    until = F.first("_until").over(window.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.unionByName(markers, allowMissingColumns=True).withColumns(
        {"_next": following, "_end": until})
    if latest_by is None:
        clash = F.col("_seen") & (F.col("_next") == F.col("_tick"))
        message = F.concat(F.lit("two rows for one step of series "), F.concat_ws("/", *spec.series))
        step_end = F.when(clash, F.raise_error(message).cast("bigint")).otherwise(
            F.coalesce("_next", "_end"))
    else:
        step_end = F.coalesce("_next", "_end")
    steps = F.when(step_end > F.col("_tick"), F.sequence(F.col("_tick"), step_end - 1))
    own = F.col("_seen") & (F.col("_step") == F.col("_tick"))

    def value_of(name: str):
        value = F.when(own, F.col(name))
        return F.coalesce(value, F.lit(fill)) if fill is not None and name == spec.value else value

    return placed.withColumn("_step", F.explode(steps)).select(
        *spec.series,
        time_of(F.col("_step"), spec.step_seconds).alias(spec.time),
        *[value_of(c).alias(c) for c in values],
    )


def steps_until(
    series: DataFrame,
    instants: DataFrame,
    window: int,
    columns: list[str],
    spec: PanelSpec = HOURLY,
) -> DataFrame:
    """The ``window`` steps ending at an instant, one row per step, for each series.

    ``instants`` has one row per series and ``end_time``. Steps without a row in
    ``series`` are kept with nulls (0 in the value column).
    """
    end = tick_of(F.col("end_time"), spec.step_seconds)
    grid = instants.select(
        *spec.series, "end_time", F.explode(F.sequence(end - (window - 1), end)).alias("_tick"))
    values = series.select(
        *spec.series, tick_of(F.col(spec.time), spec.step_seconds).alias("_tick"), *columns)
    joined = grid.join(values, [*spec.series, "_tick"], "left").withColumn(
        spec.time, time_of(F.col("_tick"), spec.step_seconds))
    if spec.value in columns:
        joined = joined.fillna(0.0, subset=[spec.value])
    return joined.drop("_tick")


def last_steps(df: DataFrame, window: int, spec: PanelSpec = HOURLY) -> DataFrame:
    """Rows within the last ``window`` steps of their series, with its end as ``end_time``."""
    ends = df.groupBy(*spec.series).agg(F.max(spec.time).alias("end_time"))
    age = tick_of(F.col("end_time"), spec.step_seconds) - tick_of(F.col(spec.time), spec.step_seconds)
    return lookup_join(df, ends, spec.series, "inner").where(age < window)
