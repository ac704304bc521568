"""Filling of missing values along a series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.dates import tick_of
from cadenza.functions.encode import bearing
from cadenza.functions.dates import parse_time
from cadenza.operators import clean
from cadenza.operators.grid import densify
from cadenza.operators.segments import SEGMENT, segment_of
from cadenza.spec import HOURLY, PanelSpec


def fill_along(
    df: DataFrame,
    columns: list[str],
    spec: PanelSpec = HOURLY,
    backward: bool = True,
    borrow_from_next: bool = False,
) -> DataFrame:
    """Last known value at or before each row; leading gaps take the first known value.

    Each segment is filled on its own, with the last value of the earlier
    segments carried in from a table of one row per segment. After the forward
    fill only leading gaps are left, and these all take the series' first value.

    ``borrow_from_next`` also fills a series without any value from the series
    after it in key order, as an ungrouped backward fill would.
    """
    if not columns:
        return df
    tick = tick_of(F.col(spec.time), spec.step_seconds)
    placed = df.withColumn("_tick", tick).withColumn(SEGMENT, segment_of(F.col("_tick"), spec.segment))
    keys = [*spec.series, SEGMENT]

    def known(c):
        return F.when(F.col(c).isNotNull(), F.col("_tick"))

    edges = placed.groupBy(*keys).agg(
        *[F.max_by(c, known(c)).alias(f"_last_{c}") for c in columns],
        *[F.min_by(c, known(c)).alias(f"_first_{c}") for c in columns],
    )
    along = Window.partitionBy(*spec.series).orderBy(SEGMENT)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carried = edges.select(
        *keys,
        *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns],
        *[F.first(f"_first_{c}", ignorenulls=True).over(whole).alias(f"_start_{c}") for c in columns],
    )
    if backward and borrow_from_next:
        starts = carried.groupBy(*spec.series).agg(
            *[F.max(f"_start_{c}").alias(f"_start_{c}") for c in columns])
        carried = carried.drop(*[f"_start_{c}" for c in columns]).join(
            _borrow(starts, columns, spec), spec.series, "left")
    within = Window.partitionBy(*keys).orderBy("_tick").rowsBetween(Window.unboundedPreceding, 0)
    joined = placed.join(carried, keys, "left")
    filled = {}
    for c in columns:
        options = [F.last(c, ignorenulls=True).over(within), F.col(f"_carry_{c}")]
        if backward:
            options.append(F.col(f"_start_{c}"))
        filled[c] = F.coalesce(*options)
    return joined.withColumns(filled).select(*df.columns)


def _borrow(starts: DataFrame, columns: list[str], spec: PanelSpec) -> DataFrame:
    """For series without any value, the first value of the next series that has one.

    Works on one row per series. Only the keys which lack a value look for a
    successor: the smallest greater key that has one.
    """
    from cadenza.operators.segments import ordered_index

    ranked = ordered_index(starts, spec.series, "_rank")
    block = 4096
    ranked = ranked.withColumn("_block", segment_of(F.col("_rank"), block))
    heads = ranked.groupBy("_block").agg(
        *[F.min_by(f"_start_{c}", F.when(F.col(f"_start_{c}").isNotNull(), F.col("_rank"))).alias(f"_head_{c}")
          for c in columns])
    later = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select("_block", *[
        F.last(f"_head_{c}", ignorenulls=True).over(later).alias(f"_after_{c}") for c in columns])
    back = Window.partitionBy("_block").orderBy(F.desc("_rank")).rowsBetween(Window.unboundedPreceding, 0)
    return ranked.join(heads, "_block", "left").select(*spec.series, *[
        F.coalesce(F.last(f"_start_{c}", ignorenulls=True).over(back), F.col(f"_after_{c}")).alias(f"_start_{c}")
        for c in columns])


def clean_weather(raw: DataFrame, spec: PanelSpec = HOURLY, latest_by: str | None = None) -> DataFrame:
    """Raw weather rows as a gap-free hourly table with standard names.

    Rows without a readable time go; rain and snow are 0 where missing, other
    columns are filled forward, then backward. ``latest_by`` names the column
    which decides between rows of one hour.
    """
    named = clean.rename_known(raw, clean.WEATHER_NAMES)
    clean.require_columns(named, [clean.WEATHER_TIME])
    timed = named.withColumn(spec.time, parse_time(F.col(clean.WEATHER_TIME)))
    numbers = [c for c in clean.WEATHER_NAMES.values() if c in named.columns]
    typed = clean.to_numbers(clean.drop_missing(timed, [spec.time]), numbers)
    if "wind_dir_deg" in numbers:
        sine, cosine = bearing(F.col("wind_dir_deg"))
        typed = typed.withColumns({"wind_dir_sin": sine, "wind_dir_cos": cosine})
    columns = [c for c in clean.WEATHER_COLUMNS if c in typed.columns]
    station = spec.but(key="_station", group=())
    one = typed.withColumn("_station", F.lit(0))
    extra = [latest_by] if latest_by else []
    whole = densify(one.select("_station", spec.time, *columns, *[c for c in extra if c not in columns]),
                    station, fill=None, columns=columns, latest_by=latest_by)
    zeroed = clean.fill_constant(whole, clean.ZERO_WHEN_MISSING)
    gappy = [c for c in columns if c not in clean.ZERO_WHEN_MISSING]
    return fill_along(zeroed, gappy, station).select(spec.time, *columns)


def fill_panel_weather(panel: DataFrame, spec: PanelSpec = HOURLY, borrow_from_next: bool = False) -> DataFrame:
    """Stabilise the weather columns of a joined panel, per series."""
    columns = [c for c in clean.WEATHER_COLUMNS if c in panel.columns]
    zeroed = clean.fill_constant(panel, [spec.value, *clean.ZERO_WHEN_MISSING])
    gappy = [c for c in columns if c not in clean.ZERO_WHEN_MISSING]
    return fill_along(zeroed, gappy, spec, borrow_from_next=borrow_from_next)
