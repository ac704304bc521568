"""Ordered work on series without putting a whole series into one task.

A series is cut into segments of ``spec.segment`` consecutive positions. Rows
near a border are copied into the neighbouring segment (a halo as wide as the
frame), window functions run per (series, segment), and only the home copy of
each row is kept. The result equals the same window per series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from cadenza.functions.dates import tick_of
from cadenza.operators.joins import lookup_join
from cadenza.session import materialize
from cadenza.spec import PanelSpec

ORDINAL = "_ordinal"
SEGMENT = "_segment"


def segment_of(position: Column, size: int) -> Column:
    return F.call_function("div", position - F.pmod(position, F.lit(size)), F.lit(size))


def with_ordinal(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Add a position which grows by one from row to row of each series.

    A dense panel has it for free: the grid index of its time. Otherwise rows
    are counted per time bucket and the counts of earlier buckets are added.
    """
    ticked = df.withColumn(ORDINAL, tick_of(F.col(spec.time), spec.step_seconds))
    if spec.dense:
        return ticked
    bucketed = ticked.withColumn(SEGMENT, segment_of(F.col(ORDINAL), spec.segment))
    keys = [*spec.series, SEGMENT]
    earlier = Window.partitionBy(*spec.series).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucketed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).select(
        *keys, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy(*keys).orderBy(spec.time)
    return (
        bucketed.join(offsets, keys)
        .withColumn(ORDINAL, F.col("_offset") + F.row_number().over(within) - 1)
        .drop("_offset", SEGMENT)
    )


def over_segments(
    df: DataFrame,
    spec: PanelSpec,
    columns: Callable[[WindowSpec], dict[str, Column]],
    before: int = 0,
    after: int = 0,
    keep: Column | None = None,
) -> DataFrame:
    """Add window columns whose frames reach ``before`` rows back and ``after`` rows ahead.

    ``columns`` gets the window (partitioned by series and segment, ordered by
    position) and returns the columns to add. ``keep`` filters the result while
    the helper columns still exist.
    """
    placed = df if ORDINAL in df.columns else with_ordinal(df, spec)
    position, size = F.col(ORDINAL), spec.segment
    if before or after:
        reach = F.sequence(segment_of(position - after, size), segment_of(position + before, size))
        placed = placed.withColumn(SEGMENT, F.explode(reach))
    else:
        placed = placed.withColumn(SEGMENT, segment_of(position, size))
    window = Window.partitionBy(*spec.series, SEGMENT).orderBy(ORDINAL)
    made = placed.withColumns(columns(window))
    if before or after:
        made = made.where(F.col(SEGMENT) == segment_of(position, size))
    if keep is not None:
        made = made.where(keep)
    return made.drop(SEGMENT, ORDINAL)


def ordered_index(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """0-based rank of each row in a total order, for tables of keys of any size.

    The table is range-partitioned, pinned in the shared folder, ranked per range and shifted by the sizes of the
    earlier ranges.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    pinned = materialize(ranged, "ordered")
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = pinned.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_shift"))
    within = Window.partitionBy("_range").orderBy(*order)
    return (
        lookup_join(pinned, shift, ["_range"])
        .withColumn(name, (F.row_number().over(within) - 1 + F.col("_shift")).cast("bigint"))
        .drop("_range", "_shift")
    )
