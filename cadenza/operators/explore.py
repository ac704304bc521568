"""Summaries of a panel."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.spec import HOURLY, PanelSpec


def overview(df: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    """Row count, first and last time, number of series. Combined per key first."""
    per_key = df.groupBy(spec.key).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(spec.time).alias("_lo"), F.max(spec.time).alias("_hi"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"), F.min("_lo").alias("first_time"),
        F.max("_hi").alias("last_time"), F.count(F.lit(1)).alias("n_spots"))


def quality_summary(df: DataFrame, places: int = 3) -> DataFrame:
    """Rows, missing cells and repeated rows (all but the first), with percentages.

    Equal rows are counted by a grouping on all columns, which combines copies
    before the shuffle.
    """
    missing = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    totals = copies.select("_n", (missing * F.col("_n")).alias("_missing")).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("_missing"), F.lit(0)).alias("n_missing"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"))
    cells = F.col("n_rows") * len(df.columns)
    return totals.select(
        "n_rows", "n_missing",
        F.round(F.try_divide(F.col("n_missing") * 100.0, cells), places).alias("missing_pct"),
        "n_duplicates",
        F.round(F.try_divide(F.col("n_duplicates") * 100.0, F.col("n_rows")), places).alias("duplicate_pct"))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts in equal-width bins over [min, max]; the last bin is closed on the right.

    All bins are returned, empty ones with 0.
    """
    known = df.where(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_x"))
    ends = known.agg(F.min("_x").alias("_min"), F.max("_x").alias("_max"))
    flat = F.col("_min") == F.col("_max")
    ends = ends.select(
        F.when(flat, F.col("_min") - 0.5).otherwise(F.col("_min")).alias("lo"),
        F.when(flat, F.col("_max") + 0.5).otherwise(F.col("_max")).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    place = F.least(F.floor((F.col("_x") - lo) / (hi - lo) * bins), F.lit(bins - 1))
    counts = known.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    frame = ends.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "hi")
    width = (F.col("hi") - F.col("lo")) / bins
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("lo") + F.col("bin") * width).alias("left_edge"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("right_edge"),
        F.coalesce("_n", F.lit(0)).alias("n"))


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair over rows where both are known.

    One aggregate over the rows as they are, with the sums of every pair side by side. A constant column has no
    correlation (null); a pair that is never known together has no row.
    """
    pairs = list(combinations_with_replacement([c for c in columns if c in df.columns], 2))
    if not pairs:
        raise ValueError("none of the columns exists")

    def entry(a: str, b: str) -> Column:
        known = F.col(a).isNotNull() & F.col(b).isNotNull()
        x, y = F.when(known, F.col(a).cast("double")), F.when(known, F.col(b).cast("double"))
        value = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        return F.struct(F.lit(a).alias("_a"), F.lit(b).alias("_b"), F.count(x).alias("_n"), value.alias("correlation"))

    sums = df.agg(F.array(*[entry(a, b) for a, b in pairs]).alias("_pairs"))
    upper = sums.select(F.inline("_pairs")).where("_n > 0")
    both = F.array(F.struct(F.col("_a").alias("column_a"), F.col("_b").alias("column_b")),
                   F.struct(F.col("_b").alias("column_a"), F.col("_a").alias("column_b")))
    return upper.select(F.inline(F.array_distinct(both)), "correlation")


def most_frequent(df: DataFrame, column: str) -> DataFrame:
    """The most frequent value; the smallest of several."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column).limit(1)
