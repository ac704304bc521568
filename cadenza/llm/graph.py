"""Connected components of an undirected graph given as pairs of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored


def _minimum(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each source, the source included. Partially aggregated, so hubs do not matter."""
    return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
    return row[0], row[1]


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """One row ``node, component`` (smallest id reachable) per node of ``edges(a, b)``.

    Alternating large and small stars: every round links the neighbours of each node to its smallest one, which ends
    after about log(n) rounds whatever the shape. A round is a partially aggregated minimum and a join back to the
    edges; a hub's edges may be split over tasks, and nothing of a component meets in one place. Each round is stored,
    so lineage stays short. Without edges there are no rows.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = stored(pairs, label)
    before = _mark(pairs)
    while before[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(_minimum(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.where("a <> b").distinct(), label)
        lower = large.select("a", "b")
        least = lower.groupBy("a").agg(F.min("b").alias("m"))
        small = lower.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
        pairs = stored(small.where("a <> b").distinct(), label)
        now = _mark(pairs)
        if now == before:
            break
        before = now
    members = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(roots)
