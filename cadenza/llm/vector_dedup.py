"""Near-duplicate vectors by a pivot-permutation index, with links confirmed by cosine in double precision.

* **Classes.** Equal vectors of one label are one class from the start, with its number of rows.
* **Pivots.** ``PIVOTS`` reference points of the data's dimension: vectors of a sample of ``SAMPLE`` rows (by hash) of
  which no two are alike, filled up with fixed random directions. A vector is described by its ``NEAREST`` nearest pivots.
* **Inverted lists.** Two vectors that share at least ``SHARED`` of these have three of them in common among the first
  ``NEAREST - SHARED + 3`` of each, in the order of pivot numbers. So every vector is posted under the triples of that
  prefix, and lists with a single member end there. At cosine 0.98 in 64 dimensions 99.5 % of pairs share five of nine.
* **Confirmation.** A list is compared as one matrix product. A pair that meets in several lists counts in one only, the
  list of its three least common pivots, so nothing has to be made distinct afterwards. Lists beyond ``BLOCK`` members
  are dealt to pairs of blocks, one cell each.
* **Output of a cell.** Per member the number of rows it links to, and its smallest connected member: as many rows as
  members, however many pairs link. Counts are summed; components follow from the second.

No list, label or class meets in one task, and no pair is ever a row.

Defined cases: null ids or labels, null, empty and zero vectors, and vectors with null or non-finite components link with
nothing and are components of their own. Vectors of different dimensions do not link. Rows that repeat an id are counted
row by row. Extra columns are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored
from cadenza.llm.graph import components

PIVOTS = 256
NEAREST = 9
SHARED = 5
SAMPLE = 2048
ALIKE = 0.8
BLOCK = 256
COSINE = 0.98
PREFIX = NEAREST - SHARED + 3
TRIPLES = np.array(list(combinations(range(PREFIX), 3)))


def usable(embedding: Column) -> Column:
    """Neither null, empty nor zero, and every component a finite number."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(embedding.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def pivots(classes: DataFrame, sample: int = SAMPLE) -> dict[int, np.ndarray]:
    """Reference points by dimension, for the dimensions of the sample."""
    rows = classes.select("embedding").orderBy(F.xxhash64("embedding"), "node").limit(sample).collect()
    by_size: dict[int, list[np.ndarray]] = {}
    for row in rows:
        v = np.array(row.embedding, np.float64)
        by_size.setdefault(len(v), []).append(v / np.linalg.norm(v))
    return {size: _spread(vectors, size) for size, vectors in by_size.items()}


def _spread(vectors: list[np.ndarray], size: int) -> np.ndarray:
    chosen: list[np.ndarray] = []
    for v in vectors:
        if len(chosen) == PIVOTS:
            break
        if not chosen or np.max(np.stack(chosen) @ v) < ALIKE:
            chosen.append(v)
    more = np.random.default_rng(size).normal(size=(PIVOTS - len(chosen), size))
    return np.concatenate([np.array(chosen).reshape(-1, size), more / np.linalg.norm(more, axis=1, keepdims=True)])


def _postings(points: dict[int, np.ndarray]):
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nearest, keys = [], []
            for vector in batch.column(1):
                v = np.array(vector.as_py(), np.float64)
                if len(v) not in points:
                    points[len(v)] = _spread([], len(v))
                tops = np.sort(np.argsort(-(points[len(v)] @ v), kind="stable")[:NEAREST])
                triples = tops[TRIPLES]
                nearest.append(tops.astype(np.int32))
                keys.append((triples[:, 0] * PIVOTS + triples[:, 1]) * PIVOTS + triples[:, 2])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(nearest, pa.list_(pa.int32())), pa.array(keys, pa.list_(pa.int64()))], ["node", "nearest", "keys"])

    return postings


def _cell(cell: tuple, rows: list[tuple], cosine: float) -> Iterator[tuple[int, int, int]]:
    """(node, rows linked in this cell, smallest connected node) of the members of a cell that link at all."""
    nodes = np.array([r[0] for r in rows])
    sizes = np.array([r[1] for r in rows])
    blocks = np.array([r[2] for r in rows])
    vectors = np.array([r[3] for r in rows], np.float64)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = vectors @ vectors.T >= cosine
    np.fill_diagonal(linked, False)
    _, _, key, lo, hi = cell
    if lo != hi:
        linked &= blocks[:, None] != blocks[None, :]
    if not linked.any():
        return
    last = key % PIVOTS
    has = np.zeros((len(rows), PIVOTS), np.float32)
    np.put_along_axis(has, np.array([r[4] for r in rows]), 1, axis=1)
    low = has[:, :last + 1]
    counts = ((linked & (low @ low.T < 3.5)) * sizes[None, :]).sum(axis=1)
    label = nodes.copy()
    while True:
        least = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == label).all():
            break
        label = least
    for i in np.flatnonzero(linked.any(axis=1)).tolist():
        yield int(nodes[i]), int(counts[i]), int(label[i])


def _cells(cosine: float):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows = None, []

        def out(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["node", "linked", "least"])

        for batch in batches:
            found = []
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for at in zip(*columns, strict=True):
                if at[:5] != cell:
                    if len(rows) > 1:
                        found += _cell(cell, rows, cosine)
                    cell, rows = at[:5], []
                rows.append(at[5:])
            if found:
                yield out(found)
        if len(rows) > 1:
            found = list(_cell(cell, rows, cosine))
            if found:
                yield out(found)

    return cells


def linked_classes(classes: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """Per class and cell: node, linked (rows linked there), least (smallest class connected there).

    ``classes`` has node, label, embedding and rows (how many vectors the class stands for).
    """
    ranked = classes.select("node", "embedding").mapInArrow(
        _postings(pivots(classes)), "node bigint, nearest array<int>, keys array<bigint>")
    full = stored(classes.join(ranked, "node"), "ranked").withColumn("dim", F.size("embedding"))
    posted = full.select("label", "dim", F.explode("keys").alias("key"), "node")
    lists = posted.groupBy("label", "dim", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    shared = posted.join(lists, ["label", "dim", "key"]).withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    partners = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = shared.withColumn("own", own).withColumn("other", partners).select(
        "label", "dim", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "own")
    cells = dealt.join(full.select("node", "rows", "embedding", "nearest"), "node").select(
        "label", "dim", "key", "lo", "hi", "node", "rows", "own", "embedding", "nearest")
    keys = ["label", "dim", "key", "lo", "hi"]
    return cells.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_cells(cosine), "node bigint, linked bigint, least bigint")


def near_duplicate_vectors(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """One row per row of ``vectors``: vec_id, n_links, component_id, kept."""
    ok = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    known = vectors.select(F.col("vec_id").cast("bigint"), "label", "embedding").withColumn("ok", ok)
    grouped = known.where("ok").groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("rows"))
    classes = stored(grouped, "vector-classes")
    found = stored(linked_classes(classes, cosine, block), "vector-links")
    counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    groups = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")), "vector-groups")
    mapped = classes.join(counts, "node", "left").join(groups, "node", "left").select(
        "label", "embedding", F.lit(True).alias("ok"),
        (F.col("rows") - 1 + F.coalesce("linked", F.lit(0))).alias("_links"), F.coalesce("component", "node").alias("_component"))
    component = F.coalesce("_component", "vec_id")
    return known.join(mapped, ["label", "embedding", "ok"], "left").select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"))
