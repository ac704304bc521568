"""Near-duplicate documents by an LSH forest over MinHash signatures, with links confirmed on full shingle sets.

* **Sets.** Words of the whole text, A-Z lower-cased, give the set of distinct 5-word shingles, as 64-bit hashes.
  Documents with equal sets are one class from the start; only classes are compared.
* **Forest.** A signature of ``HASHES`` minima is read in several orders. Classes whose signatures begin alike in an
  order share a region of that order and are each other's longest-common-prefix neighbours. Regions of at most
  ``REGION`` classes are compared throughout. A larger region is compared with its smallest class only. Regions of several
  groups that share a class are a crowd. Crowds of at most ``CROWD`` classes are compared in all of their pairs; the classes
  of larger ones go on to the next level: a longer prefix, in as many more orders as would keep the chance of missing a pair
  at the threshold below 1e-5 if the places of an order were drawn anew each time. They come from the same ``HASHES`` minima, so
  the true chance is higher: 2.5e-4 at depth 4, 9e-4 at 6, 2.8e-3 at 8, 1.4e-2 at 12 and 4.4e-2 at 16 for a pair of 85 %,
  2.7e-2 at 12 for one of 80 %. So depth follows density: sparse text stays at depth 4, crowds of like texts go deeper.
* **Confirmation.** Candidates whose signatures agree in too few places for the threshold (five standard deviations
  below it) are dropped; the others are compared on their full sets.
* **Crowds.** All pairs of a crowd are compared on full sets, after the last level also those of larger crowds: a crowd is
  dealt to blocks, and each pair of blocks is a cell of its own. A cell counts shared shingles as matrix products and gives each linked member its smallest connected one.
* **Groups.** Connected components of the links. Classes of a crowded region that are in one group by then cannot add
  anything and do not go deeper, so a group of a million near copies costs a star, not its square.

No group meets in one task: region sizes are counted with partial aggregation, hot regions only carry stars, and joins
are by keys with one row on one side, which adaptive execution may split. The work on a class of a crowd is at most ``CROWD``
comparisons, or those with all that is still in its crowd after the last level, less the pairs of blocks that lie in one
group; no pair that does not link is a row.

Defined cases: null, empty and blank texts have no shingle (``n_shingles`` 0) and are linked with nothing. A text of
fewer than five words is one shingle. Rows with a null id are linked with nothing and kept. Rows that repeat an id are
judged by their texts, row by row; where an id has different texts and is the smallest of several classes, the class
with the least key is the one that is compared. Extra columns are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored
from cadenza.llm.graph import components

WIDTH = 5
HASHES = 64
REGION = 32
#: Depth of the prefix at each level of the forest.
DEPTHS = (4, 6, 8, 12, 16)
MISS = 1e-5
#: 100 * intersection >= PERCENT * union links two documents.
PERCENT = 85
#: A level that needs more orders than this is left out; the crowds of the level before are compared in all pairs instead.
ORDERS = 200
#: Crowds of at most so many classes are compared in all pairs at any level.
CROWD = 4096
#: Classes in a block of a crowd.
BLOCK = 512
#: Shingles of a cell that are numbered at a time.
NUMBERED = 4_000_000
#: Shingles in a slice of a cell's matrices.
SLICE = 4096
CACHED = 400_000
CHUNK = 4096
SKETCH = "doc_id bigint, n_shingles bigint, k1 bigint, k2 bigint, signature array<int>"

_SEED = np.random.default_rng(20240229)
_XOR = _SEED.integers(0, 1 << 64, HASHES, dtype=np.uint64)
_ODD = _SEED.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Hashes of words, computed once each."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > CACHED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _STEP
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, known: dict) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    width = min(WIDTH, len(words))
    rolled = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        rolled = _mixed(rolled + hashes[i:i + len(rolled)])
    return np.unique(rolled)


def signature(values: np.ndarray) -> np.ndarray:
    """The least of each of the hash functions over a set."""
    least = np.full(HASHES, np.iinfo(np.uint32).max, np.uint32)
    for i in range(0, len(values), CHUNK):
        hashed = ((values[None, i:i + CHUNK] ^ _XOR[:, None]) * _ODD[:, None]) >> np.uint64(32)
        least = np.minimum(least, hashed.min(axis=1).astype(np.uint32))
    return least


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Words()
    for batch in batches:
        sizes, keys, rows = [], [], []
        for text in batch.column(1):
            values = shingles(text.as_py(), known)
            sizes.append(len(values))
            keys.append(xxhash.xxh3_128_digest(values.tobytes()))
            rows.append(signature(values))
        both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
        flat = np.concatenate(rows).view(np.int32) if rows else np.empty(0, np.int32)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * HASHES), pa.array(flat))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(both[:, 0]), pa.array(both[:, 1]), lists],
            ["doc_id", "n_shingles", "k1", "k2", "signature"])


def sketches(docs: DataFrame, text: str = "text") -> DataFrame:
    """Set size, 128-bit identity of the set, and signature of each document."""
    return docs.select(F.col("doc_id").cast("bigint"), F.col(text).alias("text")).mapInArrow(_sketch_batches, SKETCH)


def orders(depth: int, percent: int = PERCENT) -> list[list[int]]:
    """Signature places (from 1) of each order's prefix, as many orders as the depth needs at the threshold."""
    need = math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** depth))
    shuffled = np.random.default_rng(depth)
    whole, prefixes = [], []
    while len(prefixes) < need:
        if len(whole) < depth:
            whole = [int(p) + 1 for p in shuffled.permutation(HASHES)]
        prefixes.append(whole[:depth])
        whole = whole[depth:]
    return prefixes


def _regions(classes: DataFrame, depth: int, percent: int) -> DataFrame:
    """Each class in its region of each order: node, region."""
    places = F.array(*[F.array(*[F.lit(p) for p in prefix]) for prefix in orders(depth, percent)])
    ordered = classes.select("node", "signature", F.posexplode(places).alias("tree", "places"))
    prefix = F.transform("places", lambda p: F.element_at("signature", p))
    return ordered.select("node", F.xxhash64("tree", prefix).alias("region"))


def _pairs_within(members: Column) -> Column:
    """All pairs of a short sorted array."""
    tails = F.transform(members, lambda a, i: F.transform(
        F.slice(members, i + 2, F.size(members)), lambda b: F.struct(a.alias("a"), b.alias("b"))))
    return F.flatten(tails)


def candidates(classes: DataFrame, depth: int, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs of a level, and the members ``node, region`` of its crowded regions."""
    placed = _regions(classes, depth, percent)
    sizes = placed.groupBy("region").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("leader")).where("size > 1")
    members = stored(placed.join(sizes, "region"), "forest-members")
    small = members.where(F.col("size") <= REGION).groupBy("region").agg(F.array_sort(F.collect_list("node")).alias("all"))
    pairs = small.select(F.explode(_pairs_within(F.col("all"))).alias("p")).select("p.a", "p.b")
    crowded = members.where(F.col("size") > REGION)
    pairs = pairs.unionByName(crowded.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")))
    return pairs.distinct(), crowded.select("node", "region")


def _likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose signatures agree about as often as linked sets do."""
    share = percent / 100
    least = math.floor(HASHES * share - 5 * math.sqrt(HASHES * share * (1 - share)))
    of = lambda name: classes.select(F.col("node").alias(name), F.col("signature").alias(f"s{name}"))
    agree = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda same: same))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(agree >= least).select("a", "b")


def _confirm(percent: int):
    def confirmed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, last = _Words(), (None, None)
        for batch in batches:
            keep = []
            for a, ta, tb in zip(batch["a"], batch["ta"], batch["tb"], strict=True):
                if last[0] != a:
                    last = (a, shingles(ta, known))
                x, y = last[1], shingles(tb, known)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared) > 0)
            yield batch.loc[keep, ["a", "b"]]

    return confirmed


def texts_of(nodes: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """Texts of the given documents, pulled once: the only time that texts are shuffled.

    Both sides grow with the data, so the join is by shuffle at any size.
    """
    pulled = docs.select("doc_id", F.col(text).alias("t")).join(nodes.hint("merge"), docs["doc_id"] == nodes["node"], "left_semi")
    return stored(pulled.groupBy("doc_id").agg(F.min("t").alias("t")), "forest-texts")


def links(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    of = lambda name: texts.select(F.col("doc_id").alias(name), F.col("t").alias(f"t{name}"))
    joined = pairs.join(of("a"), "a").join(of("b"), "b")
    return joined.mapInPandas(_confirm(percent), "a bigint, b bigint")


def _shared(sets: list[np.ndarray], sides: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """How many elements each of the sets ``one`` shares with each of the sets ``two``."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, codes = np.unique(np.concatenate(sets), return_inverse=True)
    if (sides == 1).any():
        useful = (np.bincount(codes[sides[owner] == 0], minlength=codes.max(initial=0) + 1) > 0) & (
            np.bincount(codes[sides[owner] == 1], minlength=codes.max(initial=0) + 1) > 0)
    else:
        useful = np.bincount(codes) > 1
    column = np.cumsum(useful) - 1
    some = useful[codes]
    owner, codes = owner[some], column[codes[some]]
    order = np.argsort(codes, kind="stable")
    owner, codes = owner[order], codes[order]
    shared = np.zeros((len(one), len(two)), np.float32)
    for start in range(0, int(useful.sum()), SLICE):
        lo, hi = np.searchsorted(codes, [start, start + SLICE])
        has = np.zeros((len(sets), SLICE), np.float32)
        has[owner[lo:hi], codes[lo:hi] - start] = 1
        shared += has[one] @ has[two].T
    return shared.astype(np.int64)


def _linked(sets: list[np.ndarray], sides: np.ndarray, percent: int) -> np.ndarray:
    """Which sets of side 0 link with which of side 1, as a symmetric matrix; among themselves if all have side 0."""
    sizes = np.array([len(x) for x in sets])
    one, two = np.flatnonzero(sides == 0), np.flatnonzero(sides == 1)
    crossed = len(two) > 0
    if not crossed:
        two = one
    parts = -(-int(sizes.sum()) // NUMBERED)
    shared = np.zeros((len(one), len(two)), np.int64)
    bounds = [(1 << 64) // parts * i for i in range(1, parts)]
    for own in zip(*(np.split(x, np.searchsorted(x, np.array(bounds, np.uint64))) for x in sets), strict=True):
        shared += _shared(own, sides, one, two)
    links = 100 * shared >= percent * (sizes[one][:, None] + sizes[two][None, :] - shared)
    linked = np.zeros((len(sets), len(sets)), bool)
    linked[np.ix_(one, two)] = links
    if crossed:
        linked[np.ix_(two, one)] = links.T
    np.fill_diagonal(linked, False)
    return linked


def _crowd_cell(nodes: list[int], sides: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """(smallest connected member, member) of the members of a cell that link."""
    linked = _linked(sets, np.array(sides), percent)
    label = np.array(nodes)
    places = np.flatnonzero(linked.any(axis=1))
    linked, label = linked[np.ix_(places, places)], label[places]
    own = label
    while len(label):
        least = np.minimum(label, np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == label).all():
            break
        label = least
    return ((a, b) for a, b in zip(label.tolist(), own.tolist(), strict=True) if a != b)


def _crowd_cells(percent: int):
    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        cell, nodes, sides, sets = None, [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            found = list(_crowd_cell(nodes, sides, sets, percent)) if len(nodes) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["a", "b"])

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for *at, side, node, text in zip(*columns, strict=True):
                if at != cell:
                    yield from done()
                    cell, nodes, sides, sets = at, [], [], []
                nodes.append(node)
                sides.append(side)
                sets.append(shingles(text, known))
        yield from done()

    return cells


def crowds_of(members: DataFrame) -> DataFrame:
    """Crowd of each class of ``members(node, region, group)``: node, group, crowd."""
    leaders = members.groupBy("region").agg(F.min("node").alias("a"))
    crowds = components(members.join(leaders, "region").select("a", F.col("node").alias("b")), "crowds")
    return members.select("node", "group").distinct().join(crowds, "node").withColumnRenamed("component", "crowd")


def crowd_links(members: DataFrame, texts: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Links that connect what is linked among the ``members(node, region, group)`` of each region, from all pairs."""
    return links_within(crowds_of(members), texts, percent, block)


def links_within(own: DataFrame, texts: DataFrame, percent: int = PERCENT, block: int = BLOCK) -> DataFrame:
    """Links that connect what is linked among the classes of each crowd, ``own(node, group, crowd)``, from all pairs.

    Pairs within a group of more than ``block`` classes are not compared: they add nothing.
    """
    large = own.groupBy("crowd", "group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block).select("crowd", "group", F.lit(True).alias("alone"))
    part = own.join(large, ["crowd", "group"], "left").select(
        "node", "crowd", F.coalesce("alone", F.lit(False)).alias("alone"), F.when(F.col("alone"), F.col("group")).otherwise(0).alias("part"))
    part = stored(part, "crowd-parts")
    keys = ["crowd", "alone", "part"]
    sizes = part.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    dealt = part.join(sizes, keys).select(*keys, F.xxhash64("alone", "part", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block"), "node")
    dealt = stored(dealt, "crowd-blocks")
    blocks = dealt.select(*keys, "block").distinct()
    other = blocks.select("crowd", F.col("alone").alias("alone2"), F.col("part").alias("part2"), F.col("block").alias("hi"))
    same = F.col("alone") & F.col("alone2") & (F.col("part") == F.col("part2"))
    cells = blocks.withColumnRenamed("block", "lo").join(other, "crowd").where((F.col("lo") <= F.col("hi")) & ~same).select("crowd", "lo", "hi")
    sides = cells.select("*", F.col("lo").alias("block"), F.lit(0).alias("side")).unionByName(
        cells.where("lo < hi").select("*", F.col("hi").alias("block"), F.lit(1).alias("side")))
    rows = sides.join(dealt.select("crowd", "block", "node"), ["crowd", "block"]).join(texts.withColumnRenamed("doc_id", "node"), "node")
    cell = ["crowd", "lo", "hi"]
    return rows.select(*cell, "side", "node", "t").repartition(*cell).sortWithinPartitions(*cell).mapInArrow(
        _crowd_cells(percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    known = stored(sketches(docs, text), "sketches")
    keys = ["n_shingles", "k1", "k2"]
    sets = known.where("n_shingles > 0 AND doc_id IS NOT NULL")
    heads = sets.groupBy(*keys).agg(F.min("doc_id").alias("node"))
    own = sets.withColumnRenamed("doc_id", "node").join(heads, [*keys, "node"], "left_semi")
    first = own.groupBy("node").agg(F.min(F.struct("k1", "k2", "signature")).alias("s"))
    classes = stored(first.select("node", "s.signature"), "classes")
    found, groups, texts, left, stale = None, None, None, classes, False
    depths = [d for d in DEPTHS if len(orders(d, percent)) <= ORDERS]
    for depth in depths:
        pairs, crowded = candidates(left, depth, percent)
        likely = stored(_likely(pairs, classes, percent), "likely")
        if texts is None:  # deeper levels only know classes that are crowded here
            ends = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node")))
            texts = texts_of(ends.unionByName(crowded.select("node")).distinct(), docs, text)
        fresh = stored(links(likely, texts, percent), "links")
        found = fresh if found is None else found.unionByName(fresh)
        if groups is None or stale or not fresh.isEmpty():
            groups = stored(components(found), "groups")
        stale = False
        group = F.coalesce("component", "node").alias("group")
        placed = crowded.join(groups, "node", "left").select("node", "region", group)
        open_ = placed.groupBy("region").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi")
        own = stored(crowds_of(placed.join(open_, "region", "left_semi")), "crowd-members")
        if own.isEmpty():
            break
        limit = F.lit(True) if depth == depths[-1] else F.col("size") <= CROWD
        sizes = own.groupBy("crowd").agg(F.count(F.lit(1)).alias("size")).select("crowd", limit.alias("whole"))
        own = own.join(sizes, "crowd")
        rest = stored(links_within(own.where("whole").drop("whole"), texts, percent), "links")
        stale = not rest.isEmpty()
        if stale:
            found = found.unionByName(rest)
        left = stored(classes.join(own.where("NOT whole").select("node"), "node", "left_semi"), "deeper")
        if left.isEmpty():
            break
    if stale:
        groups = stored(components(found), "groups")
    mapped = heads.join(groups, "node", "left").select(*keys, F.coalesce("component", "node").alias("_group"))
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("_group")), F.col("doc_id"))
    return known.join(mapped, keys, "left").select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"))
