"""Source divergence audit by in-mapper stripes: how far each source's vocabulary lies from its language's others.

* **Fold.** A partition folds whole documents into stripes: per language and term the document frequency and a hash of
  source counts. Beyond ``SPILL_CELLS`` cells the stripes go out and the fold starts anew, so memory is bounded and a term
  sends one row per fold, however often it occurs.
* **Merge.** Stripes meet by (language, term), sorted, and are merged as a stream: one open stripe per task, and a
  finished one stays if it has ``least_docs`` documents. Rows of a very common term are as many as there were folds.
* **Sizes.** Kept stripes are stored once. Per (language, source) group the occurrences of kept terms are summed from
  them; groups without any come from the documents.
* **Terms.** An entry of a stripe gives one value; the ``top`` largest per group are ranked, cut on the map side first.
* **Pairs.** Sources of a language are dealt to blocks of about ``BLOCK`` by hash, and two blocks are a cell. A stripe goes
  to the cells of its blocks, dealt further by a hash of the term (``CELL_TERMS`` terms to a part of a cell), behind one row
  with the sizes of each block. A cell holds a few hundred stripes as a matrix and adds, for all its pairs at once,
  what each term's value differs from that of a term with no occurrence; the value of V such terms is added once. So a
  task holds two blocks of sources, whatever their number, and the result is as long as the pairs there are.

All arithmetic is in whole numbers: shares by long division in base 1000, so counts up to 9e15 are exact.

Defined cases: null texts, languages and sources are ''. A row is a document, so repeated rows count as often as they
occur. Very long texts are folded whole. Ties are ranked by the item's UTF-8 bytes. A language without kept terms has
pairs of value 0 and no terms; a language with one source has no pairs. Empty tables give an empty result. Extra columns
are not carried.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stored

LEAST_DOCS = 3
TOP = 200
SPILL_CELLS = 400_000
EMIT_ROWS = 50_000
BLOCK = 64
CELL_TERMS = 4096
MATRIX = 1 << 18
UNIT = 1_000_000_000
STRIPES = "lang string, term binary, docs bigint, sources array<string>, counts array<bigint>"
STRIPE_NAMES = ["lang", "term", "docs", "sources", "counts"]
STRIPE_TYPES = [pa.string(), pa.binary(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())]
PAIRS = "lang string, source string, item string, value bigint"
CELL = ["lang", "lo", "hi", "part"]

#: Bytes outside terms become blanks, A-Z become a-z; every byte of a character beyond ASCII is part of a term.
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, text as bytes) to stripes."""
    stripes: dict[str, dict[bytes, dict[str, int]]] = defaultdict(dict)
    docs: dict[str, Counter] = defaultdict(Counter)
    cells = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            counts = Counter(text.translate(TERM_BYTES).split())
            docs[lang].update(counts.keys())
            held = stripes[lang]
            for term, n in counts.items():
                stripe = held.get(term)
                if stripe is None:
                    held[term] = {source: n}
                    cells += 1
                elif source in stripe:
                    stripe[source] += n
                else:
                    stripe[source] = n
                    cells += 1
            if cells >= SPILL_CELLS:
                yield from _emitted(stripes, docs)
                stripes.clear()
                docs.clear()
                cells = 0
    yield from _emitted(stripes, docs)


def _emitted(stripes: dict, docs: dict) -> Iterator[pa.RecordBatch]:
    for lang, held in stripes.items():
        terms, rows, often = list(held), list(held.values()), docs[lang]
        for at in range(0, len(terms), EMIT_ROWS):
            part, own = terms[at:at + EMIT_ROWS], rows[at:at + EMIT_ROWS]
            ends = pa.array(np.cumsum([0, *map(len, own)]), pa.int32())
            yield pa.RecordBatch.from_arrays([
                pa.repeat(pa.scalar(lang, pa.string()), len(part)), pa.array(part, pa.binary()), pa.array([often[t] for t in part], pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(chain.from_iterable(own), pa.string())),
                pa.ListArray.from_arrays(ends, pa.array(chain.from_iterable(r.values() for r in own), pa.int64()))], STRIPE_NAMES)


def _summed(columns: list[pa.Array]) -> list[pa.Array]:
    """Neighbouring rows of one (language, term) added up."""
    lang, term, docs, sources, counts = columns
    new = pc.or_(pc.not_equal(term[1:], term[:-1]), pc.not_equal(lang[1:], lang[:-1])).to_numpy(zero_copy_only=False)
    heads = np.flatnonzero(np.concatenate([[True], new]))
    group = np.cumsum(np.concatenate([[0], new.astype(np.int64)]))
    coded = sources.flatten().dictionary_encode()
    width = max(len(coded.dictionary), 1)
    key = np.repeat(group, sources.value_lengths().to_numpy()) * width + coded.indices.to_numpy()
    order = np.argsort(key, kind="stable")
    key = key[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(key[starts] // width, minlength=len(heads)))]), pa.int32())
    return [
        lang.take(pa.array(heads)), term.take(pa.array(heads)), pa.array(np.add.reduceat(docs.to_numpy(), heads)),
        pa.ListArray.from_arrays(ends, coded.dictionary.take(pa.array(key[starts] % width))),
        pa.ListArray.from_arrays(ends, pa.array(np.add.reduceat(counts.flatten().to_numpy()[order], starts)))]


def _merged(least_docs: int):
    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.cast(t) for c, t in zip(batch.columns, STRIPE_TYPES, strict=True)]
            summed = _summed(rows if last is None else [pa.concat_arrays(two) for two in zip(last, rows, strict=True)])
            done = len(summed[0]) - 1
            last = [c[done:] for c in summed]
            yield _often([c[:done] for c in summed], least_docs)
        if last is not None:
            yield _often(last, least_docs)

    return merged


def _often(columns: list[pa.Array], least_docs: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, STRIPE_NAMES).filter(pc.greater_equal(columns[2], least_docs))


def stripes(docs: DataFrame, text: str = "text", least_docs: int = LEAST_DOCS) -> DataFrame:
    """One row per kept (lang, term): docs, sources, counts. The term is its UTF-8 bytes."""
    rows = docs.select(*(F.coalesce(c, F.lit("")) for c in ("lang", "source")), F.coalesce(F.col(text), F.lit("")).cast("binary"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = rows.mapInArrow(_folded, STRIPES).repartition(parts, "lang", "term")
    return folded.sortWithinPartitions("lang", "term").mapInArrow(_merged(least_docs), STRIPES)


def group_sizes(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """One row per (lang, source) group: n (occurrences of kept terms), lang_n, v (kept terms of the language)."""
    groups = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    entries = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    own = entries.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    sized = groups.join(own, ["lang", "source"], "left").join(terms, "lang", "left").select(
        "lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    return sized.join(sized.groupBy("lang").agg(F.sum("n").alias("lang_n")), "lang")


def _share_sql(count: str, size: str) -> str:
    return f"1 + CAST({UNIT} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(19,0)) div CAST({size} AS DECIMAL(19,0))"


def term_values(kept: DataFrame, sizes: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank of the ``top`` terms that a group has more of than its language."""
    total = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x)
    entries = kept.select("lang", "term", total.alias("total"), F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    entries = entries.select("lang", F.col("e.sources").alias("source"), "term", "total", F.col("e.counts").alias("count"))
    shares = entries.join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", F.expr(_share_sql("count", "n + v")).alias("p"), F.expr(_share_sql("total", "lang_n + v")).alias("q"))
    values = shares.where("p > q").select("lang", "source", "term", F.expr("(p - q) * (p - q) div q").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    return values.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", "source", F.col("term").cast("string").alias("item"), "value", "rank")


def _shares(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / size), by long division."""
    whole, rest = np.divmod(counts + 1, sizes)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, sizes)
        whole = whole * 1000 + digit
    return whole + 1


class _Cell:
    """All pairs of a source of one block with a source of another (or the same) one, over a part of the terms."""

    def __init__(self, key: tuple):
        self.key, self.blocks, self.rows, self.sums = key, [], [], []
        self.left, self.right = [], []

    def block(self, names: list[str], sizes: list[int], terms: int) -> None:
        self.blocks.append((names, np.maximum(np.array(sizes, np.int64), 1)))
        if len(self.blocks) == (1 if self.key[1] == self.key[2] else 2):
            (self.left, self.ls), (self.right, self.rs) = self.blocks[0], self.blocks[-1]
            self.place = {**{s: len(self.left) + j for j, s in enumerate(self.right)}, **{s: i for i, s in enumerate(self.left)}}
            self.zero = self.values(np.zeros((1, len(self.left)), np.int64), np.zeros((1, len(self.right)), np.int64))
            times = terms if self.key[3] == 0 else 0
            self.sums = [z[0] * times for z in self.zero]
            self.room = max(1, MATRIX // (len(self.left) * len(self.right)))

    def values(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """Per term and pair: value of left against right, and of right against left if the blocks differ."""
        p, q = _shares(a, self.ls)[:, :, None], _shares(b, self.rs)[:, None, :]
        square = (p - q) ** 2
        return [square // q] if len(self.blocks) == 1 else [square // q, square // p]

    def stripe(self, sources: list[str], counts: list[int]) -> None:
        if not self.sums:  # one of the blocks is empty
            return
        self.rows.append((sources, counts))
        if len(self.rows) >= self.room:
            self.flush()

    def flush(self) -> None:
        if not self.rows:
            return
        wide = np.zeros((len(self.rows), len(self.left) + len(self.right)), np.int64)
        across = [self.place[s] for sources, _ in self.rows for s in sources]
        down = np.repeat(np.arange(len(self.rows)), [len(s) for s, _ in self.rows])
        wide[down, across] = list(chain.from_iterable(c for _, c in self.rows))
        left = wide[:, :len(self.left)]
        right = left if len(self.blocks) == 1 else wide[:, len(self.left):]
        for total, zero, value in zip(self.sums, self.zero, self.values(left, right), strict=True):
            total += (value - zero).sum(axis=0)
        self.rows = []

    def result(self) -> pa.RecordBatch:
        self.flush()
        names, items, values = [], [], []
        for i, a in enumerate(self.left):
            for j, b in enumerate(self.right):
                if a != b:
                    names.append(a), items.append(b), values.append(int(self.sums[0][i, j]))
                    if len(self.blocks) == 2:
                        names.append(b), items.append(a), values.append(int(self.sums[1][i, j]))
        return pa.RecordBatch.from_arrays(
            [pa.repeat(pa.scalar(self.key[0], pa.string()), len(names)), pa.array(names, pa.string()), pa.array(items, pa.string()),
             pa.array(values, pa.int64())], ["lang", "source", "item", "value"])


def _celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cell = None
    for batch in batches:
        for *key, kind, sources, counts, terms in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if cell is None or cell.key != tuple(key):
                if cell is not None:
                    yield cell.result()
                cell = _Cell(tuple(key))
            if kind > 0:
                cell.stripe(sources, counts)
            else:
                cell.block(sources, counts, terms)
    if cell is not None:
        yield cell.result()


def pair_values(kept: DataFrame, sizes: DataFrame, block: int = BLOCK, cell_terms: int = CELL_TERMS) -> DataFrame:
    """lang, source, item, value, rank of every other source of the language."""
    langs = sizes.groupBy("lang").agg(F.max("v").alias("v"), F.count(F.lit(1)).alias("s")).where("s > 1").select(
        "lang", "v", F.ceil(F.col("s") / block).cast("int").alias("blocks"),
        F.greatest(F.ceil(F.col("v") / cell_terms), F.lit(1)).cast("int").alias("parts"))
    langs = stored(langs, "divergence-langs")
    at = lambda source, blocks: F.pmod(F.xxhash64(source), blocks).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    one_cell = lambda i, j: F.struct(F.least(i, j).alias("lo"), F.greatest(i, j).alias("hi"))
    totals = sizes.drop("v").join(langs, "lang").withColumn("own", at(F.col("source"), F.col("blocks")))
    totals = totals.groupBy("lang", "own", "v", "blocks", "parts").agg(F.collect_list(F.struct("source", (F.col("n") + F.col("v")).alias("size"))).alias("g"))
    totals = totals.select("lang", "v", "g", "parts", F.explode(F.transform(every, lambda j: one_cell(F.col("own"), j))).alias("c"), "own")
    totals = totals.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "lang", "c.lo", "c.hi", "part", F.when(F.col("own") == F.col("c.lo"), -1).otherwise(0).alias("kind"),
        F.col("g.source").alias("sources"), F.col("g.size").alias("counts"), F.col("v").alias("terms"))
    dealt = kept.join(langs, "lang").withColumn("own", F.array_distinct(F.transform("sources", lambda s: at(s, F.col("blocks")))))
    cells = F.array_distinct(F.flatten(F.transform("own", lambda i: F.transform(every, lambda j: one_cell(i, j)))))
    dealt = dealt.select("lang", "term", "sources", "counts", "blocks", "parts", F.explode(cells).alias("c"))
    mine = F.filter(F.arrays_zip("sources", "counts"), lambda e: at(e["sources"], F.col("blocks")).isin(F.col("c.lo"), F.col("c.hi")))
    dealt = dealt.select("lang", "c.lo", "c.hi", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part"), F.when(
        F.col("blocks") == 1, F.arrays_zip("sources", "counts")).otherwise(mine).alias("e")).select(
        *CELL, F.lit(1).alias("kind"), F.col("e.sources").alias("sources"), F.col("e.counts").alias("counts"), F.lit(0).cast("bigint").alias("terms"))
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = totals.unionByName(dealt).repartition(parts, *CELL).sortWithinPartitions(*CELL, "kind")
    sums = rows.mapInArrow(_celled, PAIRS).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.withColumn("rank", F.row_number().over(order))


def divergences(docs: DataFrame, text: str = "text", top: int = TOP, least_docs: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part (``pair`` or ``term``), item, value, rank."""
    kept = stored(stripes(docs, text, least_docs), "divergence-stripes").drop("docs")
    sizes = stored(group_sizes(docs, kept), "divergence-sizes")
    columns = ("lang", "source", "part", "item", "value", "rank")
    pairs = pair_values(kept, sizes).withColumn("part", F.lit("pair")).select(*columns)
    return pairs.unionByName(term_values(kept, sizes, top).withColumn("part", F.lit("term")).select(*columns))
