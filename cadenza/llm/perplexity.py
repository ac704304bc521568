"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text, per language.

* **Blocks.** Documents are read once, in blocks of about ``BLOCK_BYTES`` of text. A block keeps its texts, compressed,
  and lists its distinct n-grams (``ORDER`` bytes of UTF-8, with marks for begin and end) with their counts in trusted
  documents. Trusted is a condition on the row, so nothing has to be joined to the texts; the default is strict rules on
  symbols, capitals and variety.
* **Model.** Trusted counts are summed over all blocks, so they cover the whole corpus and grow with it. Lower orders
  are continuation counts; every order and language has its own three discounts; contexts interpolate down to a uniform
  distribution over bytes. All of it is sums and joins of tables with a row per n-gram, sharded by n-gram.
* **Requests.** The distinct n-grams of all blocks get their probability by joins with the counts, order by order, and
  go back to their blocks, as one list per block, no longer than the block. A block then scores its documents.
* **Verdict.** A language's threshold lies ``SLACK`` bits per byte above the ``quantile`` of its trusted documents, taken
  from exact counts per thousandth of a bit. Documents above it go.

Texts are stored once, compressed, in buckets by block, and never shuffled; a task holds one chunk of ``CHUNK_BYTES`` of text and one block's n-grams at a time. A hot language is no key of anything but sums.

Defined cases: null and empty texts have only the end mark to predict. A null language is the language ''. Languages
without trusted text have no model: perplexity is that of the uniform distribution and all are kept. Repeated rows are
scored alike (they count as often as they occur). Extra columns are not carried. Empty tables give an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stored, words_of
from cadenza.session import bucketed

ORDER = 4
BEGIN, END = 2, 3
VOCABULARY = 257
BLOCK_BYTES = 24 << 20
CHUNK_BYTES = 2 << 20
QUANTILE = 0.999
BITS = 1000
SLACK = 0.2
BLOCKS = (
    "block bigint, docs array<bigint>, langs array<string>, keys array<bigint>, trusted array<boolean>, sizes array<int>, "
    "texts array<binary>, chunks array<int>, grams array<bigint>, counts array<bigint>")
SCORES = "doc_id bigint, lang string, trusted boolean, n_bytes bigint, bits double"


def strictly_clean(text: Column) -> Column:
    """At least 200 characters, hardly any but letters and plain punctuation, few capitals, and a varied vocabulary."""
    body = F.coalesce(text, F.lit(""))
    words = words_of(body)
    odd = F.regexp_count(body, F.lit(r"[^\p{L}\s.,;:'\"()?-]"))
    capitals = F.regexp_count(body, F.lit(r"\p{Lu}"))
    return (F.length(body) >= 200) & (odd <= 0.02 * F.length(body)) & (capitals <= 0.2 * F.length(body)) & (
        F.size(F.array_distinct(words)) >= 0.2 * F.size(words))


def language_key(lang: str) -> int:
    return (zlib.crc32(lang.encode()) & 0x7FFFFFFF) << 8 * ORDER


def grams_of(texts: list[bytes], keys: list[int]) -> np.ndarray:
    """The n-gram of every byte and end mark of the texts, with the language in its upper bits."""
    joined = np.frombuffer(b"".join(bytes([BEGIN]) * (ORDER - 1) + t + bytes([END]) for t in texts), np.uint8).astype(np.int64)
    grams = np.zeros(len(joined) - ORDER + 1, np.int64)
    for i in range(ORDER):
        grams = (grams << 8) | joined[i:i + len(grams)]
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + ORDER)[:-1]])
    keep = np.ones(len(grams), bool)
    for i in range(1, ORDER):  # n-grams that reach from one text into the next
        keep[(starts[1:] - i)] = False
    return grams[keep] | np.repeat(np.array(keys, np.int64), lengths + 1)


class _Block:
    """Documents of a block, folded in chunks of text, so memory is that of a chunk and of the distinct n-grams."""

    def __init__(self) -> None:
        self.docs: list = []
        self.langs: list[str] = []
        self.keys: list[int] = []
        self.trusted: list[bool] = []
        self.sizes: list[int] = []
        self.texts: list[bytes] = []
        self.chunks: list[int] = []
        self.grams, self.counts = np.empty(0, np.int64), np.empty(0, np.int64)
        self.held: list[bytes] = []
        self.size = self.open = 0

    def add(self, doc: int | None, lang: str, trusted: bool, raw: bytes) -> None:
        self.docs.append(doc)
        self.langs.append(lang)
        self.keys.append(language_key(lang))
        self.trusted.append(trusted)
        self.sizes.append(len(raw))
        self.held.append(raw)
        self.size += len(raw)
        self.open += len(raw)
        if self.open >= CHUNK_BYTES:
            self.fold()

    def fold(self) -> None:
        if not self.held:
            return
        last = len(self.held)
        grams, place = np.unique(grams_of(self.held, self.keys[-last:]), return_inverse=True)
        marks = np.repeat(np.array(self.trusted[-last:], np.float64), [len(t) + 1 for t in self.held])
        counts = np.bincount(place, weights=marks, minlength=len(grams)).astype(np.int64)
        both = np.concatenate([self.grams, grams])
        self.grams, place = np.unique(both, return_inverse=True)
        self.counts = np.bincount(place, weights=np.concatenate([self.counts, counts]), minlength=len(self.grams)).astype(np.int64)
        self.texts.append(zstandard.ZstdCompressor(level=9).compress(b"".join(self.held)))
        self.chunks.append(last)
        self.held, self.open = [], 0

    def row(self, number: int) -> tuple:
        self.fold()
        return number, self.docs, self.langs, self.keys, self.trusted, self.sizes, self.texts, self.chunks, self.grams, self.counts


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, block = TaskContext.get().partitionId() << 32, _Block()
    kinds = [
        pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()),
        pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64())]
    names = ["block", "docs", "langs", "keys", "trusted", "sizes", "texts", "chunks", "grams", "counts"]

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(block.row(number), kinds, strict=True)], names)

    for batch in batches:
        for doc, text, lang, trusted in zip(*(batch.column(i) for i in range(4)), strict=True):
            block.add(doc.as_py(), lang.as_py(), trusted.as_py(), (text.as_py() or "").encode("utf-8", "replace"))
            if block.size >= BLOCK_BYTES:
                yield out()
                number, block = number + 1, _Block()
    if block.docs:
        yield out()


def blocks(docs: DataFrame, trusted: Column, text: str = "text") -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint"), F.col(text).cast("string").alias("text"), F.coalesce("lang", F.lit("")).alias("lang"),
        F.coalesce(trusted, F.lit(False)).alias("trusted")).mapInArrow(_blocks, BLOCKS)


def _suffix(order: int) -> Column:
    """The last ``order`` bytes of an n-gram, with its language."""
    high = F.shiftleft(F.shiftright("g", 8 * ORDER), 8 * ORDER)
    return high.bitwiseOR(F.col("g").bitwiseAND(F.lit((1 << 8 * order) - 1)))


def _language(of: str = "g") -> Column:
    return F.shiftright(of, 8 * ORDER)


def _context() -> Column:
    """All but the last byte. Contexts of different orders are never mixed, so they need no mark."""
    return F.shiftright("g", 8)


def _discounts(counts: DataFrame) -> DataFrame:
    """The three discounts of an order, by language, from how many n-grams occur one to four times."""
    many = lambda k: F.sum((F.col("c") == k).cast("double"))
    n = counts.groupBy(_language().alias("l")).agg(*[many(k).alias(f"n{k}") for k in range(1, 5)])
    y = F.when(F.col("n1") + F.col("n2") > 0, F.col("n1") / (F.col("n1") + 2 * F.col("n2"))).otherwise(0.5)

    def discount(k: int) -> Column:
        fitted = k - (k + 1) * y * F.col(f"n{k + 1}") / F.col(f"n{k}")
        return F.least(F.lit(float(k)), F.greatest(F.lit(0.05), F.when(F.col(f"n{k}") > 0, fitted).otherwise(0.5 * k)))

    return n.select("l", *[discount(k).alias(f"d{k}") for k in (1, 2, 3)])


def _off() -> Column:
    return F.when(F.col("c") >= 3, F.col("d3")).when(F.col("c") == 2, F.col("d2")).when(F.col("c") == 1, F.col("d1")).otherwise(0.0)


def probabilities(requests: DataFrame, counts: DataFrame) -> DataFrame:
    """Probability of the last byte of each requested n-gram ``g`` given the others: g, p. ``counts`` has g and c."""
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):  # continuation counts: distinct longer n-grams with this suffix
        tables[order] = tables[order + 1].groupBy(_suffix(order).alias("g")).agg(F.count(F.lit(1)).alias("c"))
    below = None
    for order in range(1, ORDER + 1):
        wanted = requests if order == ORDER else requests.select(_suffix(order).alias("g")).distinct()
        discounted = tables[order].withColumn("l", _language()).join(_discounts(tables[order]), "l", "left").withColumn("off", _off())
        contexts = discounted.groupBy(_context().alias("h")).agg(F.sum("c").alias("total"), F.sum("off").alias("mass"))
        lower = F.lit(1.0 / VOCABULARY)
        known = wanted.join(discounted.select("g", (F.col("c") - F.col("off")).alias("own")), "g", "left").withColumn("h", _context())
        known = known.join(contexts, "h", "left")
        if below is not None:
            known = known.withColumn("s", _suffix(order - 1)).join(below.select(F.col("g").alias("s"), F.col("p").alias("lower")), "s", "left")
            lower = F.col("lower")
        p = F.when(F.col("total").isNull(), lower).otherwise((F.coalesce("own", F.lit(0.0)) + F.col("mass") * lower) / F.col("total"))
        below = known.select("g", p.alias("p"))
    return below


def _scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["docs", "langs", "keys", "trusted", "sizes", "texts", "chunks", "answers"]
    for batch in batches:
        columns = {n: batch.column(i) for i, n in enumerate(names)}
        for row in range(batch.num_rows):
            docs, langs, keys, trusted, sizes, packed, chunks = (columns[n][row].as_py() for n in names[:7])
            answers = columns["answers"][row].values.flatten()
            grams, bits = answers[0].to_numpy(zero_copy_only=False), answers[1].to_numpy(zero_copy_only=False)
            begin = 0
            for coded, count in zip(packed, chunks, strict=True):
                own = slice(begin, begin + count)
                joined = zstandard.ZstdDecompressor().decompress(coded)
                ends = np.cumsum(sizes[own])
                texts = [joined[e - s:e] for s, e in zip(sizes[own], ends, strict=True)]
                each = bits[np.searchsorted(grams, grams_of(texts, keys[own]))].astype(np.float64)
                lengths = np.array(sizes[own], np.int64) + 1
                sums = np.add.reduceat(each, np.concatenate([[0], np.cumsum(lengths)[:-1]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[own], pa.int64()), pa.array(langs[own], pa.string()), pa.array(trusted[own], pa.bool_()), pa.array(lengths - 1), pa.array(sums / lengths)],
                    ["doc_id", "lang", "trusted", "n_bytes", "bits"])
                begin += count


def scored(docs: DataFrame, trusted: Column | None = None, text: str = "text") -> DataFrame:
    """doc_id, lang, trusted, n_bytes and bits per byte of each document."""
    held = bucketed(blocks(docs, strictly_clean(F.col(text)) if trusted is None else trusted, text), "block", "llm-lm-blocks")
    pairs = held.select(F.explode(F.arrays_zip("grams", "counts")).alias("x")).select(F.col("x.grams").alias("g"), F.col("x.counts").alias("c"))
    sums = stored(pairs.groupBy("g").agg(F.sum("c").alias("c")), "lm-counts")
    known = stored(probabilities(sums.select("g"), sums.where("c > 0")).select("g", (-F.log2("p")).cast("float").alias("b")), "lm-bits")
    asked = held.select("block", F.explode("grams").alias("g")).join(known, "g")
    answers = asked.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("g", "b"))).alias("answers"))
    return held.select("block", "docs", "langs", "keys", "trusted", "sizes", "texts", "chunks").join(answers, "block").select(
        "docs", "langs", "keys", "trusted", "sizes", "texts", "chunks", "answers").mapInArrow(_scores, SCORES)


def with_perplexity(docs: DataFrame, trusted: Column | None = None, text: str = "text", quantile: float = QUANTILE) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang, n_bytes, perplexity (per byte), threshold of its language, kept."""
    rows = stored(scored(docs, trusted, text), "lm-scores").withColumn("step", F.ceil(F.col("bits") * BITS))
    steps = rows.where("trusted").groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n"))
    upto = Window.partitionBy("lang").orderBy("step")
    ranked = steps.withColumns({"below": F.sum("n").over(upto), "all": F.sum("n").over(Window.partitionBy("lang"))})
    limits = ranked.where(F.col("below") >= quantile * F.col("all")).groupBy("lang").agg((F.min("step") + F.lit(int(SLACK * BITS))).alias("limit"))
    return rows.join(limits, "lang", "left").select(
        "doc_id", "lang", "n_bytes", F.round(F.pow(F.lit(2.0), "bits"), 6).alias("perplexity"),
        F.round(F.pow(F.lit(2.0), F.col("limit") / BITS), 6).alias("threshold"),
        F.coalesce(F.col("step") <= F.col("limit"), F.lit(True)).alias("kept"))
