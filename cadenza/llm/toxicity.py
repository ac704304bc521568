"""Toxicity by compression distance: windows of a text are compressed with an ordinary and with a toxic dictionary.

* **Sample.** Labelled rows that are not held out, at most ``rows`` per class by a hash of the id. Two thirds (by
  another hash) train the dictionaries, the others calibrate the score.
* **Dictionaries.** The ordinary one is trained by zstandard on ``windows`` stretches of ordinary text. The toxic one is
  the same content followed by the segments that only toxic documents repeat, so the two differ in nothing but what is
  toxic, and ordinary text compresses alike with both. A segment is a word with its space; in toxic documents it must
  follow at least ``min_contexts`` different words (so copies of one document count once), ``contrast`` times as often
  per document as in ordinary ones, and a likelihood ratio of ``EVIDENCE`` must speak against chance. At most
  ``segments`` of them, the most repeated last, where zstandard reaches them at the lowest cost.
* **Score.** A window is a word with the spaces around it; wider ones were tried and drown a short insult in the noise
  of matches among its neighbours. Windows are coded as UTF-16, since zstandard stores anything as short as a word of
  single bytes unpacked. Every window of the whole text is compressed both ways; the bytes that the toxic dictionary
  saves per character are its gain: more than one says that the whole word is known. How many windows gain at least
  ``GAINS``, the largest gain and the number of windows go through a logistic calibration. Only the text enters.

Training looks at a bounded sample, so model and driver load are the same at any corpus size; scoring is a scan
without a shuffle, and its memory does not grow with the text beyond the text itself.

Defined cases: null and blank texts have no window and the score 0. Ids are compared as text; a null id is
not held out. Contradicting labels of one document count as toxic. Without toxic or without ordinary training rows
nothing is known to be toxic: every score is 0. Repeated rows are scored alike. Extra columns pass through, except
those named like the results, which are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored, words_of

LEVEL = 6
CODING = "utf-16-le"
GAINS = (0.7, 1.02, 1.12)
CACHED = 400_000
ROWS = 6_000
WINDOWS = 30_000
WINDOW_WORDS = 8
SEGMENTS = 4_000
DICT_BYTES = 4 << 10
MIN_CONTEXTS = 6
EVIDENCE = 30.0
CONTRAST = 8.0
THRESHOLD = 0.3
WORDS = re.compile(r"\w+")
RESULT = ["held_out", "score", "predicted"]
STATS = "n_windows long, some long, more long, most long, top double"
STAT_NAMES = ["n_windows", "some", "more", "most", "top"]


@dataclass(frozen=True)
class ToxicModel:
    """Both dictionaries and the calibration; no dictionaries means that nothing is known to be toxic."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def _coded(text: str) -> bytes:
    return text.encode(CODING, "replace")


def _packer(content: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


def window_gains(ordinary: bytes, toxic: bytes, text: Column) -> Column:
    """Struct of the windows of a text, those that the toxic dictionary shortens, and what it saves in all and at most."""
    @F.pandas_udf(STATS)
    def gains(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        plain, harsh, known = _packer(ordinary).compress, _packer(toxic).compress, {}
        for texts in batches:
            rows = []
            for text in texts:
                words = WORDS.findall((text or "").lower())
                saved = []
                for word in words:
                    gain = known.get(word)
                    if gain is None:
                        coded = _coded(f" {word} ")
                        gain = known[word] = max(0, len(plain(coded)) - len(harsh(coded))) / (len(word) + 2)
                    saved.append(gain)
                high = np.array(saved)
                rows.append((len(saved), *(int((high >= g).sum()) for g in GAINS), float(high.max(initial=0))))
                if len(known) > CACHED:
                    known.clear()
            yield pd.DataFrame(rows, columns=STAT_NAMES)

    return gains(text)


def _calibrated(rows: list, ridge: float = 0.05, rounds: int = 50) -> tuple[float, ...]:
    """Logistic weights by Newton steps on (statistics, toxic)."""
    data = np.array(rows, dtype=float).reshape(-1, len(STAT_NAMES) + 1)
    if not len(data):
        return (0.0,) * (len(STAT_NAMES) + 1)
    values, y = np.log1p(data[:, :-1]), data[:, -1]
    middle = values.mean(axis=0)
    x = np.column_stack([np.ones(len(data)), values - middle])
    penalty = np.diag([1e-6, *[ridge] * len(middle)])  # slopes only, so a constant statistic has none
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] - w[1:] @ middle), *(float(v) for v in w[1:])


def training_sample(docs: DataFrame, labels: DataFrame, text: str = "text", rows: int = ROWS) -> DataFrame:
    """At most ``rows`` labelled documents per class: doc_id, text, toxic, and whether they train or calibrate."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.where("_toxic = 1").orderBy(*order).limit(rows).unionByName(
        known.where("_toxic = 0").orderBy(*order).limit(rows))
    return (
        docs.select("doc_id", F.col(text).alias("_text")).join(F.broadcast(chosen), "doc_id")
        .withColumn("_calibrates", F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(3)) == 0)
    )


def _segments(trains: DataFrame, counts: dict[int, int], segments: int, min_contexts: int, contrast: float) -> list[str]:
    """Words that toxic documents repeat in different places and ordinary ones do not, the most repeated last."""
    words = trains.select("_toxic", F.split(F.lower(F.coalesce("_text", F.lit(""))), r"[^\p{L}]+").alias("w"))
    placed = F.transform("w", lambda x, i: F.struct(x.alias("word"), F.coalesce(F.get("w", i - 1), F.lit("")).alias("before")))
    pairs = words.select("_toxic", F.explode(placed).alias("p")).select("_toxic", "p.word", "p.before")
    share = lambda toxic: F.sum((F.col("_toxic") == toxic).cast("int"))
    likely = counts[1] / (counts[0] + counts[1])
    plain = lambda n, q: F.when(n > 0, n * F.log(n / (F.col("t") + F.col("o")) / q)).otherwise(0.0)
    found = (
        pairs.where(F.length("word") > 2).distinct()
        .groupBy("word").agg(share(1).alias("t"), share(0).alias("o"))
        .where(F.col("t") >= min_contexts)
        .where(F.col("t") / counts[1] >= contrast * (F.col("o") + 0.5) / counts[0])
        .where(2 * (plain(F.col("t"), likely) + plain(F.col("o"), 1 - likely)) >= EVIDENCE)
        .orderBy(F.desc("t"), "word").limit(segments)
    )
    return [r.word for r in reversed(found.select("word").collect())]


def train(
    docs: DataFrame, labels: DataFrame, text: str = "text", rows: int = ROWS, windows: int = WINDOWS,
    segments: int = SEGMENTS, dict_bytes: int = DICT_BYTES, min_contexts: int = MIN_CONTEXTS, contrast: float = CONTRAST,
) -> ToxicModel:
    sample = stored(training_sample(docs, labels, text, rows), "toxic-sample")
    trains = sample.where(~F.col("_calibrates"))
    counts = {r["_toxic"]: r["count"] for r in trains.groupBy("_toxic").count().collect()}
    if not counts.get(0) or not counts.get(1):
        return ToxicModel(b"", b"", ())
    starts = F.sequence(F.lit(1), F.greatest(F.size("_words"), F.lit(1)), F.lit(WINDOW_WORDS))
    cut = F.transform(starts, lambda i: F.concat(F.lit(" "), F.concat_ws(" ", F.slice("_words", i, WINDOW_WORDS))))
    plain = (
        trains.where("_toxic = 0").select(words_of(F.lower("_text")).alias("_words")).select(F.explode(cut).alias("w")).distinct()
        .orderBy(F.xxhash64("w"), "w").limit(windows)
    )
    samples = [_coded(r.w) for r in plain.collect()]
    try:
        base = zstandard.train_dictionary(dict_bytes, samples).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text is the dictionary
        base = b"".join(samples)[:dict_bytes]
    base += b"\0" * (len(base) % 2)
    toxic = base + _coded("".join(f" {w}" for w in _segments(trains, counts, segments, min_contexts, contrast)) + " ")
    stats = sample.where("_calibrates").select(window_gains(base, toxic, F.col("_text")).alias("g"), "_toxic")
    seen = [tuple(r) for r in stats.select("g.*", "_toxic").collect()]
    return ToxicModel(base, toxic, _calibrated(seen))


def with_toxicity(docs: DataFrame, model: ToxicModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Documents with ``held_out``, ``score`` and ``predicted``."""
    own = docs.drop(*[c for c in RESULT if c != text])
    columns = own.columns
    own = own.select("doc_id", F.col(text).alias("_text"), F.struct(*columns).alias("_own"))
    if not model.weights:
        scored = own.withColumn("score", F.lit(0.0))
    else:
        gains = own.withColumn("_g", window_gains(model.ordinary, model.toxic, F.col("_text")))
        start, *slopes = model.weights
        logit = sum((w * F.log1p(F.col(f"_g.{name}")) for w, name in zip(slopes, STAT_NAMES, strict=True)), F.lit(start))
        scored = gains.withColumn("score", F.when(F.col("_g.n_windows") > 0, 1 / (1 + F.exp(-logit))).otherwise(0.0)).drop("_g")
    return scored.withColumns({
        "held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= threshold).cast("int"),
    }).select("_own.*", *RESULT)


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Production settings: trained on the labelled documents of ``docs``, applied to all of them."""
    return with_toxicity(docs, train(docs, labels, text), text)
