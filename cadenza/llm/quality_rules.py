"""Quality rules: base counts of a text, and a hashed n-gram log-likelihood ratio between trusted and raw text.

Everything is DataFrame functions; no row leaves the JVM.

* **Features.** The words of a text give hashed unigrams and bigrams, dealt to ``buckets`` buckets.
* **Model.** Bucket counts over all documents (raw multinomial) and over trusted documents (target multinomial) give one
  log ratio per bucket. The target is smoothed by ``alpha`` counts per bucket, dealt like the raw counts, so with few
  trusted documents ratios go to 0. Counting is partially aggregated per task, so a shuffle
  carries at most ``buckets`` rows per task; the model is ``buckets`` doubles at any corpus size.
* **Verdict.** A document's score is the mean log ratio of its n-grams. It is kept if it passes the base rules and its
  score is at least ``threshold``. No sampling, so equal texts always get equal verdicts.

The trusted set may be a bounded sample (``trusted_rows``, taken by a hash of the id), which is the only thing ever
broadcast besides the model.

Defined cases: a null or blank text has no words, score 0 and fails the base rules. Repeated rows and ids are scored
row by row. Extra columns pass through ``with_quality`` unless they carry one of its result names, which it replaces.
Without trusted documents or without any document every ratio is 0, so only the base rules decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import WORD_GAP, words_of

BUCKETS = 16_384
ALPHA = 4.0
TRUSTED_ROWS = 20_000
THRESHOLD = -0.045
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RESULT = [*BASE, "base_failed", "score", "kept"]


def trusted_ids(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids that are labelled good and never bad; at most ``rows`` of them, by a hash of the id."""
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("_good"))
    return good.where("_good = 1").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select("doc_id")


def _hashed(df: DataFrame, text: str) -> DataFrame:
    """Adds the words, their hashes, and nothing else that is per word."""
    worded = df.withColumn("_words", words_of(F.col(text)))
    return worded.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))


def _grams(hashes: Column, buckets: int) -> Column:
    """Buckets (from 1) of all unigrams and bigrams."""
    ones = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int") + 1)
    twos = F.transform(
        F.slice(hashes, 1, F.greatest(F.size(hashes) - 1, F.lit(0))),
        lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int") + 1)
    return F.concat(ones, twos)


def log_ratios(docs: DataFrame, trusted: DataFrame, text: str = "text", buckets: int = BUCKETS, alpha: float = ALPHA) -> DataFrame:
    """One row with the array ``ratios``: log(target / raw) per bucket.

    ``trusted`` must be bounded: it is broadcast.
    """
    marked = docs.select("doc_id", text).join(
        F.broadcast(trusted.select("doc_id").distinct().withColumn("_trusted", F.lit(1))), "doc_id", "left")
    counts = (
        _hashed(marked, text)
        .select(F.explode(_grams(F.col("_hashes"), buckets)).alias("_bucket"), F.coalesce("_trusted", F.lit(0)).alias("_t"))
        .groupBy("_bucket").agg(F.count(F.lit(1)).alias("_raw"), F.sum("_t").alias("_target"))
    )
    every = docs.sparkSession.range(1, buckets + 1).select(F.col("id").cast("int").alias("_bucket"))
    full = every.join(counts, "_bucket", "left").fillna(0, ["_raw", "_target"])
    packed = full.agg(F.array_sort(F.collect_list(F.struct("_bucket", "_raw", "_target"))).alias("b"))
    total = lambda field: F.aggregate(F.transform("b", lambda x: x[field]), F.lit(0).cast("bigint"), lambda a, x: a + x)
    sums = packed.select("b", total("_raw").alias("raw"), total("_target").alias("target"))
    prior = F.lit(float(alpha * buckets))
    share = lambda x: x["_raw"] / F.col("raw")
    ratio = F.transform("b", lambda x: F.when(
        (F.col("target") > 0) & (x["_raw"] > 0),
        F.log((x["_target"] + prior * share(x)) / (F.col("target") + prior)) - F.log(share(x))).otherwise(0.0))
    return sums.select(ratio.alias("ratios"))


def _with_repeats(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words covered by windows (hashes by position) that occur twice or more.

    Texts without any equal windows, nearly all of them, stop at the first test. The others sort (hash, position)
    pairs, keep those with an equal neighbour and add up the covered stretch up to the next such window. Each step is
    a column of its own, since a lambda evaluates what it names once per element.
    """
    pairs = F.array_sort(F.transform("_windows", lambda v, i: F.struct(v.alias("v"), i.alias("i"))))
    none = F.array().cast("array<struct<v:bigint,i:int>>")
    df = df.withColumn("_pairs", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), pairs).otherwise(none))
    repeated = F.filter("_pairs", lambda p, k: (
        (k > 0) & (F.get("_pairs", k - 1)["v"] == p["v"])) | F.coalesce(F.get("_pairs", k + 1)["v"] == p["v"], F.lit(False)))
    df = df.withColumn("_places", F.array_sort(F.transform(repeated, lambda p: p["i"])))
    covered = F.transform("_places", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_places", k + 1) - p, F.lit(3))))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return df.withColumn("n_repeat_words", total).drop("_windows", "_pairs", "_places")


def with_quality(
    docs: DataFrame, ratios: DataFrame, text: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD,
    min_words: int = MIN_WORDS, max_repeat_percent: int = MAX_REPEAT_PERCENT,
) -> DataFrame:
    """Documents with their base counts, score and verdict. ``ratios`` comes from ``log_ratios``."""
    own = docs.drop(*[c for c in RESULT if c != text])
    body = F.coalesce("_text", F.lit(""))
    # The caller's columns travel in a struct, so no name of theirs can meet one of the steps.
    packed = own.select(F.struct(*own.columns).alias("_own"), F.col(text).alias("_text"), ratios.select("ratios").scalar().alias("_table"))
    hashed = _hashed(packed, "_text")
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    counted = hashed.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.concat_ws("", "_words")).cast("bigint"),
        "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("bigint"),
        "_lines": F.when(F.contains(body, F.lit("\n")), lines).otherwise(F.array().cast("array<string>")),
        "_windows": F.transform(
            F.slice("_hashes", 1, F.greatest(F.size("_hashes") - 2, F.lit(0))),
            lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2))),
        "_grams": _grams(F.col("_hashes"), buckets),
    }).drop("_words", "_hashes")
    summed = F.aggregate("_grams", F.lit(0.0), lambda a, b: a + F.element_at("_table", b))
    scored = _with_repeats(counted).withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "score": F.when(F.size("_grams") > 0, summed / F.size("_grams")).otherwise(0.0),
    }).drop("_lines", "_grams", "_table")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    judged = scored.withColumn("base_failed", failed)
    # A filter on a plain expression would be pushed down through every step and evaluate them once per element.
    here = F.monotonically_increasing_id() >= 0
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold) & here).select(
        "_own.*", *RESULT)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """Production settings: target from the labelled good documents, raw from all documents."""
    return with_quality(docs, log_ratios(docs, trusted_ids(labels), text), text)
