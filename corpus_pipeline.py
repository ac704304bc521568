"""From raw documents to packed training sequences: the stages, and a run over the given tables.

Each stage gets what its predecessor kept and returns a DataFrame, which ``run`` writes as Parquet to the shared
folder and reads back. All stages but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import minhash, packing, quality_rules, toxicity
from cadenza.llm.common import stored, table


#: Near duplicates share this part of their shingles, of 100. op5_minhash has its own.
PERCENT = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality_rules.quality(docs, table(spark, sf_dir, "labels")).where("kept").select(*docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; trained on the labelled ones among those that came this far."""
    scored = toxicity.toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates: 5-word shingles, similarity 0.8 or more.

    Rows that repeat an id are one document, of which one row stays. Rows without an id all stay.
    """
    kept = minhash.near_duplicates(docs, percent=PERCENT).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64(*[c for c in docs.columns if c != "doc_id"]))
    own = docs.join(kept.hint("merge"), "doc_id", "left_semi").withColumn("_row", F.row_number().over(first)).where("_row = 1")
    return own.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequences."""
    return packing.packed(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]

#: Hash buckets, dictionaries, signatures and token ids have no SQL; the tests follow each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
