"""Small helpers that the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import materialize

#: White space that separates words; every other character belongs to a word.
WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written once to the shared folder and read back: lineage ends, lost executors cost no recomputation."""
    return materialize(df, f"llm-{label}")


def words_of(text: Column) -> Column:
    """Words of a text as an array; no words for null and blank texts."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))
