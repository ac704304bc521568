"""The given tables as the inputs this library expects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.dates import date_text, time_of, tick_of
from cadenza.spec import DAILY, HOURLY


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """Events as raw detector rows: all text, some hours and volumes unreadable."""
    e = table(spark, sf_dir, "events")
    bad_hour = F.col("event_id") % 97 == 0
    late_hour = F.col("event_id") % 89 == 0
    bad_volume = F.col("event_id") % 83 == 0
    return e.select(
        *(["event_id"] if with_id else []),
        F.concat("event_type", F.lit("-"), F.col("user_id") % 10).alias("spot_num"),
        date_text(F.col("ts"), "yyyyMMdd").alias("ymd"),
        F.when(bad_hour, "x").when(late_hour, "24").otherwise(F.hour("ts").cast("string")).alias("hh"),
        (F.col("user_id") % 4).cast("string").alias("lane_num"),
        (F.col("user_id") % 2).cast("string").alias("io_type"),
        F.when(bad_hour | late_hour, F.col("value").cast("string"))
        .when(bad_volume, "").otherwise(F.col("value").cast("string")).alias("vol"),
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as one weather station: each event type is one instrument.

    The time is unreadable in hours without errors, and a value is missing where
    its instrument sent nothing. One header has blanks around it.
    """
    e = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    turn = F.get_json_object("props", "$.k").cast("bigint")
    hours = e.withColumn("hour", time_of(tick_of(F.col("ts"), 3600), 3600)).groupBy("hour").agg(
        F.avg(F.when(kind == "view", F.col("value"))).alias("temp"),
        F.sum(F.when(kind == "signup", F.col("value"))).alias("rain"),
        (F.sum(F.when(kind == "click", turn)) % 360).alias("turn"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(kind == "error").alias("errors"),
    )
    return hours.select(
        F.when(F.col("errors") == 0, "?").otherwise(date_text(F.col("hour"), "yyyy-MM-dd HH:mm")).alias("일시"),
        F.col("temp").cast("string").alias(" 기온(°C) "),
        F.col("rain").cast("string").alias("강수량(mm)"),
        F.col("turn").cast("string").alias("풍향(16방위)"),
        F.col("n").cast("string").alias("습도(%)"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped quantity per supplier and day."""
    return table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias(DAILY.key), F.col("l_shipdate").alias(DAILY.time),
    ).agg(F.sum("l_quantity").alias(DAILY.value))


def spots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as spots with plane coordinates."""
    number = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        number.cast("string").alias(HOURLY.key),
        F.col("s_name").alias("spot_nm"),
        (190000 + (number * 137) % 20000).cast("double").alias("grs80tm_x"),
        (440000 + (number * 211) % 20000).cast("double").alias("grs80tm_y"),
    )
