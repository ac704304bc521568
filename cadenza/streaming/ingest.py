"""Resumable ingest of stored responses, and the work still to be fetched."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cadenza.functions.dates import day_series, parse_ymd
from cadenza.sources.payloads import parse_payloads, volume_rows

REQUEST_SCHEMA = "spot_num STRING, ymd STRING, hh STRING, start BIGINT, payload STRING"
UNIT = ["spot_num", "ymd", "hh"]
PLACE = [*UNIT, "row_no"]
DELIVERY = ["delivered", "delivery"]


def parse_hours(text: str) -> list[int]:
    """"0-23", "0,6,12" or "7" as a list of hours."""
    if "-" in text:
        first, last = text.split("-", 1)
        return list(range(int(first), int(last) + 1))
    return [int(part) for part in text.split(",") if part.strip()]


def pending_work(
    spots: DataFrame,
    start_ymd: str,
    end_ymd: str,
    hours: str = "0-23",
    done: DataFrame | None = None,
    only: list[str] | None = None,
    first_spots: int | None = None,
) -> DataFrame:
    """Every (spot, day, hour) of the request that is not done yet.

    Days and hours are expanded on each spot row, so no join makes the product.
    ``first_spots`` is the collector's own option to start with a few spots.
    """
    keys = spots.select(F.col("spot_num").cast("string").alias("spot_num")).distinct()
    if only:
        keys = keys.where(F.col("spot_num").isin(only))
    if first_spots is not None:
        keys = keys.orderBy("spot_num").limit(first_spots)
    days = day_series(parse_ymd(F.lit(start_ymd)), parse_ymd(F.lit(end_ymd)))
    clock = F.array(*[F.lit(f"{h:02d}") for h in parse_hours(hours)])
    units = keys.select("spot_num", F.explode(days).alias("_day")).select(
        "spot_num", F.date_format("_day", "yyyyMMdd").alias("ymd"), F.explode(clock).alias("hh"))
    return units if done is None else units.join(done.select(*UNIT).distinct(), UNIT, "left_anti")


def _write_batch(sink: str, checkpoint: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        # The query's own id: a fresh checkpoint starts at batch 0 again and must not touch earlier folders.
        first = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()
        query = json.loads(first.value)["id"]
        parsed = parse_payloads(batch).persist()
        rows = volume_rows(parsed, carry=DELIVERY)
        units = parsed.select(*UNIT, F.col("code"), F.col("error"), F.size("rows").alias("n_rows"))
        # A repeated batch overwrites its own folder, so a crash leaves no copies.
        rows.write.mode("overwrite").parquet(f"{sink}/rows/query_id={query}/batch_id={batch_id}")
        units.write.mode("overwrite").parquet(f"{sink}/units/query_id={query}/batch_id={batch_id}")
        parsed.unpersist()

    return write


def ingest(
    spark: SparkSession, source: str, sink: str, checkpoint: str, fmt: str = "parquet", files_per_batch: int = 1000,
) -> StreamingQuery:
    """Read responses which arrived since the last run, then stop.

    Progress is the stream's checkpoint. Rows and completed units are written
    per batch.
    """
    stream = (
        spark.readStream.schema(REQUEST_SCHEMA).option("maxFilesPerTrigger", files_per_batch).format(fmt).load(source)
        .select("*", F.col("_metadata.file_modification_time").alias(DELIVERY[0]), F.col("_metadata.file_path").alias(DELIVERY[1]))
    )
    query = (
        stream.writeStream.foreachBatch(_write_batch(sink, checkpoint))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def completed_units(spark: SparkSession, sink: str) -> DataFrame:
    """Units with a readable response. Those with broken responses only are still to be fetched."""
    return spark.read.parquet(f"{sink}/units").where("error IS NULL")


def ingested_rows(spark: SparkSession, sink: str) -> DataFrame:
    """One row per place in the answer to a request: that of the newest delivery, by file time and then file name."""
    rows = spark.read.parquet(f"{sink}/rows").drop("query_id", "batch_id").withColumn("extra", F.to_json("extra"))
    others = [c for c in rows.columns if c not in (*PLACE, *DELIVERY)]
    newest = rows.groupBy(*PLACE).agg(F.max_by(F.struct(*others), F.struct(*DELIVERY)).alias("_newest"))
    return newest.select(*PLACE, "_newest.*").select(*[c for c in rows.columns if c not in DELIVERY])


def progress(units: DataFrame) -> DataFrame:
    """Calls and rows so far."""
    return units.agg(
        F.count(F.lit(1)).alias("total_calls"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"))
