"""Stored XML responses of the open-data service as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import text_to_number

# Response codes and layout of the service.
OK_CODE = "INFO-000"
SNIPPET = 200
# All leaves are text: one badly typed leaf would null the ones after it.
PAYLOAD_SCHEMA = (
    "list_total_count STRING, RESULT STRUCT<CODE: STRING, MESSAGE: STRING>, "
    "row ARRAY<MAP<STRING, STRING>>, _corrupt_record STRING"
)
VOLUME_FIELDS = ["spot_num", "ymd", "hh", "lane_num", "io_type", "vol"]


def parse_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``service, total_count, code, message, rows, error`` to stored responses.

    ``rows`` has one map (tag to trimmed text) per row element. A response that
    is no XML has an ``error`` with its first characters and no rows.
    """
    parsed = df.withColumn("_p", F.from_xml(F.col(payload), PAYLOAD_SCHEMA, {"mode": "PERMISSIVE"}))
    text = F.col(payload)
    broken = F.col("_p").isNull() | F.col("_p._corrupt_record").isNotNull()
    rows = F.transform(
        F.coalesce(F.col("_p.row"), F.array()),
        lambda r: F.transform_values(r, lambda _, v: F.coalesce(F.trim(v), F.lit(""))))
    return parsed.select(
        *df.columns,
        F.nullif(F.regexp_extract(text, r"<([A-Za-z_][\w.\-]*)", 1), F.lit("")).alias("service"),
        F.trim(F.col("_p.list_total_count")).try_cast("int").alias("total_count"),
        F.trim(F.col("_p.RESULT.CODE")).alias("code"),
        F.trim(F.col("_p.RESULT.MESSAGE")).alias("message"),
        F.when(broken, F.array().cast("array<map<string,string>>")).otherwise(rows).alias("rows"),
        F.when(broken, F.translate(F.left(text, F.lit(SNIPPET)), "\n", " ")).alias("error"),
    )


def quarantined(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("error").isNotNull())


def _field(name: str) -> Column:
    return F.col("_row")[name]


def volume_rows(parsed: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """Detector rows of volume responses; a response with an error code has none.

    ``spot_num, ymd, hh`` come from the request where the row lacks them; hour,
    lane and volume are coerced; tags without a column stay in ``extra``.
    ``row_no`` is the place in the answer to the request: a long answer comes in
    several responses, each with the ``start`` index of its first row. Columns
    named by ``carry`` are kept.
    """
    fine = parsed.where(F.col("code").isNull() | (F.col("code") == OK_CODE))
    rows = fine.select(
        "spot_num", "ymd", "hh", F.coalesce("start", F.lit(1)).alias("_start"), *(carry or []),
        F.posexplode("rows").alias("_place", "_row"))
    extra = F.map_filter("_row", lambda k, _: ~k.isin(VOLUME_FIELDS))
    return rows.select(
        F.coalesce(_field("spot_num"), F.col("spot_num")).alias("spot_num"),
        F.coalesce(_field("ymd"), F.col("ymd")).alias("ymd"),
        text_to_number(F.coalesce(_field("hh"), F.col("hh"))).alias("hh"),
        text_to_number(_field("lane_num")).alias("lane_num"),
        _field("io_type").alias("io_type"),
        text_to_number(_field("vol")).alias("vol"),
        (F.col("_start") + F.col("_place")).alias("row_no"), extra.alias("extra"), *(carry or []))


def spot_rows(parsed: DataFrame) -> DataFrame:
    """Spots of spot responses; an error code is an error here."""
    bad = F.col("code").isNotNull() & (F.col("code") != OK_CODE)
    message = F.concat_ws(" / ", F.lit("spot response"), "code", "message")
    checked = parsed.withColumn(
        "rows", F.when(bad, F.raise_error(message).cast("array<map<string,string>>")).otherwise(F.col("rows")))
    return checked.select(F.explode("rows").alias("_row")).select(
        _field("spot_num").alias("spot_num"), _field("spot_nm").alias("spot_nm"),
        text_to_number(_field("grs80tm_x")).alias("grs80tm_x"),
        text_to_number(_field("grs80tm_y")).alias("grs80tm_y"))
