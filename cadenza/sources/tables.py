"""History, panel, metrics and record files."""

from __future__ import annotations

import csv
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.dates import parse_time
from cadenza.functions.text import numeric
from cadenza.operators.clean import require_columns, trim_headers
from cadenza.operators.sets import stack
from cadenza.spec import HOURLY, PanelSpec

# Encodings tried in this order; MS949 also covers EUC-KR.
UNICODE = "UTF-8"
KOREAN = "MS949"
REPLACEMENT = "�"


def allow_korean(spark: SparkSession) -> None:
    """Let the session read and write MS949; scans need it whenever they run, so it stays on."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")


@dataclass(frozen=True)
class CsvLayout:
    """Files that share an encoding and a header line."""

    encoding: str
    header: bytes
    files: list[str]

    def names(self) -> list[str] | None:
        """Column names as written; None if they are blank or repeated, so that the reader must invent some."""
        names = next(csv.reader([self.header.decode(self.encoding)]))
        known = {c.strip().lower() for c in names}
        return names if len(known) == len(names) and "" not in known else None


def csv_layouts(spark: SparkSession, pattern: str, encoding: str | None = None) -> list[CsvLayout]:
    """The files of a pattern by encoding and header, found in one pass over their lines.

    The encoding is the first one that decodes every line of the file, the header its first line that is not blank.
    Both are combined per file where lines are read, and files per layout before anything reaches the driver, which
    gets the distinct headers and the file names each scan is given. Files without a line are left out; one that fits
    no encoding is an error.
    """
    allow_korean(spark)
    # While checking, undecodable bytes become a mark instead of an error.
    lenient = "spark.sql.legacy.codingErrorAction"
    before = spark.conf.get(lenient)
    spark.conf.set(lenient, "true")
    try:
        lines = spark.read.text(pattern).select(
            F.col("_metadata.file_path").alias("file"), "value",
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
        written = F.trim("value") != ""
        charset = F.lit(encoding)
        if not encoding:
            korean = ~F.contains(F.decode(F.col("value").cast("binary"), KOREAN), F.lit(REPLACEMENT))
            charset = F.when(F.bool_and(F.is_valid_utf8("value")), UNICODE).when(F.bool_and(korean), KOREAN)
        by_file = lines.groupBy("file").agg(
            charset.alias("encoding"),
            F.min_by(F.when(written, F.col("value").cast("binary")), F.when(written, F.col("at"))).alias("header"))
        found = by_file.groupBy("encoding", "header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    finally:
        spark.conf.set(lenient, before)
    layouts = []
    for row in found:
        if row.encoding is None:
            raise UnicodeError(f"{row.files[0]}: neither {UNICODE} nor {KOREAN}")
        if row.header is not None:
            layouts.append(CsvLayout(row.encoding, bytes(row.header), [_literal(f) for f in row.files]))
    if not layouts:
        raise FileNotFoundError(f"no file with lines matches {pattern}")
    return sorted(layouts, key=lambda x: x.files[0])


def _literal(url: str) -> str:
    """The path of a file's address, its wildcards escaped."""
    return re.sub(r"([*?{}\[\]\\])", r"\\\1", unquote(url))


def read_csv(
    spark: SparkSession,
    pattern: str,
    schema: T.StructType | str | None = None,
    provenance: str | None = None,
    encoding: str | None = None,
) -> DataFrame:
    """All CSV files of a pattern as text columns with trimmed headers, whatever their encoding and order of columns.

    Columns are matched by name: there is one scan per distinct header, and Spark compares each file with the header
    of its scan again when it reads. A column that a file lacks is null there. ``schema`` chooses and types the
    columns, also by name. ``provenance`` names a column for the file name. Finding the layouts reads every file once
    more.
    """
    origin = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    frames = []
    for layout in csv_layouts(spark, pattern, encoding):
        reader = spark.read.option("header", True).option("encoding", layout.encoding)
        names = layout.names()
        if names:
            types = {f.name: f.dataType for f in wanted or []}
            fields = [T.StructField(c, types.get(c.strip(), T.StringType())) for c in names]
            reader = reader.schema(T.StructType(fields)).option("enforceSchema", False)
        frame = trim_headers(reader.csv(layout.files))
        if wanted:
            frame = frame.select(*[
                (F.col(f"`{f.name}`") if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in wanted],
                *([origin.alias(provenance)] if provenance else []))
        elif provenance:
            frame = frame.select("*", origin.alias(provenance))
        frames.append(frame)
    return stack(frames)


def read_history(spark: SparkSession, pattern: str, encoding: str | None = None) -> DataFrame:
    """Raw history files, matched by column name; every column is text, with ``source_file``."""
    return read_csv(spark, pattern, provenance="source_file", encoding=encoding)


def as_panel(df: DataFrame, spec: PanelSpec = HOURLY) -> DataFrame:
    """Typed panel columns: text key, local time, numeric rest."""
    require_columns(df, [spec.key, spec.time])
    columns = {spec.key: F.col(spec.key).cast("string")}
    if isinstance(df.schema[spec.time].dataType, T.StringType):
        columns[spec.time] = parse_time(F.col(spec.time))
    else:
        columns[spec.time] = F.col(spec.time).cast("timestamp_ntz")
    for c in df.columns:
        if c not in (spec.key, spec.time):
            columns[c] = numeric(df, c)
    return df.select(*[value.alias(c) for c, value in columns.items()])


def read_panel(spark: SparkSession, path: str, fmt: str = "parquet", spec: PanelSpec = HOURLY) -> DataFrame:
    """A stored panel. No order is imposed: each ordered operator names its own."""
    raw = spark.read.parquet(path) if fmt == "parquet" else spark.read.option("header", True).csv(path)
    return as_panel(raw, spec)


def write_panel(panel: DataFrame, path: str, spec: PanelSpec = HOURLY, by: list[str] | None = None) -> None:
    """A panel as Parquet, in ranges of (key, time): a filter on either skips files and
    row groups, and a dominant series spreads over several files."""
    ordered = panel.repartitionByRange(spec.key, spec.time).sortWithinPartitions(spec.key, spec.time)
    writer = ordered.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def append_history(rows: DataFrame, path: str) -> None:
    """Add rows to the history table, one folder per day."""
    rows.write.mode("append").partitionBy("ymd").parquet(path)


def read_metrics(spark: SparkSession, pattern: str) -> DataFrame:
    """Metrics files with trimmed headers, numbers coerced, and ``metrics_file``."""
    frame = read_csv(spark, pattern, provenance="metrics_file")
    require_columns(frame, ["model"])
    numbers = [c for c in frame.columns if c not in ("model", "metrics_file")]
    return frame.withColumns({"model": F.col("model").cast("string"), **{c: numeric(frame, c) for c in numbers}})


def write_report(df: DataFrame, path: str) -> None:
    """A small result as one CSV file with a header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_records(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_records(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """JSON records, one per line or one indented object per file."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)
