"""Projection, coercion and filtering of messy columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import numeric

# Column name candidates of raw history files.
HISTORY_NAMES = {
    "spot_num": ["spot_num", "SPOT_NUM", "spotNo", "spot_id"],
    "ymd": ["ymd", "YMD", "date"],
    "hh": ["hh", "HH", "hour"],
    "vol": ["vol", "VOL", "volume", "traffic"],
}

# Headers of the weather files and their names here.
WEATHER_NAMES = {
    "기온(°C)": "temp_c",
    "강수량(mm)": "rain_mm",
    "풍속(m/s)": "wind_ms",
    "풍향(16방위)": "wind_dir_deg",
    "습도(%)": "humidity_pct",
    "현지기압(hPa)": "pressure_hpa",
    "일조(hr)": "sunshine_hr",
    "적설(cm)": "snow_cm",
    "3시간신적설(cm)": "snow3h_cm",
    "전운량(10분위)": "cloud_total_10",
    "중하층운량(10분위)": "cloud_midlow_10",
    "지면상태(지면상태코드)": "ground_state",
    "지면온도(°C)": "ground_temp_c",
}
WEATHER_TIME = "일시"

# Order of the weather columns in a panel.
WEATHER_COLUMNS = [
    "temp_c", "rain_mm", "wind_ms", "wind_dir_deg", "wind_dir_sin", "wind_dir_cos",
    "humidity_pct", "pressure_hpa", "sunshine_hr", "snow_cm", "snow3h_cm",
    "cloud_total_10", "cloud_midlow_10", "ground_state", "ground_temp_c",
]

# Weather columns where missing means none.
ZERO_WHEN_MISSING = ["rain_mm", "snow_cm", "snow3h_cm"]


def rename_first(df: DataFrame, candidates: list[str], target: str, required: bool = True) -> DataFrame:
    """Rename the first candidate present; none present is an error only if required."""
    for name in candidates:
        if name in df.columns:
            return df.withColumnRenamed(name, target)
    if required:
        raise ValueError(f"no column for {target!r} among {candidates}; have {df.columns}")
    return df


def standard_history(df: DataFrame) -> DataFrame:
    """Bring history files with differing headers to the standard names."""
    for target, candidates in HISTORY_NAMES.items():
        df = rename_first(df, candidates, target)
    return df


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename_known(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Trim headers and rename those which are known."""
    return trim_headers(df).withColumnsRenamed(names)


def to_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Coerce the listed columns which exist; unparsable text becomes missing."""
    return df.withColumns({c: numeric(df, c) for c in columns if c in df.columns})


def keep_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*[c for c in columns if c in df.columns])


def drop_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def fill_constant(df: DataFrame, columns: list[str], value: float = 0.0) -> DataFrame:
    return df.fillna(value, subset=[c for c in columns if c in df.columns])


def matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Rows whose text contains the pattern."""
    return df.where(F.col(column).rlike(pattern))


def where_equal(df: DataFrame, column: str, value) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def where_in(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.where(F.col(column).isin(list(values)))


def align_features(df: DataFrame, expected: list[str]) -> dict[str, Column]:
    """The columns a model expects, in its order: absent or unusable values are 0."""
    return {
        c: F.coalesce(numeric(df, c), F.lit(0.0)) if c in df.columns else F.lit(0.0)
        for c in expected
    }


def require_same_features(first: list[str], second: list[str]) -> None:
    if list(first) != list(second):
        raise ValueError(f"feature lists differ: {first} / {second}")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df
