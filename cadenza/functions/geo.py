"""Plane transverse Mercator coordinates to longitude and latitude."""

from __future__ import annotations

from math import radians, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import numeric

# GRS80 ellipsoid and the Korean central belt.
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
ORIGIN_LON = 127.0
ORIGIN_LAT = 38.0
FALSE_EASTING = 200000.0
FALSE_NORTHING = 500000.0

X_NAMES = ["grs80tm_x", "x", "tm_x", "TM_X", "X"]
Y_NAMES = ["grs80tm_y", "y", "tm_y", "TM_Y", "Y"]


def _series_terms() -> dict[str, float]:
    f = 1 / INVERSE_FLATTENING
    e2 = f * (2 - f)
    root = sqrt(1 - e2)
    e1 = (1 - root) / (1 + root)
    return {
        "e2": e2,
        "ep2": e2 / (1 - e2),
        "m_scale": SEMI_MAJOR * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256),
        "s2": 3 * e1 / 2 - 27 * e1**3 / 32,
        "s4": 21 * e1**2 / 16 - 55 * e1**4 / 32,
        "s6": 151 * e1**3 / 96,
        "s8": 1097 * e1**4 / 512,
    }


def _meridian_arc(lat: float) -> float:
    from math import sin

    e2 = _series_terms()["e2"]
    return SEMI_MAJOR * (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * lat
        - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * sin(2 * lat)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * sin(4 * lat)
        - (35 * e2**3 / 3072) * sin(6 * lat)
    )


def plane_to_lonlat(x: Column, y: Column, false_northing: float = FALSE_NORTHING) -> tuple[Column, Column]:
    """Inverse transverse Mercator by the usual footpoint-latitude series (scale 1)."""
    k = _series_terms()
    arc = F.lit(_meridian_arc(radians(ORIGIN_LAT))) + (y - F.lit(false_northing))
    mu = arc / F.lit(k["m_scale"])
    foot = (
        mu + k["s2"] * F.sin(2 * mu) + k["s4"] * F.sin(4 * mu)
        + k["s6"] * F.sin(6 * mu) + k["s8"] * F.sin(8 * mu)
    )
    sin_f, cos_f, tan_f = F.sin(foot), F.cos(foot), F.tan(foot)
    c = k["ep2"] * cos_f * cos_f
    t = tan_f * tan_f
    w = 1 - k["e2"] * sin_f * sin_f
    n = SEMI_MAJOR / F.sqrt(w)
    r = SEMI_MAJOR * (1 - k["e2"]) / (w * F.sqrt(w))
    d = (x - F.lit(FALSE_EASTING)) / n
    d2 = d * d
    lat = foot - (n * tan_f / r) * d2 * (
        0.5
        - (5 + 3 * t + 10 * c - 4 * c * c - 9 * k["ep2"]) * d2 / 24
        + (61 + 90 * t + 298 * c + 45 * t * t - 252 * k["ep2"] - 3 * c * c) * d2 * d2 / 720
    )
    lon = F.lit(radians(ORIGIN_LON)) + d * (
        1
        - (1 + 2 * t + c) * d2 / 6
        + (5 - 2 * c + 28 * t - 3 * c * c + 8 * k["ep2"] + 24 * t * t) * d2 * d2 / 120
    ) / cos_f
    return F.degrees(lon), F.degrees(lat)


def add_lonlat(df: DataFrame, false_northing: float = FALSE_NORTHING) -> DataFrame:
    """Add ``lon`` and ``lat`` from the first known pair of plane columns.

    Unparsable coordinates count as 0; without such columns nothing is added.
    """
    x_name = next((c for c in X_NAMES if c in df.columns), None)
    y_name = next((c for c in Y_NAMES if c in df.columns), None)
    if x_name is None or y_name is None:
        return df
    x = F.coalesce(numeric(df, x_name), F.lit(0.0))
    y = F.coalesce(numeric(df, y_name), F.lit(0.0))
    lon, lat = plane_to_lonlat(x, y, false_northing)
    return df.withColumns({"lon": lon, "lat": lat})
