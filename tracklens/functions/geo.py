"""Geometry as Column expressions; everything stays inside whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tracklens.config import EARTH_RADIUS_NM


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def _operand(x) -> str:
    """SQL text of a column name or a number."""
    return f"`{x}`" if isinstance(x, str) else f"{float(x)!r}D"


def haversine_nm(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in nautical miles between two points given by
    column names or numbers: 2 R asin(sqrt(h)) with h the haversine of the
    central angle.  ``greatest`` skips nulls, so a null input yields 0.0, not
    null; callers that need null semantics guard with ``when``.  ``least`` only
    matters at antipodes, where rounding could push h above 1."""
    hav = "pow(sin(radians({0}) / 2), 2)".format
    p1, l1, p2, l2 = map(_operand, (lat1, lon1, lat2, lon2))
    h = f"{hav(f'{p2} - {p1}')} + cos(radians({p1})) * cos(radians({p2})) * {hav(f'{l2} - {l1}')}"
    return F.expr(f"2 * {EARTH_RADIUS_NM!r}D * asin(sqrt(least(1.0D, greatest(0.0D, {h}))))")


def circular_diff(x, y) -> Column:
    """Smallest angle between two headings in degrees, in [0, 180]; null if
    either heading is."""
    d = F.abs(_c(x) - _c(y))
    return F.least(d, F.lit(360.0) - d)


def grid_index(deg, cell_deg: float) -> Column:
    """Integer cell index ``floor(deg / cell)``."""
    return F.floor(_c(deg) / F.lit(float(cell_deg))).cast("int")


def time_bucket(ts_unix, bucket_s: int) -> Column:
    """Bucket number ``long(ts / bucket)`` (truncation toward zero)."""
    return (_c(ts_unix) / F.lit(int(bucket_s))).cast("long")


def utc_day(ts_unix: Column) -> Column:
    """UTC date of epoch seconds, whatever the session's time zone."""
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ts_unix / 86400).cast("int"))


# --- search-grid margins ----------------------------------------------------
# A pair closer than D nm differs by less than D/R radians in latitude, and by
# less than 2*asin(sin(D/2R) / sqrt(cos(phi1) * cos(|phi1| + D/R))) in
# longitude (from the haversine formula with cos(phi2) >= cos(|phi1| + D/R)).
_SAFETY = 1.0 + 1e-6


def angular_radius_rad(distance_nm: float) -> float:
    return distance_nm / EARTH_RADIUS_NM


def lat_margin_deg(distance_nm: float) -> float:
    return math.degrees(angular_radius_rad(distance_nm)) * _SAFETY + 1e-12


def lon_margin_deg_at(lat_deg: float, distance_nm: float) -> float:
    """Python twin of :func:`lon_margin_deg` for one latitude."""
    d = angular_radius_rad(distance_nm)
    phi = math.radians(min(90.0, abs(lat_deg)))
    c = math.cos(phi) * math.cos(min(math.pi / 2, phi + d))
    if c <= 0:
        return 180.0
    s = min(1.0, math.sin(d / 2) / math.sqrt(c))
    return min(180.0, math.degrees(2 * math.asin(s)) * _SAFETY + 1e-12)


def lon_margin_deg(lat, distance_nm: float) -> Column:
    """Per-row longitude margin (degrees) that contains every point closer than D."""
    d = angular_radius_rad(distance_nm)
    phi = F.radians(F.abs(_c(lat)))
    c = F.cos(phi) * F.cos(F.least(F.lit(math.pi / 2), phi + F.lit(d)))
    s = F.least(F.lit(1.0), F.lit(math.sin(d / 2)) / F.sqrt(F.greatest(c, F.lit(1e-300))))
    return F.least(F.lit(180.0), F.degrees(2 * F.asin(s)) * F.lit(_SAFETY) + F.lit(1e-12))
