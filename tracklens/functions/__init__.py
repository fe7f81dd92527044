"""Native Column expressions (no Python UDFs): geometry, grid keys, scoring."""

from tracklens.functions.geo import (
    circular_diff,
    grid_index,
    haversine_nm,
    lat_margin_deg,
    lon_margin_deg,
    time_bucket,
)

__all__ = [
    "circular_diff",
    "grid_index",
    "haversine_nm",
    "lat_margin_deg",
    "lon_margin_deg",
    "time_bucket",
]
