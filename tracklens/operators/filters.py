"""Row filters on pings.  All are plain predicates, so Catalyst merges them
into one Filter and pushes column comparisons into the Parquet scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.config import EncounterConfig
from tracklens.functions.geo import haversine_nm

_DEFAULT = EncounterConfig()


def is_valid() -> Column:
    """Non-null time, position and MMSI; lat/lon in range; not exactly (0, 0)."""
    lat, lon = F.col("lat"), F.col("lon")
    return (
        F.col("ts_unix").isNotNull()
        & lat.isNotNull()
        & lon.isNotNull()
        & F.col("mmsi").isNotNull()
        & lat.between(-90.0, 90.0)
        & lon.between(-180.0, 180.0)
        & ~((lat == 0.0) & (lon == 0.0))
    )


def valid_pings(df: DataFrame) -> DataFrame:
    return df.filter(is_valid())


def in_time(cfg: EncounterConfig) -> Column:
    return F.col("ts_unix").between(cfg.start_unix, cfg.end_unix)


def in_box(cfg: EncounterConfig) -> Column:
    lat, lon = F.col("lat"), F.col("lon")
    return lat.between(cfg.center_lat - cfg.lat_margin_deg, cfg.center_lat + cfg.lat_margin_deg) & lon.between(
        cfg.center_lon - cfg.lon_margin_deg, cfg.center_lon + cfg.lon_margin_deg
    )


def in_circle(cfg: EncounterConfig) -> Column:
    return haversine_nm(cfg.center_lat, cfg.center_lon, "lat", "lon") <= cfg.radius_nm


def in_class(cfg: EncounterConfig) -> Column:
    return F.col("mobile_type") == cfg.mobile_class


def not_excluded(cfg: EncounterConfig) -> Column:
    return ~F.col("mmsi").cast("string").startswith(cfg.excluded_mmsi_prefix)


def time_window(df: DataFrame, cfg: EncounterConfig = _DEFAULT, day_column: str | None = None) -> DataFrame:
    """Pings between start 00:00:00 and end 23:59:59 UTC, inclusive.  Name the
    UTC day column of a day-partitioned store (``store.DAY_COLUMN``) as
    ``day_column`` to prune its directories; no column is used unasked."""
    out = df.filter(in_time(cfg))
    if day_column is not None:
        days = [F.lit(x).cast("date") for x in (cfg.start_date, cfg.end_date)]
        out = out.filter(F.col(day_column).between(*days))
    return out


def bbox_filter(df: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """Cheap rectangular prefilter that contains the search circle (pushable)."""
    return df.filter(in_box(cfg))


def radius_filter(df: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """Great-circle distance to the centre at most the radius (inclusive)."""
    return df.filter(in_circle(cfg))


def within_radius(df: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    return radius_filter(bbox_filter(df, cfg), cfg)


def class_filter(df: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """Keep one transponder class (exact, case-sensitive; null dropped)."""
    return df.filter(in_class(cfg))


def exclude_mmsi_prefix(df: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """Drop MMSIs whose decimal text starts with the prefix (SAR aircraft)."""
    return df.filter(not_excluded(cfg))


def moving_pings(df: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """Pings with SOG strictly above the pairing threshold (null dropped)."""
    return df.filter(F.col("sog") > cfg.moving_sog_kn)


def select_pings(df: DataFrame, cfg: EncounterConfig = _DEFAULT, day_column: str | None = None) -> DataFrame:
    """valid -> time window -> area -> class -> prefix, cheapest first."""
    return (
        valid_pings(df)
        .transform(lambda d: time_window(d, cfg, day_column))
        .transform(lambda d: within_radius(d, cfg))
        .transform(lambda d: class_filter(d, cfg))
        .transform(lambda d: exclude_mmsi_prefix(d, cfg))
    )


STAGES = ("raw", "valid", "time_window", "bbox", "radius", "class_a", "not_sar")


def stage_reached(df: DataFrame, cfg: EncounterConfig = _DEFAULT) -> DataFrame:
    """mmsi, stage: the index in ``STAGES`` of the last filter each ping passes."""
    stage = F.lit(len(STAGES) - 1)
    conds = (is_valid(), in_time(cfg), in_box(cfg), in_circle(cfg), in_class(cfg), not_excluded(cfg))
    for i, passes in reversed(list(enumerate(conds))):
        stage = F.when(passes, stage).otherwise(F.lit(i))
    return df.select("mmsi", stage.alias("stage"))
