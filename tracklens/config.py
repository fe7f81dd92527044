"""Run parameters as frozen dataclasses.

All thresholds are parameters; the defaults are the fixed values the
results must agree with.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

# --- Fixed values (defaults that must match the expected results) ----------
# Search area: centre 55.225 N, 14.245 E, radius 50 nm.
# Time window: 2021-12-01 00:00:00 to 2021-12-31 23:59:59 (inclusive, UTC).
# Stationary vessel: median SOG below 0.5 kn.  GPS noise: implied speed above 50 kn.
# Close approach: distance below 0.1 nm.  Grid cell 0.005 deg, time bucket 1 minute.
# Moving ping for pairing: SOG above 0.5 kn.  Converging: closing speed above 0.5 kn.
# Candidates kept per vessel pair: 3.
# Silence: gap from event to last ping in [0, 120) s; last ping must be more than
# 43200 s before the dataset end.  Reaction window: 120 s before / after.
# Trajectory window: 600 s either side.  Report: top 5 pairs.
# Earth radius 3440.065 nm; 1852 m per nm.
# Score caps: COG change 180, divergence 180, SOG drop 20, closing speed 30.
# Score weights: silence 320 for one vessel, +30 for two, up to +20 for a quick
# silence (linear over 120 s); SOG drop x8, COG change x0.4, divergence x0.3,
# closing speed x3; no-reaction penalty (1 - drop) x10 below 1 kn; distance
# penalty 2 per 100 m above 100 m; density penalty 3 per vessel above 2.
# MMSI prefix excluded: "111" (search-and-rescue aircraft).
# Transponder class kept: "Class A".
EARTH_RADIUS_NM = 3440.065
METRES_PER_NM = 1852.0
NO_SILENCE_S = 999999  # sentinel for "no silent vessel"


@dataclass(frozen=True)
class ScoreWeights:
    silence_one: float = 320.0
    silence_two_extra: float = 30.0
    quick_silence_max: float = 20.0
    sog_drop: float = 8.0
    cog_change: float = 0.4
    divergence: float = 0.3
    closing_speed: float = 3.0
    no_reaction: float = 10.0
    no_reaction_below_kn: float = 1.0
    distance_free_m: float = 100.0
    distance_per_100m: float = 2.0
    density_free: float = 2.0
    density_per_vessel: float = 3.0
    cap_cog_change: float = 180.0
    cap_divergence: float = 180.0
    cap_sog_drop: float = 20.0
    cap_closing_speed: float = 30.0


@dataclass(frozen=True)
class EncounterConfig:
    center_lat: float = 55.225
    center_lon: float = 14.245
    radius_nm: float = 50.0
    start_date: str = "2021-12-01"
    end_date: str = "2021-12-31"
    min_median_sog_kn: float = 0.5
    max_implied_speed_kn: float = 50.0
    close_distance_nm: float = 0.1
    grid_cell_deg: float = 0.005
    time_bucket_s: int = 60
    moving_sog_kn: float = 0.5
    min_closing_speed_kn: float = 0.5
    candidates_per_pair: int = 3
    silence_window_s: int = 120
    end_buffer_s: int = 43200
    reaction_window_s: int = 120
    trajectory_window_s: int = 600
    top_k_pairs: int = 5
    mobile_class: str = "Class A"
    excluded_mmsi_prefix: str = "111"
    # Scale knobs (do not change results): tracks are split into chunks of this
    # many seconds so one busy vessel never lands in a single task.
    track_chunk_s: int = 3600
    # Ping-pair search grid, as a multiple of the close distance.  Larger cells
    # replicate fewer pings across borders; smaller cells compare fewer pairs.
    join_cell_factor: float = 4.0
    # Copies a cell-minute is split into for the pair join: side B is dealt to one
    # of them by vessel, side A is copied to all.  1: not split.  Raise it where
    # single cell-minutes hold tens of thousands of pings (the join compares
    # their square); each step costs one more copy of the moving pings.
    cell_salts: int = 1
    # The adaptive pair join quarters a cell-minute, up to this many times, while
    # one side has more pings in it, and deals what is left into shares.
    max_cell_pings: int = 2048
    max_cell_depth: int = 4
    # Buckets of the materialised track tables (None: spark.sql.shuffle.partitions).
    # Size so one bucket of clean tracks fits a task comfortably.
    track_buckets: int | None = None
    weights: ScoreWeights = field(default_factory=ScoreWeights)

    # --- derived values ----------------------------------------------------
    @property
    def start_unix(self) -> int:
        return _day_start_unix(self.start_date)

    @property
    def end_unix(self) -> int:
        return _day_start_unix(self.end_date) + 86399

    @property
    def lat_margin_deg(self) -> float:
        """At least the circle's angular radius (a degree is 60 nm or a little more here)."""
        return max(self.radius_nm / 60.0, math.degrees(self.radius_nm / EARTH_RADIUS_NM))

    @property
    def lon_margin_deg(self) -> float:
        """At least the circle's largest longitude difference,
        asin(sin(radius) / cos(centre)); the flat-earth margin where it is wider."""
        cos = math.cos(math.radians(self.center_lat))
        widest = math.sin(self.radius_nm / EARTH_RADIUS_NM) / cos if cos > 0 else 1.0
        return max(self.radius_nm / (60.0 * cos), math.degrees(math.asin(min(1.0, widest)))) if widest < 1 else 180.0

    @property
    def max_abs_lat(self) -> float:
        """Largest |latitude| a ping inside the search circle can have."""
        return min(90.0, abs(self.center_lat) + self.lat_margin_deg + 1e-9)

    def validate(self) -> "EncounterConfig":
        if abs(self.center_lat) + self.lat_margin_deg > 90 or abs(self.center_lon) + self.lon_margin_deg > 180:
            raise ValueError("the search circle reaches a pole or the antimeridian; split the area")
        # The 3x3 neighbourhood of the density grid only covers the close
        # distance while a cell is at least that wide at the highest latitude.
        cell_nm = self.grid_cell_deg * 60.0 * math.cos(math.radians(self.max_abs_lat))
        if cell_nm < self.close_distance_nm:
            raise ValueError(
                f"grid cell {self.grid_cell_deg} deg is {cell_nm:.4f} nm wide at "
                f"lat {self.max_abs_lat:.2f}, below the close distance {self.close_distance_nm} nm"
            )
        if self.cell_salts < 1:
            raise ValueError("cell_salts must be >= 1")
        if self.max_cell_pings < 1 or not 0 <= self.max_cell_depth <= 8:
            raise ValueError("max_cell_pings must be >= 1 and max_cell_depth in 0..8")
        if self.join_cell_factor < 1.0:
            raise ValueError("join_cell_factor must be >= 1")
        if self.track_buckets is not None and self.track_buckets <= 0:
            raise ValueError("track_buckets must be positive")
        if self.track_chunk_s <= 0 or self.time_bucket_s <= 0:
            raise ValueError("chunk and bucket lengths must be positive")
        return self


def _day_start_unix(day: str) -> int:
    import datetime as _dt

    d = _dt.datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=_dt.timezone.utc)
    return int(d.timestamp())
