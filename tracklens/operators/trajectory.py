"""Trajectories around events, polylines and the event report.

A window around an event is matched to the pings through (mmsi, track_chunk),
the pings' own partitioning: each window is expanded to the few chunks it
touches, so the pings are neither shuffled nor compared with other windows,
and nothing depends on the report being small enough to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.config import METRES_PER_NM, EncounterConfig
from tracklens.functions.geo import utc_day
from tracklens.operators.tracks import CHUNK, checked_chunks

_DEFAULT = EncounterConfig()
POINT_COLS = ("ts", "ts_unix", "lat", "lon", "sog", "cog")


def trajectory_one(pings: DataFrame, mmsi: int, center_unix: int, window_s: int = 600) -> DataFrame:
    """Pings of one vessel within +-window_s (inclusive), ordered by time."""
    cols = [c for c in POINT_COLS if c in pings.columns]
    return (
        pings.filter((F.col("mmsi") == int(mmsi)) & F.col("ts_unix").between(center_unix - window_s, center_unix + window_s))
        .orderBy("ts_unix")
        .select(*cols)
    )


def _in_windows(
    pings: DataFrame, windows: DataFrame, center: str, window_s: int, how: str, chunk_s: int, day_column: str | None = None
) -> DataFrame:
    """Join ``windows`` (mmsi, ``center``, ...) to the pings within
    +-window_s of the centre, by (mmsi, track_chunk).  With ``day_column``, the
    UTC day column of a day-partitioned store, the windows carry their days
    too, and the scan reads only those (dynamic partition pruning)."""
    if CHUNK in pings.columns:
        pings = checked_chunks(pings, chunk_s)
    else:
        pings = pings.withColumn(CHUNK, F.floor(F.col("ts_unix") / chunk_s))
    ends = [F.floor((F.col(center) + d) / chunk_s) for d in (-window_s, window_s)]
    w = windows.withColumn(CHUNK, F.explode(F.sequence(*ends))).withColumnsRenamed({"mmsi": "_m", CHUNK: "_chunk"})
    near = F.col("ts_unix").between(F.col(center) - window_s, F.col(center) + window_s)
    same = (F.col("mmsi") == F.col("_m")) & (F.col(CHUNK) == F.col("_chunk")) & near
    if day_column:
        days = [utc_day(F.col("_chunk") * chunk_s + d) for d in (0, chunk_s - 1)]  # of one chunk
        w = w.withColumn("_day", F.explode(F.sequence(*days)))
        same = same & (F.col(day_column) == F.col("_day"))
        # Pruning takes the days from a broadcast; windows are few: those of the top k pairs.
        w = F.broadcast(w)
    return pings.join(w, same, how).drop("_m", "_chunk", "_day")


def trajectory_around(pings: DataFrame, events: DataFrame, window_s: int = 600, chunk_s: int = _DEFAULT.track_chunk_s) -> DataFrame:
    """Pings of ``events.mmsi`` within +-window_s of ``events.center_unix``."""
    events = events.withColumnRenamed("center_unix", "_c")
    kept = [c for c in pings.columns if c != CHUNK]
    extra = [c for c in events.columns if c not in ("mmsi", "_c")]
    return _in_windows(pings, events, "_c", window_s, "inner", chunk_s).select(*kept, *extra)


def event_windows(top: DataFrame) -> DataFrame:
    """One row per (rank, side): vessel, the event time of the report (A's
    ping time) and the vessel's own ping time (its fetch centre)."""
    sides = F.array(
        *[
            F.struct(
                F.lit(s).alias("side"),
                F.col(f"mmsi_{s}").alias("mmsi"),
                display_name(f"name_{s}", f"mmsi_{s}").alias("vessel_label"),
                F.col("ts_unix_a").alias("event_unix"),
                F.col(f"ts_unix_{s}").alias("fetch_unix"),
            )
            for s in ("a", "b")
        ]
    )
    return top.select("rank", F.inline(sides))


def trajectories(pings: DataFrame, top: DataFrame, cfg: EncounterConfig = _DEFAULT, day_column: str | None = None) -> DataFrame:
    """Pings shown for every reported event: of the event's vessel, within
    +-window of the event time, and inside at least one fetch window
    (+-window around that vessel's own ping time in any reported event).
    Adds ``rank, side, phase`` ('before' if at or before the event time).
    ``day_column`` names the UTC day column of a day-partitioned store, of
    which then only the windows' days are read."""
    w = cfg.trajectory_window_s
    windows = event_windows(top).where(F.col("rank") <= cfg.top_k_pairs)
    fetch = windows.select("mmsi", F.col("fetch_unix").alias("_fc"))
    shown = windows.select("rank", "side", "mmsi", "vessel_label", "event_unix")
    cols = [c for c in ("mmsi", *POINT_COLS, CHUNK, day_column) if c in pings.columns]
    fetched = _in_windows(pings.select(*cols), fetch, "_fc", w, "left_semi", cfg.track_chunk_s, day_column)
    out = _in_windows(fetched, shown, "event_unix", w, "inner", cfg.track_chunk_s).drop(CHUNK, *([day_column] if day_column else []))
    return out.withColumn(
        "phase", F.when(F.col("ts_unix") <= F.col("event_unix"), F.lit("before")).otherwise(F.lit("after"))
    )


def trajectory_lines(traj: DataFrame) -> DataFrame:
    """Per (rank, side): time-ordered polylines before and after the event
    (a line needs at least two points), the START point (first point before)
    and the END point (last point overall).  A group holds one vessel's pings
    of a bounded time window, so collecting it is bounded."""
    pt = F.struct("ts_unix", "lat", "lon")
    g = traj.groupBy("rank", "side", "mmsi", "vessel_label", "event_unix").agg(
        F.array_sort(F.collect_list(F.when(F.col("phase") == "before", pt))).alias("before"),
        F.array_sort(F.collect_list(F.when(F.col("phase") == "after", pt))).alias("after"),
        F.min_by(pt, F.when(F.col("phase") == "before", F.col("ts_unix"))).alias("_start"),
        F.max_by(pt, F.col("ts_unix")).alias("_end"),
    )
    return g.select(
        "rank",
        "side",
        "mmsi",
        "vessel_label",
        "event_unix",
        F.size("before").alias("n_before"),
        F.size("after").alias("n_after"),
        F.when(F.size("before") >= 2, F.col("before")).alias("line_before"),
        F.when(F.size("after") >= 2, F.col("after")).alias("line_after"),
        F.col("_start.lat").alias("start_lat"),
        F.col("_start.lon").alias("start_lon"),
        F.col("_end.lat").alias("end_lat"),
        F.col("_end.lon").alias("end_lon"),
    )


def utc_text(unix: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of epoch seconds in UTC, whatever the session's time zone."""
    clock = [F.lpad((F.pmod(unix, F.lit(86400)) / div % mod).cast("int").cast("string"), 2, "0") for div, mod in ((3600, 24), (60, 60), (1, 60))]
    return F.concat_ws(" ", utc_day(unix).cast("string"), F.concat_ws(":", *clock))


def event_report(ev: DataFrame) -> DataFrame:
    """Report record of the winning event: names (fallback 'Unknown'), UTC
    time text, midpoint (6 decimals), distance in m (1) and nm (4)."""
    return ev.select(
        "mmsi_a",
        "mmsi_b",
        F.coalesce(F.nullif(F.col("name_a"), F.lit("")), F.lit("Unknown")).alias("vessel_a"),
        F.coalesce(F.nullif(F.col("name_b"), F.lit("")), F.lit("Unknown")).alias("vessel_b"),
        "event_unix",
        F.concat(utc_text(F.col("event_unix")), F.lit(" UTC")).alias("timestamp_utc"),
        F.round("event_lat", 6).alias("latitude"),
        F.round("event_lon", 6).alias("longitude"),
        F.round(F.col("distance_nm") * METRES_PER_NM, 1).alias("distance_m"),
        F.round("distance_nm", 4).alias("distance_nm"),
        F.round("collision_score", 1).alias("collision_score"),
    )


def display_name(name_col: str, mmsi_col: str):
    """Name, or 'MMSI <n>' when missing or empty."""
    return F.coalesce(F.nullif(F.col(name_col), F.lit("")), F.concat(F.lit("MMSI "), F.col(mmsi_col).cast("string")))
