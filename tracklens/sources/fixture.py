"""Ping fixture derived from the driver's ``events`` table.

Every row of ``events`` is one ping.  Each 2,000 events are a fleet of twenty
vessels in ten pairs that approach and part periodically, so vessels, pairs
and pings grow with the table.  Fleets start 1,000 s apart; every 2,600th
starts the month anew, at another longitude (80 places) and then latitude
(2), so all fleets lie inside the time window and, up to 8 * 10^8 events,
apart from each other.  The fleets have duplicates, GPS spikes,
stationary vessels, Class B, a SAR MMSI, vessels that fall silent (a
replacement vessel sends the later pings), points in the box but outside the
circle, pairs that keep over 100 m apart, fast approaches, sudden stops and
null / (0,0) positions (see FIXTURES.md).  The same SQL text runs in Spark and
DuckDB; ``event_id`` is the row id used to order duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIXTURE_PINGS_SQL = """
WITH b AS (
  SELECT event_id, event_type, value, event_id % 20 AS v,
         CAST(floor(event_id / 2000) AS BIGINT) AS g,
         CAST(floor((event_id % 2000) / 20) AS BIGINT) AS s,
         CAST(floor((event_id % 20) / 2) AS BIGINT) AS p
  FROM {events}),
c AS (SELECT *, g % 2600 * 100 + s AS n, CAST(floor(g / 2600) AS BIGINT) AS w, abs((s * (1 + p % 3)) % 60 - 30) AS tri,
             (v = 1 AND s > 30) OR (v IN (10, 11) AND s > 35) AS replaced FROM b)
SELECT event_id,
  CASE WHEN v = 18 THEN 111000000018 + g * 100 ELSE 219000000 + g * 100 + v + CASE WHEN replaced THEN 50 ELSE 0 END END AS mmsi,
  1638316800 + CASE WHEN v = 19 THEN g % 2600 * 1000 + s * 7200
                    WHEN s % 17 = 16 THEN (n - 1) * 10 + (v % 2) * 3
                    ELSE n * 10 + (v % 2) * 3 END AS ts_unix,
  CASE WHEN event_id % 223 = 7 THEN NULL
       WHEN event_id % 211 = 9 THEN CAST(0 AS DOUBLE)
       WHEN event_id % 199 = 11 THEN 55.985e0
       ELSE 55.225e0 - CAST(floor(w / 80) AS BIGINT) % 2 * 5e-1 + (CASE WHEN p = 1 THEN 0 ELSE p END) * 5e-2
            + (v % 2) * (tri * CASE WHEN p = 3 THEN 1.85e-3 ELSE 2e-4 END) + ((event_id * 7919) % 9973) * 1e-9
            + CASE WHEN v = 9 THEN 1e-3 ELSE 0e0 END
            + CASE WHEN s % 23 = 11 AND event_type = 'error' THEN 5e-1 ELSE 0e0 END
            + CASE WHEN v = 13 THEN 2e0 ELSE 0e0 END END AS lat,
  CASE WHEN event_id % 211 = 9 THEN CAST(0 AS DOUBLE)
       WHEN event_id % 199 = 11 THEN 15.645e0
       ELSE 14.245e0 + (w + 40) % 80 * 1.5e-2 - 6e-1 + s * 1e-4 + ((event_id * 6271) % 9967) * 1e-9 END AS lon,
  CASE WHEN event_id % 97 = 5 THEN NULL
       WHEN v IN (14, 15) THEN 1e-1
       WHEN v = 4 THEN CASE WHEN s % 20 <= 10 THEN 4e1 ELSE 2e0 END
       ELSE (CAST(floor(value * 100) AS BIGINT) % 2000) / 1e2 END AS sog,
  CASE WHEN event_id % 101 = 3 THEN NULL ELSE CAST((event_id * 37) % 360 AS DOUBLE) END AS cog,
  CASE WHEN v = 7 THEN NULL ELSE concat('VESSEL ', g, '-', v) END AS name,
  CASE WHEN v % 2 = 0 THEN 'Cargo' ELSE 'Passenger' END AS ship_type,
  CASE WHEN v IN (16, 17) THEN 'Class B' ELSE 'Class A' END AS mobile_type
FROM c
"""

FIXTURE_ORDER = ("event_id",)  # duplicate tie-break of the fixture


def pings_from_events(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Fixture pings (PING_SCHEMA plus ``event_id``) computed from ``events``."""
    raw = spark.sql(FIXTURE_PINGS_SQL, events=events.select("event_id", "event_type", "value"))
    return raw.select(
        F.col("mmsi").cast("long").alias("mmsi"),
        F.timestamp_seconds(F.col("ts_unix")).alias("ts"),
        F.col("ts_unix").cast("long").alias("ts_unix"),
        F.col("lat").cast("double").alias("lat"),
        F.col("lon").cast("double").alias("lon"),
        F.col("sog").cast("double").alias("sog"),
        F.col("cog").cast("double").alias("cog"),
        "name",
        "ship_type",
        "mobile_type",
        F.col("event_id").cast("long").alias("event_id"),
    )


def fixture_sql_duckdb() -> str:
    """The same fixture text for DuckDB (``events`` is a registered view)."""
    return FIXTURE_PINGS_SQL.replace("{events}", "events")
