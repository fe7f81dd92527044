"""Builders for hand-made ping tables (micro-fixtures)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklens.schema import PING_SCHEMA

T0 = 1638316800 + 3600  # 2021-12-01 01:00:00 UTC, a minute boundary


def pings(spark, rows, with_id: bool = True):
    """rows: dicts with mmsi, t (seconds after T0), lat; optional lon (14.0),
    sog (10.0), cog (90.0), name, ship_type, mobile_type ('Class A')."""
    recs = []
    for i, r in enumerate(rows):
        recs.append(
            (
                int(r.get("mmsi", 219000001)),
                int(T0 + r["t"]),
                float(r["lat"]),
                float(r.get("lon", 14.0)),
                r.get("sog", 10.0),
                r.get("cog", 90.0),
                r.get("name", "V"),
                r.get("ship_type", "Cargo"),
                r.get("mobile_type", "Class A"),
                i,
            )
        )
    df = spark.createDataFrame(
        recs,
        "mmsi long, ts_unix long, lat double, lon double, sog double, cog double, name string, "
        "ship_type string, mobile_type string, event_id long",
    )
    df = df.withColumn("ts", F.timestamp_seconds("ts_unix"))
    cols = [f.name for f in PING_SCHEMA.fields] + (["event_id"] if with_id else [])
    return df.select(*cols)
