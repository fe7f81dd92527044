"""Frozen schemas of the ping, candidate and scored tables."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Header names of the AIS CSV files (fixed values).
CSV_COLUMNS = {
    "ts": "# Timestamp",
    "mmsi": "MMSI",
    "lat": "Latitude",
    "lon": "Longitude",
    "sog": "SOG",
    "cog": "COG",
    "name": "Name",
    "ship_type": "Ship type",
    "mobile_type": "Type of mobile",
}
CSV_TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"

PING_SCHEMA = StructType(
    [
        StructField("mmsi", LongType(), False),
        StructField("ts", TimestampType(), False),
        StructField("ts_unix", LongType(), False),
        StructField("lat", DoubleType(), False),
        StructField("lon", DoubleType(), False),
        StructField("sog", DoubleType(), True),
        StructField("cog", DoubleType(), True),
        StructField("name", StringType(), True),
        StructField("ship_type", StringType(), True),
        StructField("mobile_type", StringType(), True),
    ]
)
PING_COLUMNS = [f.name for f in PING_SCHEMA.fields]

CANDIDATE_SCHEMA = StructType(
    [
        StructField("mmsi_a", LongType()),
        StructField("mmsi_b", LongType()),
        StructField("name_a", StringType()),
        StructField("name_b", StringType()),
        StructField("ts_a", TimestampType()),
        StructField("ts_b", TimestampType()),
        StructField("lat_a", DoubleType()),
        StructField("lon_a", DoubleType()),
        StructField("lat_b", DoubleType()),
        StructField("lon_b", DoubleType()),
        StructField("sog_a", DoubleType()),
        StructField("sog_b", DoubleType()),
        StructField("distance_nm", DoubleType()),
        StructField("closing_speed_kn", DoubleType()),
        StructField("vessels_in_cell_a", LongType()),
        StructField("vessels_in_cell_b", LongType()),
    ]
)
CANDIDATE_COLUMNS = [f.name for f in CANDIDATE_SCHEMA.fields]

SILENCE_FIELDS = [
    StructField("last_ping_a", LongType()),
    StructField("last_ping_b", LongType()),
    StructField("event_unix", LongType()),
    StructField("silence_a", LongType()),
    StructField("silence_b", LongType()),
    StructField("silent_a", BooleanType()),
    StructField("silent_b", BooleanType()),
    StructField("silence_count", IntegerType()),
    StructField("min_silence_s", LongType()),
]
REACTION_FIELDS = [
    StructField("max_sog_drop", DoubleType()),
    StructField("max_cog_change", DoubleType()),
    StructField("post_event_divergence", DoubleType()),
]
SCORED_SCHEMA = StructType(
    CANDIDATE_SCHEMA.fields
    + SILENCE_FIELDS
    + REACTION_FIELDS
    + [StructField("scene_density", DoubleType()), StructField("collision_score", DoubleType())]
)
SCORED_COLUMNS = [f.name for f in SCORED_SCHEMA.fields]
