"""Date-partitioned Parquet store for parsed pings.

Writing pings once as Parquet partitioned by UTC day lets the time-window
filter prune whole directories and pushes the bounding-box predicates into
the Parquet reader (row-group statistics) instead of re-parsing CSV text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens.functions.geo import utc_day
from tracklens.schema import PING_COLUMNS

DAY_COLUMN = "day"


def write_pings(pings: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write pings partitioned by day; rows of one day are clustered by vessel
    and time so Parquet min/max statistics stay selective."""
    (
        pings.withColumn(DAY_COLUMN, utc_day(F.col("ts_unix")))
        .repartition(DAY_COLUMN, "mmsi")
        .sortWithinPartitions("mmsi", "ts_unix")
        .write.mode(mode)
        .partitionBy(DAY_COLUMN)
        .parquet(path)
    )


def read_pings(spark: SparkSession, path: str, keep_day: bool = True) -> DataFrame:
    df = spark.read.parquet(path)
    cols = list(PING_COLUMNS) + ([DAY_COLUMN] if keep_day and DAY_COLUMN in df.columns else [])
    extra = [c for c in df.columns if c not in cols and c != DAY_COLUMN]
    return df.select(*cols, *extra)
