"""AIS CSV reader.

Files are read with a header row and no schema inference, so every column
arrives as a string and only the nine needed columns are parsed (Spark's CSV
reader prunes the rest).  Spark 4 runs in ANSI mode, where a plain ``cast``
of bad text raises; ``try_cast`` / ``try_to_timestamp`` turn bad values into
nulls that the validity filter then drops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tracklens.operators.filters import is_valid, valid_pings
from tracklens.schema import CSV_COLUMNS, CSV_TIMESTAMP_FORMAT, PING_COLUMNS

LINE = "_line"  # the text of a line whose number of fields is not the header's
REASON = "reason"


def read_ais_csv(spark: SparkSession, path: str | list[str], validate: bool = True) -> DataFrame:
    """Load one CSV file, a directory of daily files, or a list of paths."""
    raw = spark.read.option("header", "true").option("inferSchema", "false").csv(path)
    pings = parse_ais(raw)
    return valid_pings(pings) if validate else pings


def parse_ais(raw: DataFrame, *extra: Column) -> DataFrame:
    """Project and type the string columns of an AIS table (PING_SCHEMA order),
    and any ``extra`` columns."""
    c = {k: F.col(f"`{v}`") for k, v in CSV_COLUMNS.items()}
    # The text is UTC: an explicit offset keeps the session's time zone out of it.
    ts = F.try_to_timestamp(F.concat(F.trim(c["ts"]), F.lit(" +00:00")), F.lit(f"{CSV_TIMESTAMP_FORMAT} xxx"))
    return raw.select(
        c["mmsi"].try_cast("long").alias("mmsi"),
        ts.alias("ts"),
        F.unix_timestamp(ts).alias("ts_unix"),
        c["lat"].try_cast("double").alias("lat"),
        c["lon"].try_cast("double").alias("lon"),
        c["sog"].try_cast("double").alias("sog"),
        c["cog"].try_cast("double").alias("cog"),
        c["name"].alias("name"),
        c["ship_type"].alias("ship_type"),
        c["mobile_type"].alias("mobile_type"),
        *extra,
    )


def read_ais_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The text columns of the files, by the header's names, and ``_line``:
    the whole line where it has more or fewer fields than the header (missing
    fields are null then, surplus ones are lost)."""
    names = spark.read.option("header", "true").option("inferSchema", "false").csv(path).columns
    schema = StructType([StructField(c, StringType()) for c in [*names, LINE]])
    reader = spark.read.option("header", "true").option("columnNameOfCorruptRecord", LINE)
    return reader.option("columnPruning", "false").schema(schema).csv(path)  # a pruned line is not counted out


def reject_reason() -> Column:
    """Why a parsed row is no valid ping (the first that applies); null for a
    ping that ``valid_pings`` keeps.  Bad SOG and COG only become null."""
    lat, lon = F.col("lat"), F.col("lon")
    return (
        F.when(is_valid(), F.lit(None).cast("string"))
        .when(F.col(LINE).isNotNull(), "malformed line")
        .when(F.col("ts_unix").isNull(), "bad time")
        .when(F.col("mmsi").isNull() | lat.isNull() | lon.isNull(), "bad number")
        .when((lat == 0.0) & (lon == 0.0), "position (0, 0)")
        .otherwise("out of range")
    )


def split_ais_csv(spark: SparkSession, path: str | list[str], output: str, mode: str = "errorifexists") -> tuple[DataFrame, DataFrame]:
    """Read AIS files once and write two tables under ``output``: the valid
    pings (equal to ``read_ais_csv``) and the rows they leave out, as text with
    their ``reason`` and, if malformed, ``_line``.  Each line of the files is a
    row of exactly one of them."""
    raw = read_ais_lines(spark, path)
    source = F.struct(*[F.col(f"`{header}`").alias(name) for name, header in CSV_COLUMNS.items()]).alias("source")
    parsed = parse_ais(raw, source, F.col(LINE)).withColumn(REASON, reject_reason())
    kept = F.col(REASON).isNull()
    rows = parsed.withColumn("source", F.when(~kept, F.col("source"))).withColumn("status", F.when(kept, "accepted").otherwise("rejected"))
    rows.write.mode(mode).partitionBy("status").parquet(output)
    table = spark.read.schema(rows.schema).parquet(output)
    accepted = table.where("status = 'accepted'").select(*PING_COLUMNS)
    rejected = table.where("status = 'rejected'").select(F.col(REASON), F.col(LINE), "source.*")
    return accepted, rejected
