"""Materialising fan-out points.

Several results feed more than one branch (clean tracks feed the pairing,
the silence check, the reaction windows and the trajectories).  Left lazy,
every branch would re-plan and re-run the whole upstream lineage.  When the
session names a shared checkpoint folder (``spark.checkpoint.dir``), the
result is written there as a Parquet table and read back: the lineage is cut,
a lost executor re-reads the files, later reads are columnar with column
pruning, and tables keyed by vessel and time chunk are bucketed on those keys
so windows, aggregates and joins on them need no new shuffle.  There is one
mode: without a shared folder materialising fails.

Inside a :func:`workspace` the tables are dropped, catalog entry and files,
when it ends; elsewhere they stay until the user drops them.  The rows of a
table are counted while it is written (``n_rows``), not by another scan.
"""

from __future__ import annotations

import contextlib
import contextvars
import uuid
from collections.abc import Iterator, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BUCKET_BYTES = 128 << 20  # of the largest input, for one bucket of a track table
MAX_BUCKETS = 100_000  # Spark's own bound

_MADE: contextvars.ContextVar[list | None] = contextvars.ContextVar("made", default=None)


def shared_checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder configured for the session, if any."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    return None


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Keep a configured folder; set ``fallback`` only where none is set
    (tests and local runs)."""
    d = shared_checkpoint_dir(spark)
    if d:
        return d
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


@contextlib.contextmanager
def workspace(spark: SparkSession) -> Iterator[None]:
    """Drop the tables that are materialised inside, and unpersist the small
    results, when the block ends (also by an error)."""
    made: list = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for kind, what, path in made:
            if kind == "small":
                what.unpersist()
                continue
            if kind == "table":
                spark.sql(f"DROP TABLE IF EXISTS {what}")
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def data_buckets(df: DataFrame, bytes_per_bucket: int = BUCKET_BYTES) -> int:
    """Buckets for a table made from ``df``: enough for the bytes of its
    largest input (as its files or Spark's statistics state them), and no
    fewer than ``spark.sql.shuffle.partitions``."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    largest = max((int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())), default=0)
    fewest = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MAX_BUCKETS, max(fewest, -(-largest // bytes_per_bucket)))


def materialize(
    df: DataFrame,
    bucket_by: Sequence[str] | None = None,
    small: bool = False,
    num_buckets: int | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and return the
    table, bucketed by ``bucket_by`` into ``num_buckets`` (default
    ``spark.sql.shuffle.partitions``) with one file a bucket.  ``dealt`` rows
    are already hashed by these keys into that many partitions.  Fails without
    a shared folder.  ``small`` results (a top-k report, bounded by
    configuration) are only persisted: recomputing them after a loss is cheap."""
    spark = df.sparkSession
    made = _MADE.get()
    if small:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        if made is not None:
            made.append(("small", kept, ""))
        return kept
    folder = shared_checkpoint_dir(spark)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    name = f"tracklens_{uuid.uuid4().hex}"
    path = f"{folder.rstrip('/')}/tables/{name}"
    rows = Observation()
    if made is not None:
        made.append(("table" if bucket_by else "files", name, path))
    if not bucket_by:
        df.observe(rows, F.count(F.lit(1)).alias("n")).write.parquet(path)
        table = spark.read.parquet(path)
    else:
        n = int(num_buckets or spark.conf.get("spark.sql.shuffle.partitions"))
        if not dealt and n != int(spark.conf.get("spark.sql.shuffle.partitions")):
            df = df.repartition(n, *bucket_by)  # else rows hashed by these keys already lie bucket by bucket
        df = df.observe(rows, F.count(F.lit(1)).alias("n"))
        df.write.format("parquet").option("path", path).bucketBy(n, *bucket_by).sortBy(*bucket_by).saveAsTable(name)
        table = spark.table(name)
    table.n_rows = rows.get["n"]
    return table
