"""Cutting an operator into phases at written tables.

``settle`` writes a DataFrame as Parquet below ``spark.checkpoint.dir`` and
reads it back: lineage ends there, a lost executor re-reads files, and
Spark's own clean-up of finished queries' shuffle files is switched on for
the write, so only one phase's shuffle is on disk at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracklens.plans.materialize import shared_checkpoint_dir

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the session's shared checkpoint folder; return the table."""
    spark = df.sparkSession
    folder = shared_checkpoint_dir(spark)
    if not folder:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = f"{folder.rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.settled_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that no result reads any more."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(t.settled_at)
        path.getFileSystem(conf).delete(path, True)


def dense_rank_from_zero(
    df: DataFrame, group: list[str], order: list[Column], block: Column, out: str
) -> DataFrame:
    """Number the rows of every ``group`` gaplessly from 0 in the order of
    (``block``, ``order``).  Only the rows of one (group, block) meet in a
    task; the blocks' offsets come from a running sum over their counts."""
    rows = df.withColumn("_block", block)
    counts = rows.groupBy(*group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    within = Window.partitionBy(*group, "_block").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(within) - 1)
    return ranked.join(offsets, [*group, "_block"]).withColumn(out, F.col("_off") + F.col("_rank")).drop("_block", "_off", "_rank")


def _only_stars(e: DataFrame) -> bool:
    """Every node has one edge up to a smaller one, or only edges down to
    larger ones: then each component is a star around its minimum."""
    end = lambda x, up: F.struct(F.col(x).alias("x"), F.lit(up).alias("up"), F.lit(1 - up).alias("down"))
    ends = e.select(F.inline(F.array(end("u", 1), end("v", 0))))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 OR up + down > 1").isEmpty()


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): columns node, comp (the
    component's smallest node), one row per node with an edge.

    Alternates the large-star and small-star steps of Kiveris et al. (2014)
    until every component is a star around its minimum.  Each step is a
    group-minimum (combined before the shuffle) and a join that AQE may split,
    so a star of any size never has to meet in one task.
    """
    e = settle(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)
    while not _only_stars(e):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before, e = e, settle(small.where("u <> v").distinct(), name)
        discard(before)
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
