"""Labelled rows for the classifiers: who may be learned from, and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.stages import settle


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null for a null id)."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % modulus


def learnable(labels: DataFrame, label: str, modulus: int, held: int) -> DataFrame:
    """doc_id, label (0 or 1) of the rows a classifier may learn from."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    return rows.where(F.col("label").isin(0, 1) & (remainder(F.col("doc_id"), modulus) != held)).distinct()


def hash_share(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) drawn from the id."""
    return F.pmod(F.xxhash64(doc_id, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def bounded_sample(rows: DataFrame, most: int, seed: int) -> DataFrame:
    """The distinct (doc_id, label, text) of ``rows``, whose ids are at most
    about ``most``.  Where ids repeat with so many texts that this is over 5/4
    of ``most``, that share of them and one row of every (doc_id, label)."""
    rows = settle(rows.select("doc_id", "label", "text").distinct().withColumn("_h", F.xxhash64("doc_id", "text", "label", F.lit(seed))), "sample")
    share = min(1.0, most * 1.25 / max(rows.count(), 1))
    first = rows.groupBy("doc_id", "label").agg(F.min("_h").alias("_first"))
    drawn = F.pmod("_h", F.lit(1 << 30)) / float(1 << 30) < share
    return rows.join(first, ["doc_id", "label"]).where(drawn | (F.col("_h") == F.col("_first"))).select("doc_id", "label", "text")
