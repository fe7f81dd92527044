"""Corpus pipeline over ``documents``: quality, near duplicates, repeated
spans, benchmark passages, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and reads back as the next
stage's docs.  All but the last return the columns of ``documents``; n_chars
follows the text where a stage changes it.  No SQL can express the classifier,
so ``ORACLE_SQL`` is None; the stages are tested against brute force.

Edge cases: null doc_ids pass the quality stage like others, are nobody's
duplicate and lose no repeated span; null and empty texts are scored like any
text (an empty one is usually rejected); a repeated row of the document that
stays is dropped with the other duplicates; rows that share a doc_id are judged
by their own texts; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tracklens.llm import cutting_stock, debruijn_dedup, ngram_join, subword_quality, suffix_automaton
from tracklens.llm.stages import discard, settle

ORACLE_SQL = None


def _counted(docs: DataFrame) -> DataFrame:
    """n_chars of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    weights, bias = subword_quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    inner = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]  # no clash with the score
    scored = subword_quality.score_texts(docs.toDF(*inner), weights, bias, out="score")
    return scored.where(F.col("score") >= subword_quality.THRESHOLD).select(*inner).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, of the smallest doc_id (then the smallest row hash), of each
    group of near copies.  Rows are told apart by a hash of all their columns,
    not by doc_id: rows that share an id but not the text are rows of their own."""
    inner = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(docs.columns)]  # no clash with row and group
    rows = docs.toDF(*inner).where("doc_id IS NOT NULL")
    hashable = [F.to_json(c) if isinstance(rows.schema[c].dataType, (ArrayType, MapType, StructType, VariantType)) else F.col(c) for c in inner]
    named = rows.withColumn("row", F.xxhash64(*hashable, *[F.col(c).isNull() for c in inner]))
    groups = ngram_join.similar_components(named.select(F.col("row").alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias("row"), F.col("component_id").alias("of")).distinct()
    ids = named.select("row", "doc_id").distinct().join(groups, "row")
    stay = ids.groupBy("of").agg(F.min(F.struct("doc_id", "row")).alias("s")).select("s.doc_id", "s.row")
    kept = named.join(stay, ["doc_id", "row"], "left_semi")
    kept = kept.dropDuplicates(["doc_id", "row"]).drop("row")
    return kept.unionByName(docs.toDF(*inner).where("doc_id IS NULL")).select(*inner).toDF(*docs.columns)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the word windows that start in an earlier document."""
    return _counted(debruijn_dedup.remove_repeats(docs))


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without benchmark windows; texts that are mostly benchmark go."""
    return _counted(suffix_automaton.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids: one row per piece, with its ids."""
    return cutting_stock.pack(cutting_stock.token_pieces(docs, with_ids=True, keep_cache=False))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_spans", repeated_spans),
    ("benchmark_passages", benchmark_passages),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        before = docs
    return docs
