"""Uniform shuffle into shards of exact sizes by a hypergeometric
communication matrix.

Rows are dealt to blocks by a hash of their key.  Given the blocks' exact row
counts and the shards' exact sizes, the number of rows each block sends to
each shard of a uniformly random assignment is multivariate hypergeometric;
the matrix of these counts is drawn row by row on the driver (blocks x shards
numbers, bounded by ``MAX_CELLS`` whatever the table's size).  Then each block
permutes its rows locally (order of a seeded hash), cuts them by its row of
the matrix, the cuts are exchanged, and every shard permutes what it received
again: ``slot`` is the place in that second permutation.

Everything is a function of the rows' content and the seed, so a recomputed
task gives the same rows the same place.  Edge cases: rows with a null key,
and repeated rows, are ordinary rows (ties are broken by the content hash;
rows equal in everything are interchangeable); an empty table gives an empty
result; shards may be empty when there are fewer rows than shards.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType, VariantType

from tracklens.llm.stages import dense_rank_from_zero, settle

SHARDS = 40
SEED = 20_240_607
ROWS_PER_BLOCK = 50_000
MAX_CELLS = 4_000_000  # of the matrix: 32 MB
NUMPY_ROWS = 1_000_000_000  # numpy draws the law below
REACH = 14


def communication_matrix(counts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """counts of each block, sizes of each shard (equal sums) -> rows of each
    block for each shard, distributed as under a uniform shuffle."""
    rng = np.random.default_rng(seed)
    left = np.array(sizes, dtype=np.int64)
    out = np.zeros((len(counts), len(sizes)), dtype=np.int64)
    for i, n in enumerate(counts):
        out[i] = _draw(rng, left, int(n))
        left -= out[i]
    return out


def _draw(rng: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One block's row, multivariate hypergeometric: numpy's law below 10^9
    rows, above one shard after another, each from what the others left."""
    total = int(left.sum())
    if total < NUMPY_ROWS:
        return rng.multivariate_hypergeometric(left, n, method="marginals")
    out = np.zeros(len(left), np.int64)
    for j, good in enumerate(left.tolist()):
        total -= good
        out[j] = hypergeometric(rng, good, total, n)
        n -= int(out[j])
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows drawn from ``good`` + ``bad`` are good, by
    inversion around the mode: the probabilities of the counts within ``REACH``
    standard deviations follow from each other's ratios (what lies beyond is
    less than a double can tell from 0).  The work grows with the deviation,
    not with the rows."""
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    if good + bad < NUMPY_ROWS:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mode = (n + 1) * (good + 1) // (total + 2)
    spread = math.sqrt(n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1)))
    first, last = max(low, mode - int(REACH * spread) - 50), min(high, mode + int(REACH * spread) + 50)
    k = np.arange(first, last, dtype=np.float64)
    ratio = (good - k) * (n - k) / ((k + 1) * (bad - n + k + 1))  # of the counts k + 1 and k
    weight = np.concatenate([[0.0], np.cumsum(np.log(ratio))])
    weight = np.cumsum(np.exp(weight - weight.max()))
    return first + int(np.searchsorted(weight, rng.random() * weight[-1], side="right"))


def equal_sizes(rows: int, shards: int) -> np.ndarray:
    return np.array([rows // shards + (j < rows % shards) for j in range(shards)], dtype=np.int64)


def shuffle_into_shards(df: DataFrame, key: str, shards: int = SHARDS, seed: int = SEED, content: Column | None = None, copies_apart: int = ROWS_PER_BLOCK) -> DataFrame:
    """``df`` plus shard (0 to shards - 1; row counts at most one apart) and
    slot (gapless from 0 in each shard).  ``content`` breaks ties between rows
    of one key (default: a hash of all columns).  More than ``copies_apart``
    rows equal in key and content are spread over the blocks by their place
    in the written table."""
    own = {"shard", "slot"}
    names = [c for c in df.columns if c not in own]
    inner = [f"c{i}" for i in range(len(names))]  # no clash with the columns made on the way
    content = F.xxhash64(*[_hashable(df, c) for c in names]) if content is None else content
    renamed = [F.col(f"`{c}`").alias(i) for c, i in zip(names, inner, strict=True)]
    rows = df.select(*renamed, content.alias("_content"), F.monotonically_increasing_id().alias("_id"), F.lit(None).cast("long").alias("_copy"))
    rows, key = settle(rows, "rows"), inner[names.index(key)]

    def seeded(salt: str) -> Column:
        own = [F.lit(seed), F.lit(salt), F.col(key), F.col("_content")]
        return F.when(F.col("_copy").isNull(), F.xxhash64(*own)).otherwise(F.xxhash64(*own, "_copy"))

    def dealt_to_blocks(df: DataFrame) -> tuple[DataFrame, np.ndarray]:
        df = df.withColumn("_blk", F.pmod(seeded("block"), F.lit(blocks)).cast("int"))
        counts = np.zeros(blocks, dtype=np.int64)
        for r in df.groupBy("_blk").count().collect():  # one row per block
            counts[r["_blk"]] = r["count"]
        return df, counts

    total = rows.count()
    blocks = max(1, min(math.ceil(total / ROWS_PER_BLOCK), MAX_CELLS // shards))
    plain = rows
    rows, counts = dealt_to_blocks(plain)
    if counts.max() > 2 * total / blocks + copies_apart:  # rows equal in everything share a block; many are told apart by their place in the table
        many = plain.groupBy(key, "_content").count().where(F.col("count") > copies_apart).select(F.col(key).alias("_key"), F.col("_content").alias("_same"))
        apart = plain.join(many, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_content") == F.col("_same")), "left")
        rows, counts = dealt_to_blocks(apart.withColumn("_copy", F.when(F.col("_same").isNotNull(), F.col("_id"))).drop("_key", "_same"))
    matrix = communication_matrix(counts, equal_sizes(total, shards), seed)
    ends = df.sparkSession.createDataFrame([(i, [int(x) for x in np.cumsum(m)]) for i, m in enumerate(matrix)], "_blk int, _ends array<long>")
    def permuted(salt: str, group: str, pieces: int, out: str, df: DataFrame) -> DataFrame:
        """Number the group's rows in the order of a seeded hash; one task
        holds one of ``pieces`` ranges of that hash."""
        top = F.shiftrightunsigned("_o", 40)  # 24 bits
        order = [F.shiftrightunsigned("_o", 1), F.col("_o"), F.col(key), F.col("_content"), F.col("_copy")]
        return dense_rank_from_zero(df.withColumn("_o", seeded(salt)), [group], order, F.floor(top * pieces / (1 << 24)), out).drop("_o")

    local = permuted("local", "_blk", math.ceil(int(counts.max()) / ROWS_PER_BLOCK) or 1, "_r", rows)
    dealt = local.join(ends, "_blk").withColumn("shard", F.size(F.filter("_ends", lambda e: e <= F.col("_r"))))
    out = permuted("slot", "shard", math.ceil(total / shards / ROWS_PER_BLOCK) or 1, "slot", dealt.drop("_ends", "_r", "_blk"))
    return out.select(*[F.col(i).alias(c) for c, i in zip(names, inner, strict=True)], "shard", "slot")


def _hashable(df: DataFrame, name: str) -> Column:
    """The column in a form that every type can be hashed in."""
    nested = isinstance(df.schema[name].dataType, (ArrayType, MapType, StructType, VariantType))
    return F.to_json(F.col(f"`{name}`")) if nested else F.col(f"`{name}`")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    narrow = docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    dealt = shuffle_into_shards(narrow, "doc_id")
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
