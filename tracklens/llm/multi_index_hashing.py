"""Approximate nearest neighbours by multi-index hashing.

Vectors become binary codes: signs under several learned rotations (iterative
quantisation, fitted on a bounded sample).  A code is cut into 16-bit
substrings, each with its own index from substring to codes.  If two codes
differ in at most r bits, some substring pair differs in few enough bits to be
found by probing that neighbourhood of the query's substring (pigeonhole;
Norouzi, Punjani and Fleet, 2012), so probing retrieves every code within the
radius; what survives the full Hamming test is reranked by the inner product
of the original vectors in double precision.  The radius is calibrated: it is
the ``COVERAGE`` quantile of the Hamming distance from sample queries to their
true neighbours, found by scanning the whole table for those few queries.

Index and queries are cut into blocks by hash; a task holds one index block
and one query block.  Equal vectors are one class (any number of copies costs
one code), whose smallest ``k`` + 1 ids are all that a result can need.

Inner products of vectors of unequal norm are reduced to angles by one more
coordinate (Neyshabur and Srebro, 2015).

Edge cases: rows with a null id, vectors null, zero, holding null or
non-finite components, or of another length than the most frequent one take no
part; fewer than ``k`` candidates give all of them; an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracklens.llm.stages import settle

K = 20
QUERY_STEP = 20
ROTATIONS = 4
BITS_EACH = 64
SAMPLE = 4096  # vectors the rotations are fitted on
PROBES = 96  # queries the radius is calibrated on
COVERAGE = 0.985
INDEX_BLOCK = 16_384
QUERY_BLOCK = 2_048
ITERATIONS = 25
SEED = 11

POPCOUNT = np.bitwise_count(np.arange(1 << 16, dtype=np.uint16)).astype(np.uint8)


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim).astype(np.float64)


def augmented(x: np.ndarray, largest: float, query: bool) -> np.ndarray:
    """Unit vectors whose angles order inner products with any one query."""
    if query:
        return np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])
    y = x / largest
    return np.hstack([y, np.sqrt(np.maximum(0, 1 - (y * y).sum(1, keepdims=True)))])


def learn_rotations(x: np.ndarray, rotations: int = ROTATIONS, bits: int = BITS_EACH, seed: int = SEED) -> np.ndarray:
    """Columns are the hyperplanes of all rotations (iterative quantisation:
    alternate signs and the orthogonal map that fits them best)."""
    rng = np.random.default_rng(seed)
    dim = x.shape[1]
    out = []
    for _ in range(rotations):
        r = np.linalg.qr(rng.standard_normal((dim, dim)))[0][:, : min(bits, dim)]
        for _ in range(ITERATIONS):
            u, _, vt = np.linalg.svd(x.T @ np.sign(x @ r), full_matrices=False)
            r = u @ vt
        extra = bits - r.shape[1]
        out.append(np.hstack([r, rng.standard_normal((dim, extra))]) if extra > 0 else r)
    return np.hstack(out)


def codes(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Rows of 16-bit substrings."""
    return np.ascontiguousarray(np.packbits(x @ planes > 0, axis=1)).view(np.uint16)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return POPCOUNT[a ^ b].sum(-1, dtype=np.int64)


def substring_radii(radius: int, parts: int) -> list[int]:
    """Radii (-1: no probe) such that codes within ``radius`` bits agree within
    the radius of at least one substring."""
    a, b = divmod(radius, parts)
    return [a if j <= b else a - 1 for j in range(parts)]


class MultiIndex:
    """Substring indexes of one block of codes."""

    def __init__(self, block: np.ndarray):
        self.words = np.ascontiguousarray(block).view(np.uint64)
        self.size = len(block)
        self.values, self.bucket = [], []  # of each substring: the distinct values, and each code's place among them
        for j in range(block.shape[1]):
            values, bucket = np.unique(block[:, j], return_inverse=True)
            self.values.append(values)
            self.bucket.append(bucket)

    def distances(self, asked: np.ndarray) -> np.ndarray:
        """Hamming distances, asked codes x block."""
        words = np.ascontiguousarray(asked).view(np.uint64)
        out = np.zeros((len(asked), self.size), np.uint16)
        for w in range(words.shape[1]):
            out += np.bitwise_count(words[:, w, None] ^ self.words[None, :, w])
        return out

    def candidates(self, asked: np.ndarray, radii: list[int]) -> np.ndarray:
        """Marks (asked x block) of the codes that agree with an asked one
        within the radius of at least one substring.  Of each index the values
        within the radius are marked (the index's values bound that work, not
        the possible ones), and the members of marked buckets are taken."""
        found = np.zeros((len(asked), self.size), bool)
        for j, r in enumerate(radii):
            if r >= 0:
                close = POPCOUNT[self.values[j] ^ asked[:, j, None]] <= r
                found |= close[:, self.bucket[j]]
        return found

    def within(self, asked: np.ndarray, radius: int, width: int = 8) -> Iterator[np.ndarray]:
        """For each asked code the block's codes within ``radius`` bits: the
        pigeonhole's candidates from the indexes, then the Hamming test."""
        radii = substring_radii(radius, asked.shape[1])
        words = np.ascontiguousarray(asked).view(np.uint64)
        for start in range(0, len(asked), width):
            found = self.candidates(asked[start : start + width], radii)
            for word, marks in zip(words[start : start + width], found, strict=True):
                at = np.flatnonzero(marks)
                yield at[np.bitwise_count(self.words[at] ^ word).sum(1, dtype=np.int64) <= radius]


def best(score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the smaller ``first``."""
    if len(score) > k:
        floor = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= floor)
    else:
        at = np.arange(len(score))
    return at[np.lexsort((first[at], -score[at]))][:k]


def _usable(df: DataFrame, vector: str) -> DataFrame:
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return df.where(F.col("vec_id").isNotNull() & v.isNotNull() & fine)


def nearest(vectors: DataFrame, k: int = K, query_step: int = QUERY_STEP) -> DataFrame:
    """query_id, rank, vec_id, score for every row of ``vectors`` (vec_id,
    embedding) whose id is a multiple of ``query_step``, against all others."""
    spark = vectors.sparkSession
    out_kind = "query_id long, rank int, vec_id long, score double"
    v = _usable(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "embedding")
    common = v.groupBy(F.size("embedding").alias("d")).count().orderBy(F.col("count").desc(), F.col("d").desc()).first()
    if common is None:
        return spark.createDataFrame([], out_kind)
    dim = common["d"]
    v = v.where(F.size("embedding") == dim)
    classes = settle(v.groupBy("embedding").agg(F.min("vec_id").alias("first")).withColumn("cls", F.monotonically_increasing_id()), "vectors")
    members = settle(v.join(classes.select("embedding", "cls"), "embedding").select("cls", "vec_id").distinct(), "members")
    asked = settle(members.where(F.col("vec_id") % query_step == 0), "queries")
    of_query = settle(classes.join(asked.select("cls").distinct(), "cls", "left_semi"), "query-vectors")
    n, nq = classes.count(), of_query.count()

    hashed = F.xxhash64("cls", F.lit(SEED))
    share = lambda most, of: (hashed.bitwiseAND(0xFFFFFF) <= int(min(1.0, most / max(of, 1)) * 0xFFFFFF))
    largest = math.sqrt(classes.agg(F.max(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))).first()[0])
    sample = np.array([r[0] for r in classes.where(share(SAMPLE, n)).select("embedding").toLocalIterator()], np.float64).reshape(-1, dim)
    if not len(sample):
        sample = np.array([classes.select("embedding").first()[0]], np.float64)
    planes = learn_rotations(augmented(sample, largest, query=False))
    probes = np.array([r[0] for r in of_query.where(share(PROBES, nq)).select("embedding").collect()], np.float64).reshape(-1, dim)
    radius = _calibrate(classes, probes, planes, largest, dim, k)

    nb, qb = max(1, math.ceil(n / INDEX_BLOCK)), max(1, math.ceil(nq / QUERY_BLOCK))
    numbers = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    index = classes.withColumns({"ib": F.pmod(F.xxhash64("cls"), F.lit(nb)).cast("int"), "qb": numbers(qb)})
    queries = of_query.withColumns({"qb": F.pmod(F.xxhash64("cls"), F.lit(qb)).cast("int"), "ib": numbers(nb)})

    def search(block: pa.Table, asking: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("query", "cls", "first", "score")}
        if block.num_rows and asking.num_rows:
            x, q = (matrix(t.column("embedding").combine_chunks(), dim) for t in (block, asking))
            ids, first = block.column("cls").to_numpy(), block.column("first").to_numpy()
            mih = MultiIndex(codes(augmented(x, largest, query=False), planes))
            coded = codes(augmented(q, largest, query=True), planes)
            for i, (name, at) in enumerate(zip(asking.column("cls").to_numpy().tolist(), mih.within(coded, radius), strict=True)):
                if len(at) <= k:  # too few in this block: its nearest codes, so that no query goes short
                    at = np.argsort(mih.distances(coded[i : i + 1])[0], kind="stable")[: k + 1]
                score = x[at] @ q[i]
                top = best(score, first[at], k + 1)
                out["query"].append(np.full(len(top), name)), out["cls"].append(ids[at[top]])
                out["first"].append(first[at[top]]), out["score"].append(score[top])
        cat = {c: np.concatenate(a) if a else np.zeros(0, np.float64 if c == "score" else np.int64) for c, a in out.items()}
        return pa.table({c: pa.array(a) for c, a in cat.items()})

    found = index.groupBy("ib", "qb").cogroup(queries.groupBy("ib", "qb")).applyInArrow(search, "query long, cls long, first long, score double")
    # k + 1 classes, then k + 1 ids, per query vector: one of them may be the query itself
    top = lambda df, key, order, most: df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_n") <= most).drop("_n")
    hits = settle(top(found, "query", [F.col("score").desc(), "first"], k + 1), "hits")
    ids = top(hits.join(top(members, "cls", ["vec_id"], k + 1), "cls"), "query", [F.col("score").desc(), "vec_id"], k + 1)
    rows = ids.select("query", "vec_id", "score").join(asked.select(F.col("cls").alias("query"), F.col("vec_id").alias("query_id")), "query").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _calibrate(classes: DataFrame, probes: np.ndarray, planes: np.ndarray, largest: float, dim: int, k: int) -> int:
    """Radius that holds ``COVERAGE`` of the probes' true neighbours."""
    if not len(probes):
        return 0
    coded = codes(augmented(probes, largest, query=True), planes)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("embedding"), dim)
            own, first = codes(augmented(x, largest, query=False), planes), batch.column("first").to_numpy()
            for i, q in enumerate(probes):
                score = x @ q
                at = best(score, first, k + 1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i)), pa.array(score[at]), pa.array(hamming(own[at], coded[i]))], ["probe", "score", "bits"])

    near = classes.select("embedding", "first").mapInArrow(scan, "probe long, score double, bits long")
    by_score = Window.partitionBy("probe").orderBy(F.col("score").desc(), "bits")
    near = near.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k + 1)
    return int(near.agg(F.percentile("bits", F.lit(COVERAGE))).first()[0]) + 1


def query(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
