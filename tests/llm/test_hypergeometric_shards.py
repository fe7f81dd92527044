import zlib

import numpy as np
import pytest

from tracklens.llm import hypergeometric_shards as H

SF = "/root/testdata/sf0.001"


def test_matrix_sums_and_law():
    counts, sizes = np.array([7, 0, 5, 9]), np.array([6, 5, 10])
    mean = np.zeros((4, 3))
    for seed in range(3000):
        m = H.communication_matrix(counts, sizes, seed)
        assert (m.sum(1) == counts).all() and (m.sum(0) == sizes).all()
        mean += m
    expected = np.outer(counts, sizes) / sizes.sum()
    assert np.abs(mean / 3000 - expected).max() < 0.1


def test_exact_sizes_slots_and_columns(spark, monkeypatch):
    monkeypatch.setattr(H, "ROWS_PER_BLOCK", 50)  # several blocks and several ranges in each
    df = spark.range(1003).selectExpr("IF(id % 50 = 0, NULL, id % 700) AS doc_id", "CAST(id AS STRING) AS text", "id AS shard", "id AS _x")
    got = H.shuffle_into_shards(df, "doc_id", shards=7)
    rows = got.collect()
    assert sorted(r.text for r in rows) == sorted(str(i) for i in range(1003))
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert sorted(map(len, by.values())) == [143] * 5 + [144] * 2
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = {r.text: (r.shard, r.slot) for r in H.shuffle_into_shards(df.repartition(5), "doc_id", shards=7).collect()}
    assert again == {r.text: (r.shard, r.slot) for r in rows}  # a function of content, not of partitions


def test_uniform_over_seeds(spark):
    df = spark.range(40).selectExpr("id AS doc_id")
    hits = np.zeros((40, 4))
    for seed in range(12):
        for r in H.shuffle_into_shards(df, "doc_id", shards=4, seed=seed).collect():
            hits[r.doc_id, r.shard] += 1
    assert hits.sum() == 480 and hits.sum(0).tolist() == [120.0] * 4
    assert ((hits - 3) ** 2 / 3).sum() < 200  # chi-square, 120 degrees of freedom: far below at uniformity


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = H.shuffle_into_shards(spark.range(n).selectExpr("id AS doc_id"), "doc_id").collect()
    assert len(rows) == n and all(r.slot == 0 for r in rows)


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = H.query(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    sizes = [sum(r.shard == s for r in rows) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1


def test_the_law_beyond_numpy(monkeypatch):
    from math import comb

    left = np.array([10**12, 0, 5, 2 * 10**12, 10**12])
    for n in (0, 1, 2000, 10**9, int(left.sum()) - 3, int(left.sum())):
        row = H._draw(np.random.default_rng(n), left, n)
        assert row.sum() == n and (row >= 0).all() and (row <= left).all()
    rows = np.array([H._draw(np.random.default_rng(s), left, 10**6) for s in range(300)])
    share = left / left.sum()
    assert (np.abs(rows.mean(0) - 10**6 * share) <= 5 * np.sqrt(10**6 * share * (1 - share) / 300) + 0.1).all()
    # small numbers through the same inversion, against the exact probabilities
    monkeypatch.setattr(H, "NUMPY_ROWS", 1)
    rng = np.random.default_rng(8)
    for good, bad, n in ((6, 4, 7), (1, 9, 5), (40, 60, 30), (3, 0, 2)):
        got = np.bincount([H.hypergeometric(rng, good, bad, n) for _ in range(20_000)], minlength=n + 1)[: n + 1] / 20_000
        exact = [comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(n + 1)]
        assert np.abs(got - exact).max() < 0.015


def brute_place(rows, shards, seed, xx):
    """Placement recomputed row by row: ``xx`` hashes (salt, key, content)."""
    total = len(rows)
    blocks = max(1, -(-total // H.ROWS_PER_BLOCK))
    block = [xx("block", *r) % blocks for r in rows]
    counts = np.bincount(block, minlength=blocks)
    matrix = H.communication_matrix(counts, H.equal_sizes(total, shards), seed)
    order = lambda salt, r: (xx(salt, *r) % (1 << 64), )
    shard = {}
    for b in range(blocks):
        mine = sorted((r for r, x in zip(rows, block, strict=True) if x == b), key=lambda r: order("local", r))
        ends = np.cumsum(matrix[b])
        for k, r in enumerate(mine):
            shard[r] = int((ends <= k).sum())
    out = {}
    for s in range(shards):
        for k, r in enumerate(sorted((r for r in rows if shard[r] == s), key=lambda r: order("slot", r))):
            out[r] = (s, k)
    return out


def test_placement_against_brute_force(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(H, "ROWS_PER_BLOCK", 60)
    df = spark.range(500).selectExpr("id * 3 AS doc_id", "id % 7 AS n")
    content = F.xxhash64("doc_id", "n")
    hashes = {}
    for r in df.select("doc_id", content.alias("c"), *[F.xxhash64(F.lit(5), F.lit(x), "doc_id", content).alias(x) for x in ("block", "local", "slot")]).collect():
        for x in ("block", "local", "slot"):
            hashes[x, r.doc_id, r.c] = r[x]
    rows = [(d, c) for x, d, c in hashes if x == "slot"]
    expected = {r[0]: place for r, place in brute_place(rows, 6, 5, lambda *k: hashes[k]).items()}
    assert {r.doc_id: (r.shard, r.slot) for r in H.shuffle_into_shards(df, "doc_id", shards=6, seed=5).collect()} == expected


def test_many_equal_rows_and_names_of_inner_columns(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(H, "ROWS_PER_BLOCK", 50)
    own = ["_content", "_blk", "_o", "_block", "_r", "_id", "_copy", "c0", "_ends"]
    df = spark.range(900).selectExpr("IF(id < 500, 1, id) AS doc_id").withColumns({c: F.lit(c) for c in own} | {"m": F.create_map(F.lit("a"), F.lit(1))})
    got = H.shuffle_into_shards(df, "doc_id", shards=5, copies_apart=100)
    assert got.columns == [*df.columns, "shard", "slot"]
    rows = got.collect()
    assert all(r[c] == c for r in rows for c in own) and sum(r.doc_id == 1 for r in rows) == 500
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert {k: sorted(v) for k, v in by.items()} == {k: list(range(180)) for k in range(5)}
