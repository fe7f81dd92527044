import math

import numpy as np
import pytest

from tracklens.llm import multi_index_hashing as M

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, k=M.K, step=M.QUERY_STEP):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    out = {}
    for i, v in rows:
        if i % step == 0:
            s = x @ v
            order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def run(spark, rows):
    got = {}
    for r in M.nearest(spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "clash") for i, v in rows], SCHEMA)).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


def recall(got, want):
    """Checks form and scores, returns the share of true neighbours found."""
    assert set(got) == {q for q, v in want.items() if v}
    hit = total = 0
    for q, v in want.items():
        g = got.get(q, [])
        assert [r for r, *_ in g] == list(range(1, len(v) + 1))
        assert [(-s, i) for _, i, s in g] == sorted((-s, i) for _, i, s in g)
        hit += len({i for _, i, _ in g} & {i for i, _ in v})
        total += len(v)
    return hit / max(total, 1)


def test_pigeonhole_finds_every_code_within_the_radius():
    rng = np.random.default_rng(1)
    block = rng.integers(0, 1 << 16, (3000, 4)).astype(np.uint16)
    block[100:160] = block[0] ^ (1 << rng.integers(0, 16, (60, 4))).astype(np.uint16)
    mih = M.MultiIndex(block)
    for radius in (0, 1, 3, 4, 7, 12, 25, 40):
        asked = [0, 130, 2000]
        for q, got in zip(asked, mih.within(block[asked], radius, width=2), strict=True):
            assert got.tolist() == np.flatnonzero(M.hamming(block, block[q]) <= radius).tolist()


@pytest.mark.parametrize("norms", [False, True])
def test_recall_against_brute_force(spark, monkeypatch, norms):
    monkeypatch.setattr(M, "INDEX_BLOCK", 700)
    monkeypatch.setattr(M, "QUERY_BLOCK", 40)
    rng = np.random.default_rng(2)
    x = rng.standard_normal((3000, 32)) + 2 * rng.standard_normal((20, 32))[rng.integers(0, 20, 3000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if norms:
        x *= rng.uniform(0.2, 3, (3000, 1))
    rows = list(enumerate(x.tolist()))
    got, want = run(spark, rows), brute(rows)
    assert recall(got, want) >= 0.9
    for q, v in got.items():
        for _, i, s in v[:3]:
            assert math.isclose(s, float(np.array(rows[q][1], np.float32).astype(float) @ np.array(rows[i][1], np.float32).astype(float)), rel_tol=1e-12, abs_tol=1e-12)


def test_copies_ties_and_unusable_rows(spark):
    rng = np.random.default_rng(3)
    same = rng.standard_normal(8).tolist()
    rows = [(i, same) for i in range(0, 300, 2)] + [(i, rng.standard_normal(8).tolist()) for i in range(1, 300, 2)]
    usable = dict(rows)
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [1.0] * 7 + [None]), (1060, [float("nan")] * 8), (1080, [float("inf")] + [0.0] * 7), (1100, [1.0] * 5), (None, same)]
    got, want = run(spark, [*rows, *bad, rows[0]]), brute(list(usable.items()))
    assert recall(got, want) >= 0.9
    assert [i for _, i, _ in got[0]] == list(range(2, 42, 2))  # the smallest ids among equal vectors, never its own


def test_few_rows(spark):
    assert run(spark, []) == {} and run(spark, [(0, [1.0, 2.0])]) == {}
    assert run(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]) == {0: [(1, 2, 1.0), (2, 1, 0.0)]}
    assert run(spark, [(1, [1.0, 0.0]), (2, [0.0, 1.0])]) == {}


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = {}
    for r in M.query(spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert recall({q: sorted(v) for q, v in got.items()}, brute(rows)) >= 0.9
