import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from tracklens.llm import periodic_runs as P

SCHEMA = "doc_id long, text string, runs string, best int, collapsed long"


def words(text):
    return [w for w in re.split(r"[\x20\x09-\x0d]+", text or "") if w]


def brute_runs(w):
    """Every maximal stretch of each lag, kept at its smallest period."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(P.LEAST, 2 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, m, q) for (s, m), q in found.items())


def collapse(w, runs):
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def found(w):
    code = np.array([hash(x) % 1000003 for x in w], np.int64)
    s, m, q = P.scan_lags(code, *P.split_segments(code, np.array([0, len(w)])))
    return sorted(zip(s.tolist(), m.tolist(), q.tolist(), strict=True))


def texts(seed):
    rnd = random.Random(seed)
    out = []
    for k in range(150):
        v = [f"w{i}" for i in range(rnd.choice([1, 2, 3, 8, 200]))]
        w = rnd.choices(v, k=rnd.randint(0, 60))
        for _ in range(rnd.randint(0, 3)):
            unit = rnd.choices(v, k=rnd.randint(1, 20))
            w += (unit * 9)[: rnd.randint(0, 5 * len(unit))] + rnd.choices(v, k=rnd.randint(0, 6))
        out.append(w)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_runs_match_brute_force(seed):
    for w in texts(seed):
        assert found(w) == brute_runs(w)


def test_periodic_and_fibonacci_words():
    a, b = "a", "ab"
    while len(b) < 700:
        a, b = b, b + a
    for w in (list(b), list("a" * 500), list("ab" * 300), list("aab" * 100 + "aba" * 100), [str(i) for i in range(400)], list("abcdefghijkl" * 2)):
        assert found(w) == brute_runs(w)


def test_splitting_keeps_every_run_and_only_words_that_recur():
    code = np.array([1, 2, 3, 1, 2, 4, *[5, 6] * 8, 30, 7, 8, 9, 8, 9, 7, 10], np.int64)
    lo, hi = P.split_segments(code, np.array([0, len(code)]))
    assert [(6, 22)] == list(zip(lo.tolist(), hi.tolist(), strict=True))


def test_a_chain_of_splits_ends():
    chain = [x for i in range(300) for x in (i + 1, i)]  # every round cuts one word off
    assert found(list(map(str, [999, *chain]))) == brute_runs([999, *chain])


def planted(d, w):
    h = zlib.crc32(str(d).encode())
    if d is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return w[:a] + [w[a + (i - a) % p] for i in range(a, n)]


def test_rows_match_brute_force(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.choice([" ", "\n", "\t \r"]).join(w)) for i, w in enumerate(texts(4))]
    rows += [(500, None), (501, ""), (502, " \n "), (None, "é " * 30), (503, "é " * 30), (503, "é " * 30), (None, None), (504, "x")]
    rows += [(i, " ".join(rnd.choices("abcdefghijk", k=60))) for i in range(600, 640)]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in rows], SCHEMA).repartition(3)
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in P.periodic_runs(df, P.planted_repeats).collect()), key=str)
    expected = []
    for d, t in rows:
        w = planted(d, words(t))
        runs = brute_runs(w)
        expected.append((d, len(w), runs, collapse(w, runs)))
    assert got == sorted(expected, key=str)
    assert sum(len(r[2]) for r in got) > 100
    assert P.periodic_runs(df.limit(0)).collect() == []


def test_query_columns(spark, scratch):
    rows = [(i, " ".join(random.Random(i).choices("abcdef", k=80))) for i in range(60)] + [(100, "one two"), (101, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{scratch}/documents.parquet")
    for r in P.query(spark, scratch).collect():
        w = planted(r.doc_id, words(dict(rows)[r.doc_id]))
        runs = brute_runs(w)
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapse(w, runs).encode()).hexdigest()
