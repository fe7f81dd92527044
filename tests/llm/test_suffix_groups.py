import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tracklens.llm import suffix_groups as S

SCHEMA = "doc_id long, text string, digest string, ranges int, anchors string"


def brute(rows, width=S.WIDTH):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(b[i : i + width] for _, b in data for i in range(len(b) - width + 1))
    out = []
    for d, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + (len(b) > 0 and gone[0]))
        kept = bytes(x for x, g in zip(b, gone, strict=False) if not g)
        out.append((d, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in rows], SCHEMA).repartition(3)
    out = S.remove_repeats(df, **kw).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in out), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    v = [f"wört{i}" if i % 3 else f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rnd.choices(v, k=n))
    passages = [text(n) for n in (30, 33, 34, 40, 90)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rnd.randint(0, 3)):
            parts.append(text(rnd.randint(0, 60)))
            p = rnd.choice(passages)
            a, z = sorted((rnd.randrange(len(p)), len(p))) if rnd.random() < 0.6 else (0, len(p))
            parts.append(p[a:z])
        if rnd.random() < 0.1:
            parts.append(rnd.choice(["a", "ab", "xyz"]) * rnd.randint(60, 400))
        rows.append((i, "".join(parts)))
    once = text(120)
    return [*rows, (70, once + "|" + once[:400]), (71, rows[3][1]), (71, rows[3][1]), (72, text(200))]


@pytest.mark.parametrize("alphabet", [1, 2, 4, 30])
def test_suffix_array_matches_sorting(alphabet):
    rng = np.random.default_rng(alphabet)
    for _ in range(300):
        x = np.append(rng.integers(1, alphabet + 1, rng.integers(1, 70)), 0)
        if rng.random() < 0.3:
            x = np.append(np.tile(x[:-1][:6], 9), 0)
        y = x.tolist()
        assert S.suffix_array(x).tolist() == sorted(range(len(y)), key=lambda i: y[i:])


def test_every_window_lies_in_one_piece():
    rng = np.random.default_rng(5)
    texts = [rng.integers(97, 97 + k, n).astype(np.uint8).tobytes() for k, n in ((26, 900), (1, 700), (2, 600), (26, 199), (26, 200), (3, 0))]
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    doc, first, count, place, _ = S.pieces(np.frombuffer(b"".join(texts), np.uint8), off)
    got = Counter((int(d), int(s - off[d])) for d, f, n in zip(doc, first, count, strict=True) for s in range(f, f + n))
    assert got == Counter((d, s) for d, t in enumerate(texts) for s in range(len(t) - S.WIDTH + 1))
    assert (place >= first + count - 1).all() and (place + S.GRAM <= first + S.WIDTH).all()  # every window holds the minimizer


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_minimizers_beyond_a_bucket(spark):
    rnd = random.Random(3)
    line = "".join(rnd.choices("abcdefgh", k=199))
    rows = [(i, "".join(rnd.choices("abcdefgh", k=rnd.randint(0, 300))) + line + "".join(rnd.choices("abcdefgh", k=rnd.choice([0, 1, 2, 200])))) for i in range(60)]
    assert run(spark, rows, bucket_bytes=2000) == run(spark, rows) == brute(rows)


def test_long_texts_come_in_parts(spark, monkeypatch):
    rnd = random.Random(4)
    base = "".join(rnd.choices("abcdefgh", k=3000))
    texts = [base, base[:1000] + "#" + base[1000:], "é" * 700]
    data = [t.encode() for t in texts]
    monkeypatch.setattr(S, "PART_BYTES", 512)
    import pyarrow as pa

    windows = Counter()
    for raw, off, row, start in S._parts(pa.array([*texts, None, "short"])):
        doc, first, count, _, _ = S.pieces(raw, off)
        for d, f, n in zip(doc, first, count, strict=True):
            for s in range(f, f + n):
                i, at = int(row[d]), int(s - off[d] + start[d])
                windows[i, at] += 1
                assert data[i][at : at + S.WIDTH] == raw[s : s + S.WIDTH].tobytes()
    assert windows == Counter((i, s) for i, b in enumerate(data) for s in range(len(b) - S.WIDTH + 1))


def test_edges(spark):
    same = "z" * 250
    rows = [(None, None), (1, ""), (2, same), (2, same), (None, same), (3, "y" * 199), (4, "y" * 201), (5, "é" * 100), (6, "é" * 100), (7, "unique " * 10)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []
