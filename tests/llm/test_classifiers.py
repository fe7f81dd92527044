import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tracklens.llm import kneser_ney_toxicity as T
from tracklens.llm import subword_quality as Q

SF = "/root/testdata/sf0.1"


def held_out(i, modulus, held):
    return zlib.crc32(str(i).encode()) % modulus == held


def rows_of(n, seed):
    """(id, text, label): label 1 texts are plain words, label 0 shouted, repeated or with bad stems."""
    rnd = random.Random(seed)
    stem = ["an", "er", "ti", "on", "ré", "sch", "ou", "la"]
    word = lambda: "".join(rnd.choices(stem, k=rnd.randint(1, 4)))
    out = []
    for i in range(n):
        w = [word() for _ in range(rnd.randint(5, 80))]
        good = i % 3 > 0
        if not good:
            for _ in range(max(1, len(w) // 8)):
                w[rnd.randrange(len(w))] = "vrx" + word()
        out.append((i, " ".join(w), int(good)))
    return out


def test_quality_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in Q.query(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == docs
    held = [i for i in labels if held_out(i, 4, 2)]
    assert all(rows[i].held_out == held_out(i, 4, 2) for i in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows.values())
    good = [i for i in held if labels[i] == 1]
    assert np.mean([rows[i].predicted == labels[i] for i in held]) > 0.97
    assert np.mean([rows[i].predicted for i in good]) > 0.98


def test_toxicity_on_held_out_labels(spark):
    rows = {r.doc_id: r for r in T.query(spark, SF).collect()}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [i for i in labels if held_out(i, 3, 1)]
    assert all(rows[i].held_out == held_out(i, 3, 1) for i in rows)
    toxic, plain = [i for i in held if labels[i] == 1], [i for i in held if labels[i] == 0]
    above = np.mean([[rows[i].score > rows[j].score for j in plain] for i in toxic])
    assert above > 0.95  # some 280 toxic documents in four languages to learn from
    assert np.mean([rows[i].predicted for i in toxic]) > 0.65
    assert np.mean([rows[i].predicted for i in plain]) < 0.01


@pytest.mark.parametrize("op", ["quality", "toxic"])
def test_labels_of_held_out_rows_are_never_read(spark, op):
    """Turning every held-out label around leaves all scores as they are."""
    data = rows_of(240, 4)
    modulus, held = (4, 2) if op == "quality" else (3, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    scores = []
    for flip in (False, True):
        lab = [(i, (1 - y) if flip and held_out(i, modulus, held) else y) for i, _, y in data]
        labels = spark.createDataFrame(lab, f"doc_id long, {op} int")
        model = Q.learn(docs, labels, op) if op == "quality" else T.learn(docs, labels, op)
        out = Q.score_texts(docs, *model) if op == "quality" else T.score_texts(docs, model)
        scores.append([r.score for r in out.orderBy("doc_id").collect()])
    assert scores[0] == scores[1]
    assert len(set(scores[0])) > 100


@pytest.mark.parametrize("op", ["quality", "toxic"])
def test_edge_rows(spark, op):
    docs = spark.createDataFrame(
        [(1, None, "a", 1), (2, "", "b", 2), (None, "some words", "c", 3), (4, "x" * 200_000, "d", 4), (5, "same text", "e", 5), (5, "same text", "f", 6), (6, "\n \t", "g", 7)],
        "doc_id long, text string, score string, label int",
    )
    labels = spark.createDataFrame([(1, 1), (2, None), (5, 1), (5, 0), (None, 1), (6, 7)], f"doc_id long, {op} int")
    for lab in (labels, labels.limit(0)):
        model = Q.learn(docs, lab, op) if op == "quality" else T.learn(docs, lab, op)
        score = (lambda d, m=model: Q.score_texts(d, *m)) if op == "quality" else (lambda d, m=model: T.score_texts(d, m))
        rows = score(docs).collect()
        assert len(rows) == 7 and all(0 <= r.score <= 1 for r in rows) and sorted(r.label for r in rows) == list(range(1, 8))
        same = [r.score for r in rows if r.doc_id == 5]
        assert same[0] == same[1]
        assert score(docs.limit(0)).count() == 0


def test_word_features_against_plain_python():
    words = ["añb", "a", "", "abc😀"]
    feature, off = Q.word_features(pa.array(words))
    grams = [[("<" + w + ">")[i : i + n] for n in Q.NGRAMS for i in range(len(w) + 3 - n)] for w in words]
    assert np.diff(off).tolist() == [1 + len(g) for g in grams]
    seen = {}
    for w, g in enumerate(grams):
        for x, f in zip(g, feature[off[w] + 1 : off[w + 1]].tolist(), strict=True):
            assert seen.setdefault(x, f) == f
    assert feature.min() > 0 and feature.max() < Q.BUCKETS


def brute_ratio(counts, types, word):
    """log P_toxic - log P_plain of a word by the formula, over plain dictionaries."""
    import math

    def shared(g):
        if not g:
            return 1 / max(len({t[-1] for t in types if len(t) >= 2}), 1)
        cc = {}
        for t in {t[-(len(g) + 1) :] for t in types if len(t) >= len(g) + 1}:
            cc[t[1:]] = cc.get(t[1:], 0) + 1
        after = {k: v for k, v in cc.items() if k[:-1] == g[:-1]}
        total = sum(after.values())
        return (max(cc.get(g, 0) - T.DISCOUNT, 0) + T.DISCOUNT * len(after) * shared(g[1:])) / total

    out = 0.0
    marked = "\x01" + word + "\x02"
    for i in range(1, len(marked)):
        g = marked[max(0, i - T.ORDER + 1) : i + 1]
        p = []
        for c in counts:
            t = sum(v for k, v in c.items() if k[:-1] == g[:-1] and v)
            n = sum(1 for k, v in c.items() if k[:-1] == g[:-1] and v)
            low = shared(g[1:]) if any(g in x for x in counts) else 1.0
            p.append((max(c.get(g, 0) - T.DISCOUNT, 0) / t + T.DISCOUNT * n / t * low) if t else low)
        out += math.log(p[0] / p[1])
    return out


def test_kneser_ney_against_plain_python(spark):
    texts = [(1, "idiot idol ant"), (1, "idiot antic"), (0, "ant anton idol idol"), (0, "tonic tan"), (None, "unseen tundra")]
    counts, types = [{}, {}], set()
    for label, text in texts:
        done = set()
        for w in text.split():
            m = "\x01" + w + "\x02"
            again = w in done
            done.add(w)
            for i in range(1, len(m)):
                g = m[max(0, i - T.ORDER + 1) : i + 1]
                types.add(g)
                if label is not None and not again:
                    c = counts[1 - label]
                    c[g] = c.get(g, 0) + 1
    df = spark.createDataFrame(texts, "label int, text string")
    tops = df.select("text").mapInArrow(T._distinct_grams, "gram long").distinct()
    got = df.where("label IS NOT NULL").mapInArrow(T._class_counts, "gram long, toxic long, plain long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain"))
    seen, rest = T.evidence_tables(got, T.shared_model(tops))
    model = (T._table(seen, "gram"), T._table(rest, "context"))
    for w in ["idiot", "anton", "idol", "tonic", "zebra", "antic", "tundra"]:
        assert T.features(pa.array([w]), model)[0][0] == pytest.approx(brute_ratio(counts, types, w), abs=1e-4), w


def test_no_ngram_is_lost_where_the_model_needs_several_blocks(spark, monkeypatch):
    data = rows_of(120, 6)
    docs = spark.createDataFrame([(i, t) for i, t, _ in data] + [(1000, None), (1001, "")], "doc_id long, text string").withColumn("_evidence", F.lit("mine"))
    labels = spark.createDataFrame([(i, 1 - y) for i, _, y in data], "doc_id long, toxic int")

    def scores():
        out = T.score_texts(docs, T.learn(docs, labels))
        assert out.columns == ["doc_id", "text", "_evidence", "score"] and out.where("_evidence = 'mine'").count() == len(data) + 2
        return [r.score for r in out.orderBy("doc_id").collect()]

    whole = scores()
    monkeypatch.setattr(T, "MODEL_ROWS", 1500)
    assert scores() == pytest.approx(whole, abs=1e-6)
    assert max(whole) > 0.9 > 0.1 > min(whole)


@pytest.mark.parametrize("op", ["quality", "toxic"])
def test_samples_are_bounded_where_an_id_repeats(spark, monkeypatch, op):
    from tracklens.llm.labelled import hash_share

    data = rows_of(150, 8)
    if op == "quality":
        hot = next(i for i, _, _ in data if not held_out(i, 4, 2))
    else:
        aside = {r.id for r in spark.range(150).where(hash_share(F.col("id"), T.SEED) < T.CALIBRATION_SHARE).collect()}
        hot = next(i for i, _, _ in data if i in aside and not held_out(i, 3, 1))
    rows = [(i, t) for i, t, _ in data] + [(hot, "the same text")] * 3000 + [(hot, f"text number {j}") for j in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], f"doc_id long, {op} int")
    seen = []
    if op == "quality":
        monkeypatch.setattr(Q, "train", lambda texts, y: seen.extend(texts) or (np.zeros(Q.BUCKETS, np.float32), 0.0))
        Q.learn(docs, labels, op, rows=200)
        assert seen.count("the same text") <= 1
    else:
        monkeypatch.setattr(T, "CALIBRATION_ROWS", 200)
        monkeypatch.setattr(T, "fit_logistic", lambda x, y: seen.extend(y) or (0, 1, 0))
        T.learn(docs, labels)
    assert 150 < len(seen) < 450


def buckets_of(text):
    """The features of a text, one after another, in plain Python."""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
    feature, off = Q.word_features(pa.array(words, pa.string()))
    out = [b for k in range(len(words)) for b in feature[off[k] : off[k + 1]].tolist()]
    pair, _ = Q.pair_features(pa.array(words, pa.string()), np.array([sorted(set(words)).index(w) for w in words], np.int64), np.array([0, len(words)]))
    return out + pair.tolist()


def test_quality_score_is_the_softmax_of_the_mean_vector(spark):
    rng = np.random.default_rng(3)
    weights, bias = rng.normal(size=Q.BUCKETS).astype(np.float32), 0.25
    texts = ["", None, "one", "ab ab ab cd", "Ein längerer Text mit Wörtern, und noch mehr Wörtern"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.score for r in Q.score_texts(docs, weights, bias).collect()}
    for i, t in enumerate(texts):
        f = buckets_of(t or "")
        z = sum(float(weights[b]) for b in f) / max(len(f), 1) + bias
        assert got[i] == pytest.approx(1 / (1 + np.exp(-z)), abs=1e-6)


def test_one_step_of_gradient_descent(monkeypatch):
    monkeypatch.setattr(Q, "EPOCHS", 1)
    monkeypatch.setattr(Q, "MIN_STEPS", 1)
    texts, labels = ["good words here", "vrx vrx bad", "good text"], np.array([1, 0, 1])
    weights, bias = Q.train(texts, labels)
    # the same step, text by text and feature by feature
    rng = np.random.default_rng(Q.SEED)
    start = rng.uniform(-1 / Q.DIM, 1 / Q.DIM, (Q.BUCKETS, Q.DIM)).astype(np.float32).astype(np.float64)
    vectors, output, b = start.copy(), np.zeros((Q.DIM, 2)), np.zeros(2)
    grads = []
    for t, y in zip(texts, labels, strict=True):
        f = buckets_of(t)
        hidden = np.mean([start[x] for x in f], 0)
        z = hidden @ output + b
        p = np.exp(z) / np.exp(z).sum()
        grads.append((f, hidden, (p - np.eye(2)[y]) / len(texts)))
    for f, hidden, g in grads:
        for x in f:
            vectors[x] -= Q.RATE * (g @ np.zeros((Q.DIM, 2)).T) / len(f)
        output -= 0.05 * Q.RATE * np.outer(hidden, g)
        b -= 0.05 * Q.RATE * g
    assert np.allclose(weights, vectors @ (output[:, 1] - output[:, 0]), atol=1e-5)
    assert bias == pytest.approx(b[1] - b[0], abs=1e-5)
