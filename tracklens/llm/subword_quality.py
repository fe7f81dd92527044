"""Quality classifier: supervised subword embeddings.

A text's features are its words, the words' character n-grams and its word
pairs, hashed into ``BUCKETS``; a pair of equal neighbours is one feature of
its own.  Every bucket has a learned vector; a document is the mean of its
features' vectors, and a softmax over the two classes reads it off.  Training
is stochastic gradient descent in numpy over a bounded sample of labelled rows
(``TRAIN_ROWS``, chosen by a hash of the id).

Scoring is linear in the features up to the softmax, so the vectors times the
output difference are one number per bucket: that array is the broadcast model
(1 MB), and a task looks each distinct word up once per slice.

Edge cases: null and empty texts score the softmax of the output bias alone;
without learnable rows of both classes every score is the share of label 1
(0.5 without any); repeated rows score alike; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens.llm.labelled import bounded_sample, hash_share, learnable, remainder
from tracklens.llm.text import code_points, encode, flat_words, give_back, hash_words, mix, owners, released, slices, sums, window_hashes

BUCKETS = 1 << 18
DIM = 8
NGRAMS = (3, 4, 5)
TRAIN_ROWS = 3_000
EPOCHS = 5  # or as many as make MIN_STEPS steps, where labels are few
MIN_STEPS = 800
BATCH = 16
RATE = 20.0
SEED = 17
HELD_MODULUS, HELD = 4, 2
THRESHOLD = 0.7
SCORE_BYTES = 1 << 20  # text scored at once: its words' features take some 30 times as much

_REPEAT = 0  # the bucket of a word that follows itself


def word_features(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each distinct word: itself and its character n-grams."""
    points, off = code_points(distinct, "<", ">")
    h = mix(points.astype(np.uint64) + np.uint64(1))
    n = len(distinct)
    if not n:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    of, size = owners(off), np.diff(off)
    bucket = lambda h: (h % np.uint64(BUCKETS - 1)).astype(np.int32) + np.int32(1)
    word, feature = [np.arange(n, dtype=np.int32)], [bucket(hash_words(distinct, SEED))]
    for k in NGRAMS:
        at = np.flatnonzero(np.arange(len(points)) + k <= off[1:][of])
        word.append(of[at].astype(np.int32))
        feature.append(bucket(mix(window_hashes(h, k)[at] + np.uint64(k))))
    word, feature = np.concatenate(word), np.concatenate(feature)
    order = np.argsort(word, kind="stable")
    per_word = 1 + sum(np.maximum(size - k + 1, 0) for k in NGRAMS)
    return feature[order], np.concatenate([[0], np.cumsum(per_word)])


def pair_features(words: pa.Array, code: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each word pair of one text, and the pairs' offsets by text."""
    h = hash_words(words, SEED + 1)
    inside = np.ones(max(len(code) - 1, 0), bool)
    ends = off[1:-1]
    inside[ends[(ends > 0) & (ends < len(code))] - 1] = False
    pair = (mix(h[:-1] * np.uint64(31) + mix(h[1:])) % np.uint64(BUCKETS - 1)).astype(np.int64) + 1
    pair = np.where(code[:-1] == code[1:], _REPEAT, pair)[inside]
    count = np.maximum(np.diff(off) - 1, 0)
    return pair, np.concatenate([[0], np.cumsum(count)])


def _sample_matrix(texts: list[str]):
    """Per text: distinct feature buckets and their shares of the text."""
    rows = []
    for i in range(0, len(texts), 256):
        words, off = flat_words(pa.array(texts[i : i + 256], pa.string()), lower=False)
        code, distinct = encode(words)
        feature, foff = word_features(distinct)
        pair, poff = pair_features(words, code, off)
        for j in range(len(off) - 1):
            w, c = np.unique(code[off[j] : off[j + 1]], return_counts=True)
            spans = [feature[foff[x] : foff[x + 1]] for x in w.tolist()]
            f = np.concatenate([*spans, pair[poff[j] : poff[j + 1]]]) if spans else np.zeros(0, np.int64)
            weight = np.concatenate([np.repeat(c, [len(s) for s in spans]), np.ones(poff[j + 1] - poff[j])]) if spans else np.zeros(0)
            u, at = np.unique(f, return_inverse=True)
            share = np.bincount(at, weights=weight, minlength=len(u))
            rows.append((u.astype(np.int32), (share / max(share.sum(), 1)).astype(np.float32)))
    return rows


def train(texts: list[str], labels: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, float]:
    """Bucket weights and bias of the log-odds of label 1."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    output, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    rows = _sample_matrix(texts)
    target = np.eye(2, dtype=np.float32)[labels]
    per_epoch = -(-len(rows) // BATCH)
    epochs = max(EPOCHS, -(-MIN_STEPS // per_epoch))
    steps, step = epochs * per_epoch, 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for start in range(0, len(rows), BATCH):
            pick = order[start : start + BATCH]
            rate = RATE * (1 - step / steps)
            f = np.concatenate([rows[i][0] for i in pick])
            share = np.concatenate([rows[i][1] for i in pick])[:, None]
            of = np.repeat(np.arange(len(pick)), [len(rows[i][0]) for i in pick])
            hidden = np.zeros((len(pick), DIM), np.float32)
            np.add.at(hidden, of, vectors[f] * share)
            z = hidden @ output + bias
            p = np.exp(z - z.max(1, keepdims=True))
            grad = (p / p.sum(1, keepdims=True) - target[pick]) / len(pick)
            back = grad @ output.T
            output -= 0.05 * rate * (hidden.T @ grad)
            bias -= 0.05 * rate * grad.sum(0)
            np.add.at(vectors, f, -rate * share * back[of])
            step += 1
    return vectors @ (output[:, 1] - output[:, 0]), float(bias[1] - bias[0])


def learn(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, float]:
    """Train on at most about ``rows`` learnable rows, chosen by hash; a row that
    repeats counts once."""
    usable = learnable(labels, label, HELD_MODULUS, HELD)
    n = usable.count()
    sample = usable.where(hash_share(F.col("doc_id"), SEED) < min(1.0, rows / max(n, 1)))
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    chosen = bounded_sample(text.join(F.broadcast(sample), "doc_id"), rows, SEED)
    got = chosen.toArrow().sort_by([(c, "ascending") for c in ("doc_id", "label", "text")])
    y = got.column("label").to_numpy().astype(np.int64)
    if len(y) == 0 or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 0.001), 0.999)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    model = train(got.column("text").to_pylist(), y)
    del got
    give_back()  # the sample's features, some 200 MB, are no longer held
    return model


def score_texts(docs: DataFrame, weights: np.ndarray, bias: float, out: str = "score") -> DataFrame:
    """``docs`` (with text) plus the probability of label 1."""
    columns = [c for c in docs.columns if c != out]
    model = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))

    @released()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, b = model.value
        for batch in batches:
            for part in slices(batch, max_bytes=SCORE_BYTES):
                words, off = flat_words(part.column("text"), lower=False)
                code, distinct = encode(words)
                feature, foff = word_features(distinct)
                pair, poff = pair_features(words, code, off)
                per_word, per_size = sums(weight[feature], foff), np.diff(foff)
                total = sums(per_word[code], off) + sums(weight[pair], poff)
                size = sums(per_size[code], off) + np.diff(poff)
                odds = total / np.maximum(size, 1) + b
                cols = [part.column(c) for c in columns]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], [*columns, out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != out)
    return docs.select(*columns).mapInArrow(run, f"{kinds}, `{out}` double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    weights, bias = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "quality")
    held = F.coalesce(remainder(F.col("doc_id"), HELD_MODULUS) == HELD, F.lit(False))
    return score_texts(docs, weights, bias).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
