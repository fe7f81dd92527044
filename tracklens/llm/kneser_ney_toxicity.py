"""Toxicity by class-conditional Kneser-Ney models.

Two character models (order ``ORDER``, within words, with word ends) score a
text: one counted over toxic, one over ordinary labelled documents.  Both back
off to one shared Kneser-Ney model whose continuation counts come from every
document of the table, so an expression that is rare in both classes says
nothing either way.  A word's evidence is the sum of its characters' log
ratios; a text's evidence is taken per word over the whole text and over its
strongest windows (a few insults in a long text must not drown), and a
logistic function fitted on a bounded sample of labelled rows, which the
counts do not include, turns it into a probability.

Where the count of an n-gram in a class is c, its context's total t and its
context's distinct continuations n:

    P(x | h) = max(c - D, 0) / t + D n / t * P_shared(x | h without its first character)

For an n-gram seen in neither class the ratio of the two is the ratio of the
back-off weights, a property of the context alone.  So the whole comparison is
two tables, of seen n-grams and of contexts, both computed by joins.  They are
dealt to blocks of about ``MODEL_ROWS`` rows, a context together with all its
n-grams; a block is what is broadcast.  Several blocks are applied one after
another, each adding its n-grams' evidence to the words of the texts.

N-grams are packed into one long, 12 bits a character (characters beyond the
first 4,000 code points share places).

Edge cases: null and empty texts have evidence 0 everywhere; without labelled
rows of both classes every score is the share of toxic rows (0.5 without any);
repeated rows score alike; extra columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.labelled import bounded_sample, hash_share, learnable, remainder
from tracklens.llm.stages import discard, settle
from tracklens.llm.text import code_points, encode, flat_alnum_words, owners, slices, sums

ORDER = 5
BITS = 12
DISCOUNT = 0.75
MODEL_ROWS = 4_000_000  # of a block, 12 bytes each
CALIBRATION_ROWS = 4_000
CALIBRATION_SHARE = 0.2  # at most so much of the labelled rows
WINDOWS = (1, 5, 20)
STRONG = 2.0  # a word's evidence (nats) beyond which it adds to the text's strong evidence
SEED = 23
HELD_MODULUS, HELD = 3, 1
THRESHOLD = 0.7


def grams(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The packed n-gram that ends at each character (and at the end mark) of
    every distinct word, with up to ORDER - 1 characters before it, and the
    offsets by word."""
    points, off = code_points(pc.utf8_lower(distinct), "\x01", "\x02")
    place = points.astype(np.int64)
    place = np.where(place < 4000, place, 4000 + place % 95)
    n, of = len(place), owners(off)
    packed = place.copy()
    depth = np.arange(n) - off[:-1][of] if n else np.zeros(0, np.int64)
    for back in range(1, ORDER):
        at = np.flatnonzero(depth >= back)
        packed[at] |= place[at - back] << (BITS * back)
    keep = depth > 0  # the start mark is given
    return packed[keep], off - np.arange(len(off))


def _first_uses(code: np.ndarray, off: np.ndarray, distinct: int) -> np.ndarray:
    """Whether each word is its text's first use of it: a word that a text
    repeats is one observation."""
    first = np.zeros(len(code), bool)
    first[np.unique(owners(off) * distinct + code, return_index=True)[1]] = True
    return first


def _distinct_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each n-gram of the partition once."""
    seen = np.zeros(0, np.int64)
    for batch in batches:
        for part in slices(batch):
            words, _ = flat_alnum_words(part.column("text"))
            seen = np.union1d(seen, grams(words.unique())[0])
    yield pa.RecordBatch.from_arrays([pa.array(seen)], ["gram"])


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the partition's n-grams in toxic and in ordinary texts."""
    seen, count = np.zeros(0, np.int64), np.zeros((0, 2))
    for batch in batches:
        for part in slices(batch):
            words, off = flat_alnum_words(part.column("text"))
            code, distinct = encode(words)
            once = _first_uses(code, off, len(distinct))
            label = part.column("label").to_numpy()[owners(off)]
            times = np.stack([np.bincount(code, weights=(label == y) & once, minlength=len(distinct)) for y in (1, 0)], 1)
            gram, goff = grams(distinct)
            merged, at = np.unique(np.concatenate([seen, gram]), return_inverse=True)
            rows = np.concatenate([count, np.repeat(times, np.diff(goff), axis=0)])
            seen, count = merged, np.stack([np.bincount(at, weights=rows[:, j], minlength=len(merged)) for j in (0, 1)], 1)
    yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(count[:, 0].astype(np.int64)), pa.array(count[:, 1].astype(np.int64))], ["gram", "toxic", "plain"])


def _without_first(gram: Column, length: int) -> Column:
    """The last ``length`` characters."""
    return gram.bitwiseAND((1 << (BITS * length)) - 1)


def _length(gram: Column) -> Column:
    out = F.lit(1)
    for n in range(2, ORDER + 1):
        out = F.when(gram >= (1 << (BITS * (n - 1))), n).otherwise(out)
    return out


def shared_model(tops: DataFrame) -> DataFrame:
    """Kneser-Ney from continuation counts: gram (of length 1 to ORDER - 1),
    length, p.  ``tops`` has every distinct top-order n-gram of the corpus."""
    spark = tops.sparkSession
    levels = []
    for n in range(2, ORDER + 1):  # types of length n -> how many characters precede each shorter n-gram
        types = tops.where(F.col("gram") >= (1 << (BITS * (n - 1)))).select(_without_first(F.col("gram"), n).alias("gram")).distinct()
        levels.append(settle(types.groupBy(_without_first(F.col("gram"), n - 1).alias("gram")).agg(F.count(F.lit(1)).alias("cc")), "continuations"))
    v = max(levels[0].count(), 1)
    below = spark.createDataFrame([(0, 1.0 / v)], "tail long, lower double")
    out = None
    for n, low in enumerate(levels, start=1):
        context = F.shiftright("gram", BITS).alias("context")
        totals = low.groupBy(context).agg(F.sum("cc").alias("t"), F.count(F.lit(1)).alias("n"))
        p = low.withColumns({"context": F.shiftright("gram", BITS), "tail": _without_first(F.col("gram"), n - 1)})
        p = p.join(totals, "context").join(below, "tail")
        value = (F.greatest(F.col("cc") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("n") * F.col("lower")) / F.col("t")
        p = settle(p.select("gram", F.lit(n).alias("length"), value.alias("p")), "shared")
        below = p.select(F.col("gram").alias("tail"), F.col("p").alias("lower"))
        out = p if out is None else out.unionByName(p)
    discard(*levels)
    return out


def evidence_tables(counts: DataFrame, shared: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(gram, ratio) of n-grams seen in a class, (context, ratio) of what any
    other n-gram after the context says: log toxic minus log ordinary."""
    c = counts.withColumns({"context": F.shiftright("gram", BITS), "length": _length(F.col("gram")) - 1})
    c = c.withColumn("tail", F.expr(f"gram & (shiftleft(1L, {BITS} * length) - 1)"))
    contexts = c.groupBy("context").agg(
        *[F.sum(x).alias(f"{x}_t") for x in ("toxic", "plain")], *[F.count(F.when(F.col(x) > 0, 1)).alias(f"{x}_n") for x in ("toxic", "plain")]
    )
    contexts = settle(contexts, "contexts")
    low = shared.select(F.col("gram").alias("tail"), "length", F.col("p").alias("lower"))
    p = c.join(contexts, "context").join(low, ["tail", "length"], "left").withColumn("lower", F.coalesce("lower", F.lit(1e-4)))

    def weight(x: str) -> Column:  # of the back-off; an unseen context backs off wholly
        return F.when(F.col(f"{x}_t") > 0, DISCOUNT * F.col(f"{x}_n") / F.col(f"{x}_t")).otherwise(1.0)

    def prob(x: str) -> Column:
        seen = F.when(F.col(f"{x}_t") > 0, F.greatest(F.col(x) - DISCOUNT, F.lit(0.0)) / F.col(f"{x}_t")).otherwise(0.0)
        return seen + weight(x) * F.col("lower")

    seen = p.select("gram", F.log(prob("toxic") / prob("plain")).alias("ratio"))
    rest = contexts.select("context", F.log(weight("toxic") / weight("plain")).alias("ratio"))
    return seen, rest


def _table(df: DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and ratios."""
    got = df.select(key, "ratio").toArrow()
    k, r = got.column(key).to_numpy(), got.column("ratio").to_numpy().astype(np.float32)
    order = np.argsort(k)
    return k[order], r[order]


def _look_up(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    known, ratio = table
    if not len(known):
        return np.zeros(len(keys)), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return np.where(hit, ratio[at], 0.0), hit


def _word_evidence(texts: pa.Array, model) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Evidence of every word of the texts by one block of the model, the
    offsets by text, the words' codes and how many are distinct."""
    words, off = flat_alnum_words(texts)
    code, distinct = encode(words)
    gram, goff = grams(distinct)
    seen, hit = _look_up(gram, model[0])
    per_word = sums(np.where(hit, seen, _look_up(gram >> BITS, model[1])[0]), goff)
    return per_word[code] if len(code) else np.zeros(0), off, code, len(distinct)


def features(texts: pa.Array, model, before: np.ndarray | None = None) -> np.ndarray:
    """Per text: evidence per word, of the strongest window of each of
    ``WINDOWS`` words (per word), the logs of its strong evidence and of the
    number of words.  ``before`` is the words' evidence by earlier blocks."""
    value, off, code, distinct = _word_evidence(texts, model)
    if before is not None:
        value = value + before
    n = np.diff(off)
    out = [sums(value, off) / np.maximum(n, 1)]
    total = np.concatenate([[0.0], np.cumsum(value)])
    filled = np.flatnonzero(n > 0)
    for w in WINDOWS:
        # the window that starts at each word, cut at its text's end, over its full width
        start = np.arange(len(value))
        end = np.minimum(start + w, off[1:][owners(off)]) if len(value) else start
        mean = (total[end] - total[start]) / w
        best = np.zeros(len(n))
        if len(filled):
            best[filled] = np.maximum.reduceat(mean, off[:-1][filled])
        out.append(best)
    strong = np.where(_first_uses(code, off, distinct), np.maximum(value - STRONG, 0), 0)
    return np.stack([*out, np.log1p(sums(strong, off)), np.log1p(n)], 1)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean, scale, coefficients with the constant first) by Newton's method."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    beta = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(hess, z.T @ (y - p) - ridge * beta), -2, 2)
    return mean, scale, beta


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _apply(rows: DataFrame, tables: tuple[DataFrame, DataFrame, int], finish: Callable, schema: str) -> DataFrame:
    """``finish`` of every slice of ``rows`` (with text) and its features,
    after all blocks of the model have been applied."""
    seen, rest, blocks = tables
    columns = rows.columns
    carry = "_evidence"
    while carry in columns:
        carry += "_"
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    out = rows
    for b in range(blocks):
        of_block = (_table(seen.where(_block(F.shiftright("gram", BITS), blocks) == b), "gram"), _table(rest.where(_block(F.col("context"), blocks) == b), "context"))
        model = rows.sparkSession.sparkContext.broadcast(of_block)

        def run(batches: Iterator[pa.RecordBatch], model=model, first=b == 0, last=b + 1 == blocks) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    before = None if first else part.column(carry).flatten().to_numpy()
                    if last:
                        yield finish(part, features(part.column("text"), model.value, before))
                        continue
                    value, off, _, _ = _word_evidence(part.column("text"), model.value)
                    value = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(value if first else value + before))
                    yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], value], [*columns, carry])

        if b + 1 == blocks:
            return out.mapInArrow(run, schema)
        done = settle(out.mapInArrow(run, f"{kinds}, `{carry}` array<double>"), "evidence")
        model.destroy()
        if b:
            discard(out)
        out = done


def learn(docs: DataFrame, labels: DataFrame, label: str = "toxic"):
    """The model: (n-gram table, context table, number of blocks), calibration."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = learnable(labels, label, HELD_MODULUS, HELD)
    n = usable.count()
    aside = min(CALIBRATION_SHARE, CALIBRATION_ROWS / max(n, 1))
    candidates = docs.where("text IS NOT NULL").where(remainder(F.col("doc_id"), HELD_MODULUS) != HELD)
    # Labels grow with the table: shuffled at every size, never broadcast because a table happens to be small.
    texts = candidates.join(usable.hint("merge"), "doc_id")
    counts = texts.where(hash_share(F.col("doc_id"), SEED) >= aside).select("text", "label")
    counts = settle(counts.mapInArrow(_class_counts, "gram long, toxic long, plain long").groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("plain").alias("plain")), "class-counts")
    tops = settle(docs.select("text").mapInArrow(_distinct_grams, "gram long").distinct(), "grams")
    seen, rest = evidence_tables(counts, shared_model(tops))
    seen, rest = settle(seen, "ratios"), settle(rest, "ratios")
    tables = (seen, rest, max(1, math.ceil((seen.count() + rest.count()) / MODEL_ROWS)))

    def sample(part: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["doc_id", "label", "x"])

    kept = usable.where(hash_share(F.col("doc_id"), SEED) < aside)
    chosen = bounded_sample(candidates.join(F.broadcast(kept), "doc_id"), CALIBRATION_ROWS, SEED)
    got = _apply(chosen, tables, sample, "doc_id long, label int, x array<double>").toArrow().sort_by("doc_id")
    y = got.column("label").to_numpy().astype(np.float64)
    if len(y) == 0 or y.min() == y.max():
        share = min(max(float(y.mean()) if len(y) else 0.5, 0.001), 0.999)
        k = len(WINDOWS) + 3
        return tables, (np.zeros(k), np.ones(k), np.concatenate([[np.log(share / (1 - share))], np.zeros(k)]))
    return tables, fit_logistic(np.array(got.column("x").to_pylist()), y)


def score_texts(docs: DataFrame, model, out: str = "score") -> DataFrame:
    """``docs`` (with text) plus the probability of the toxic class."""
    columns = [c for c in docs.columns if c != out]
    tables, (mean, scale, beta) = model

    def score(part: pa.RecordBatch, x: np.ndarray) -> pa.RecordBatch:
        odds = beta[0] + (x - mean) / scale @ beta[1:]
        return pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], pa.array(1 / (1 + np.exp(-np.clip(odds, -500, 500))))], [*columns, out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != out)
    return _apply(docs.select(*columns), tables, score, f"{kinds}, `{out}` double")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(remainder(F.col("doc_id"), HELD_MODULUS) == HELD, F.lit(False))
    return score_texts(docs, model).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
