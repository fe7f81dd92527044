import random
import re

import pytest

from tracklens.llm import ngram_join as N

SCHEMA = "doc_id long, text string, component_id string, token int"


def words(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [w for w in re.split(r"[\x20\x09-\x0d]+", low) if w]


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    for i, s in enumerate(sets):
        for j in {j for x in s for j in by[x] if j > i}:
            if rows[i][0] is not None and rows[j][0] is not None:
                if 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                    comp[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), None if d is None else low[find(i)]) for i, (d, _) in enumerate(rows) if d is not None)


def run(spark, rows):
    df = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in N.similar_components(df).collect()]
    assert all(c is None for d, _, c in got if d is None)
    return sorted(r for r in got if r[0] is not None)


def corpus(seed, groups=12):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = " ".join(rnd.choices(vocab, k=60))
    texts = []
    for g in range(groups):
        base = rnd.choices(vocab, k=rnd.choice([4, 7, 30, 120, 200]))
        for _ in range(rnd.randint(1, 25)):
            w = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 3, 5, 9])):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            text = rnd.choice([" ", "  ", "\n", "\t"]).join(w)
            texts.append(text.upper() if rnd.random() < 0.1 else text + (" " + passage if g % 4 == 0 else ""))
    texts += [passage] * 3 + ["", None, " \n ", "one two", "ONE two", "one", "a b c d e", "a b c d e f"]
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_hot_group_ties_nulls_and_repeats(spark):
    rnd = random.Random(9)
    base = [f"v{i}" for i in range(150)]
    rows = [(1000 + i, " ".join(base)) for i in range(60)]  # exact copies
    for i in range(150):  # near copies around a base that is there
        w = list(base)
        for _ in range(rnd.randint(1, 6)):
            w[rnd.randrange(len(w))] = f"x{rnd.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [rows[0], rows[100], (7, "another text under a used id with enough words"), (None, " ".join(base)), (None, None)]
    assert run(spark, rows) == brute(rows)


def test_many_texts_under_one_id(spark):
    rows = [(7 if i % 3 else i, t) for i, t in corpus(5)]
    rows += [(7, f"text number {i} of the hot id says {i * 7} and {i * 11}") for i in range(800)] + [(7, rows[0][1])] * 200
    assert run(spark, rows) == brute(rows)


def test_empty_table_and_long_text(spark):
    assert run(spark, []) == []
    rnd = random.Random(3)
    long = [f"t{rnd.randrange(5000)}" for _ in range(40_000)]
    rows = [(2, " ".join(long)), (5, " ".join(long[:38_000])), (9, " ".join(long[:20_000]))]
    assert run(spark, rows) == brute(rows)


def test_prefix_choice_counts_costs():
    import numpy as np

    assert N.choose_matches(np.full(100, 2), 100) >= 1
    # with a set of 100 tokens of equal size the prefix of l = 1 has 100 - 89 + 1 tokens
    cheap, dear = np.full(100, 2), np.concatenate([np.full(12, 2), np.full(88, 10**6)])
    assert N.choose_matches(dear, 100) == 1  # longer prefixes would read frequent tokens
    assert N.choose_matches(cheap, 100) > 1
