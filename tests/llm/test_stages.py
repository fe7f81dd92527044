import random

import pytest

from tracklens.llm.stages import components


def brute(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in root}


def run(spark, edges):
    return [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()]


@pytest.mark.parametrize("base", [0, 1000 << 33, (1 << 62) + 5])
def test_components_of_ids_of_any_size(spark, base):
    rnd = random.Random(base)
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(300)]
    loose = [(500 + rnd.randrange(60), 500 + rnd.randrange(60)) for _ in range(40)]
    edges = [(base + a, base + b) if rnd.random() < 0.5 else (base + b, base + a) for a, b in chain + star + loose]
    got = run(spark, edges)
    expected = {(x, c) for x, c in brute(edges) if any(x in e and e[0] != e[1] for e in edges)}
    assert len(got) == len(set(got)) and set(got) == expected


def test_components_of_nothing(spark):
    assert run(spark, []) == []
    assert run(spark, [(3, 3)]) == []
